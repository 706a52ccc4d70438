"""Queries over the test tables, each beside the SQL that must give the same rows."""

from checks import backfill, cdc, messages, rows, streams

ALL = (cdc.checks, rows.checks, messages.checks, backfill.checks, streams.checks)
