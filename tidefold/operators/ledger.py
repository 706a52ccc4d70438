"""Which messages have been taken in: a table of their names' digests, laid out so that a batch finds its own.

Redelivered messages are told by name: the number, or the text where there is none. A name is kept as a digest of 32 bytes beside its
``place``, by which the table is sorted: the number itself, or for texts and names that are no numbers a hash below zero. The numbers of a batch
lie together, and a hash is in one of ``PARTS`` equal ranges, so a few ranges cover a batch, reach the scan, and skip the files
and row groups that cannot hold what it brings.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefold.sources.bus import position
from tidefold.spec import schema_of

SCHEMA = schema_of("place long, name binary")
# Ranges of hashes; as many as a long has bits, so that one number says which are met.
PARTS = 64
_SHIFT = 63 - 6


def name_of(number: Column, text: Column) -> Column:
    """Digest by which a message is known."""
    shown = F.coalesce(F.concat(F.lit("#"), number), F.concat(F.lit("="), text), F.lit("="))
    return F.unhex(F.sha2(shown, 256))


def place_of(number: Column, text: Column) -> Column:
    """Where the ledger keeps a message: its sequence, or -1 and below for a hash."""
    sequence = position(number)["sequence"].try_cast("long")
    hashed = F.xxhash64(F.coalesce(number, text, F.lit(""))).bitwiseAND(F.lit(2**63 - 1))
    return F.when(sequence >= 0, sequence).otherwise(-1 - hashed)


def measures(place: str = "place") -> list[Column]:
    """Aggregates that tell which ranges a batch meets: ``low, high`` of its numbers, a bit for each part of its hashes."""
    at = F.col(place)
    part = F.shiftright(-1 - at, _SHIFT).cast("int")
    return [
        F.min(F.when(at >= 0, at)).alias("low"), F.max(F.when(at >= 0, at)).alias("high"),
        F.bit_or(F.when(at < 0, F.expr(f"shiftleft(1L, CAST(shiftright(-1 - {place}, {_SHIFT}) AS INT))"))).alias("parts"),
    ]


def ranges(low: int | None, high: int | None, parts: int | None) -> list[tuple[int, int]]:
    """The places between which a batch's messages lie, both ends included."""
    found = [] if low is None else [(low, high)]
    met = [p for p in range(PARTS) if (parts or 0) >> p & 1]
    for p in met:
        begin, end = -1 - (((p + 1) << _SHIFT) - 1), -1 - (p << _SHIFT)
        if found and found[-1][0] == end + 1:
            found[-1] = (begin, found[-1][1])
        else:
            found.append((begin, end))
    return found


def within(ledger: DataFrame, spans: Sequence[tuple[int, int]]) -> DataFrame:
    """The entries in any of the ranges, by a filter that the scan takes."""
    if not spans:
        return ledger.filter(F.lit(False))
    return ledger.filter(reduce(or_, ((F.col("place") >= b) & (F.col("place") <= e) for b, e in spans)))


def repeats(batch: DataFrame, ledger: DataFrame, spans: Sequence[tuple[int, int]]) -> DataFrame:
    """``place, name`` of the batch's messages that the ledger has."""
    return batch.select("place", "name").join(within(ledger, spans), ["place", "name"], "left_semi")
