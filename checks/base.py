"""Shared pieces of the checks: tables, comparable output, rendered messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.session import configure

Query = Callable[[SparkSession, str], DataFrame]


class Checks:
    """Queries and their SQL under one name each."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if sql:
                self.sql[name] = sql
            return query

        return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines write alike: zone-free times, longs for whole decimals."""
    casts = {}
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("long")
        elif isinstance(f.dataType, T.ArrayType):
            casts[f.name] = F.array_join(f.name, ",")
    return df.withColumns(casts) if casts else df


def digits(ts: Column, length: int = 14) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss"[:length])


def _joined(delimiter: str, values: Mapping[int, Column | str], first: int) -> Column:
    """Values by position, joined; runs of constants become one literal."""
    parts: list[Column] = []
    constant = ""
    for number in range(first, max(values) + 1):
        value = values.get(number, "")
        if number > first:
            constant += delimiter
        if isinstance(value, str):
            constant += value
        else:
            parts += [F.lit(constant), F.coalesce(value.cast("string"), F.lit(""))]
            constant = ""
    return F.concat(*parts, F.lit(constant))


def segment(name: str, fields: Mapping[int, Column | str]) -> Column:
    """A segment with the given fields, all others empty."""
    first = 2 if name == "MSH" else 1
    given = {2: "^~\\&", **fields} if name == "MSH" else fields
    return F.concat(F.lit(f"{name}|"), _joined("|", given, first))


def components(values: Mapping[int, Column | str]) -> Column:
    """A field with the given components, all others empty."""
    return _joined("^", values, 1)


def message(*segments: Column) -> Column:
    return F.concat_ws("\r", *segments)


def utc_sql(local: str) -> str:
    """SQL for the instant of a US Central wall clock, by the daylight rules of 1987 to 2006
    (first Sunday of April to last Sunday of October)."""
    year = f"CAST(year({local}) AS BIGINT)"
    april = f"make_date({year}, 4, 1)"
    october = f"make_date({year}, 10, 31)"
    start = f"({april} + CAST((7 - dayofweek({april})) % 7 AS INTEGER) + INTERVAL 2 HOUR)"
    end = f"({october} - CAST(dayofweek({october}) AS INTEGER) + INTERVAL 2 HOUR)"
    return (
        f"(CASE WHEN year({local}) < 2007 AND {local} >= {start} AND {local} < {end} "
        f"THEN {local} + INTERVAL 5 HOUR ELSE {local} + INTERVAL 6 HOUR END)"
    )
