"""Pieces shared by the corpus operators: tables, scratch tables, words and hashes of whole batches of texts."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.session import configure, scratch_path

# Bytes of text that a task turns into arrays at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

# What separates words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def reachable(spark: SparkSession) -> None:
    """Lets Python workers find this package whatever folder the driver runs in; a cluster has it installed or shipped."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, root])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    reachable(spark)
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, column: str = "text", key: str = "doc_id") -> DataFrame:
    """Key and text as (id, text) without whatever other columns there are; a null text is empty."""
    return df.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(column), F.lit("")).alias("text"))


def map_batches(df: DataFrame, function, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` over pieces of bounded text size."""
    reachable(df.sparkSession)
    names = [f.name for f in T._parse_datatype_string(schema)] if isinstance(schema, str) else schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(pieces(batches)):
            yield pa.RecordBatch.from_arrays([out[n] if isinstance(out[n], pa.Array) else pa.array(out[n]) for n in names], names)

    return df.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = _offsets(batch.column(column))[1:]
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else ends[0] - len_of(batch.column(column), 0)
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _offsets(column: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def len_of(column: pa.Array, i: int) -> int:
    at = _offsets(column)
    return int(at[i + 1] - at[i])


class Bytes:
    """The UTF-8 bytes of a batch of texts, one after the other, and where each text starts."""

    def __init__(self, column: pa.Array) -> None:
        at = _offsets(column)
        data = column.buffers()[2]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = whole[at[0] : at[-1]]
        self.starts = at - at[0]
        self.rows = len(column)

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def text(self, row: int) -> bytes:
        return self.data[self.starts[row] : self.starts[row + 1]].tobytes()


class Words:
    """The words of a batch of texts: byte positions, and the first word of each text in ``first``."""

    def __init__(self, source: Bytes) -> None:
        self.source = source
        inside = ~_IS_SPACE[source.data]
        n = len(inside)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        # A text's first byte begins a word whatever stands before it.
        cuts = source.starts[(source.starts > 0) & (source.starts < n)]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.begin = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begin, source.starts)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(source.rows), self.count)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return range_hashes(self.source.data, self.begin, self.end, seed)


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _POWERS.get(seed)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n).bit_length())
        base = _BASES[seed]
        tables = []
        for factor in (base, pow(base, -1, 1 << 64)):
            out = np.full(size, factor, dtype=np.uint64)
            out[0] = 1
            tables.append(np.multiply.accumulate(out))
        have = _POWERS[seed] = (tables[0], tables[1])
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def range_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of values[begin:end] for each range; equal ranges have equal hashes wherever they stand."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(seed, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=total[1:])
    # The length is mixed in, so that a range is not taken for one that only adds zeros to it.
    return mixed((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def anchors(hashes: np.ndarray, group: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions such that each run of ``window`` consecutive hashes of one group has one, and where the first and last of its runs begin.

    It is the smallest hash of the run, leftmost if several are equal, so equal runs choose equal hashes.
    """
    n = len(hashes)
    if n < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    if n > 1 << 23:  # the position takes 24 bits of a key
        step = (1 << 23) - window + 1
        parts = [
            np.array(anchors(hashes[at : at + (1 << 23)], group[at : at + (1 << 23)], window)) + at for at in range(0, n, step)
        ]
        best, first, last = np.concatenate(parts, axis=1)
    else:
        low = np.uint64((1 << 24) - 1)
        keys = np.full(-(-n // window) * window, ~np.uint64(0))
        keys[:n] = (hashes & ~low) | np.arange(n, dtype=np.uint64)
        blocks = keys.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        runs = n - window + 1
        first = last = np.flatnonzero(group[:runs] == group[window - 1 :])
        best = (np.minimum(behind[:runs], ahead[window - 1 : window - 1 + runs])[first] & low).astype(np.int64)
    # The choice never moves back from one run to the next.
    new = np.flatnonzero(np.diff(best, prepend=-1))
    return best[new], first[new], last[np.append(new[1:], len(best)) - 1] if len(best) else last


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's longs."""
    return x.view(np.int64)
