"""Documents in chunks of bounded size, each with a dictionary of its own.

Corpus-wide counts of words or pairs can outgrow any broadcast, and one row per document and word is many times the text. So
a task counts what a chunk of documents holds and writes it as the chunk's dictionary, once per chunk and not per document;
Spark sums the dictionaries into corpus counts and joins these back to them; and a last pass sees each chunk next to its
dictionary. A key occurs at most once in a chunk, so even a word of every document is one row in some thousand of these joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefold.llm.common import pieces, reachable

# Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20
# A row of a chunk is one of its documents, an entry of its dictionary, or an entry with what the corpus knows of it.
DOCUMENT, ENTRY, KNOWN = 0, 1, 2
# The number of a chunk holds the task's above these bits.
_NUMBER_BITS = 32

Columns = dict[str, object]


def chunked(
    df: DataFrame, prepare: Callable[[], Callable[[pa.RecordBatch], tuple[Columns, Columns]]], documents: str, entries: str,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Rows ``chunk``, ``kind``, then the columns of documents and of dictionary entries, each null in the other's rows.

    ``prepare`` is called once per task; what it returns turns a batch with ``text`` into the columns of both.
    """
    reachable(df.sparkSession)
    parts = [T._parse_datatype_string(s) for s in (documents, entries)]
    schema = T.StructType([*T._parse_datatype_string("chunk long, kind int").fields, *parts[0].fields, *parts[1].fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        work, first = prepare(), TaskContext.get().partitionId() << _NUMBER_BITS
        for number, batch in enumerate(pieces(batches, limit=limit)):
            for kind, (columns, part) in enumerate(zip(work(batch), parts, strict=True)):
                own = {n: columns[n] if isinstance(columns[n], pa.Array) else pa.array(columns[n]) for n in part.names}
                rows = len(own[part.names[0]])
                fixed = {"chunk": np.full(rows, first + number, np.int64), "kind": np.full(rows, kind, np.int32)}
                every = {**{n: pa.array(v) for n, v in fixed.items()}, **own}
                arrays = [every[f.name].cast(f.type) if f.name in every else pa.nulls(rows, f.type) for f in target]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)
            # What a chunk took goes back to the machine, where other workers share it.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def by_chunk(df: DataFrame, function: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``function`` over the chunks of each task, one table per chunk; memory holds one chunk."""
    reachable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in function(_tables(batches)):
            yield out
            pa.default_memory_pool().release_unused()

    # The Arrow writer passes over all null lists since the last list at each one more, so there are none.
    lists = {f.name: F.coalesce(f.name, F.array().cast(f.dataType)) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    # Sorted by one number: rows of a chunk come in any order.
    return df.withColumns(lists).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(run, schema)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        chunk = batch.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1), len(chunk)]
        for begin, end in zip(cuts, cuts[1:], strict=False):
            if begin == end:
                continue
            part = batch.slice(begin, end - begin)
            if held and held[0].column("chunk")[0].as_py() != chunk[begin]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def of_kind(table: pa.Table, kind: int) -> pa.Table:
    """The rows of one kind."""
    return table.filter(pa.array(table["kind"].to_numpy() == kind)).combine_chunks()


def column(table: pa.Table, name: str) -> pa.Array:
    """One array of a table of combined chunks."""
    found = table[name]
    return found.chunk(0) if found.num_chunks == 1 else pa.concat_arrays([c.cast(found.type) for c in found.chunks]) if found.num_chunks else pa.nulls(0, found.type)
