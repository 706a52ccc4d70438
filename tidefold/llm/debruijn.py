"""Substring deduplication of word sequences over a sampled De Bruijn graph.

Each window of WINDOW words has an anchor, the k-mer of smallest hash in it, so equal windows have equal anchors. Anchors are the
nodes of the graph, and the words from one anchor of a document to the next are an edge. A node that several documents hold and
that has one edge in and one out everywhere does not branch: whatever document holds it goes the same way. Joined with their
nodes, the anchors of a document compact into paths between branching nodes; a path that a document with a smaller id holds too is a
repeat as a whole, whatever its length, and costs one row. Only the windows that hold a branching anchor are compared
one by one, by 128-bit digests with their source coordinates. Different k-mers under one hash show as branching, since their edges
differ, so they end in that comparison too.

Nulls: a null text has no words. Texts shorter than a window are returned whole. A row without id comes before no other and after
none, so nothing is removed from it. Repeated rows (equal id and text) do not remove each other; different texts
under one id are not told apart, so an id should name one text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import Bytes, Words, anchors, map_batches, mixed, range_hashes, signed, texts, written

WINDOW = 50
KMER = 12
_BEGIN, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def anchor_rows(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """Anchors of each document: id, pos (word), h (k-mer), edge_in and edge_out (words up to the neighbouring anchors)."""

    def run(batches):
        for batch in batches:
            words = Words(Bytes(batch.column("text")))
            hashes = words.hashes()
            at = np.arange(max(0, len(hashes) - k + 1))
            at = at[words.row[at] == words.row[at + k - 1]] if len(at) else at
            kmers = range_hashes(hashes, at, at + k)
            chosen = anchors(kmers, words.row[at], window - k + 1)[0] if len(at) else at
            pos, h = at[chosen], kmers[chosen] if len(at) else np.zeros(0, np.uint64)
            row = words.row[pos] if len(pos) else pos
            first = np.flatnonzero(np.diff(row, prepend=-1)) if len(pos) else pos
            last = np.append(first[1:], len(pos)) - 1 if len(pos) else pos
            begin, end = np.roll(pos, 1), np.roll(pos, -1) + k
            begin[first], end[last] = words.first[row[first]], words.first[row[last] + 1]
            edge_in, edge_out = range_hashes(hashes, begin, pos + k), range_hashes(hashes, pos, end)
            # Where a document begins or ends is part of the edge.
            edge_in[first] = mixed(edge_in[first] ^ _BEGIN)
            edge_out[last] = mixed(edge_out[last] ^ _END)
            yield {
                "id": batch.column("id").take(pa.array(row)),
                "pos": (pos - words.first[row]).astype(np.int32) if len(pos) else np.zeros(0, np.int32),
                "h": signed(h), "edge_in": signed(edge_in), "edge_out": signed(edge_out),
            }

    return map_batches(docs, run, "id long, pos int, h long, edge_in long, edge_out long")


def nodes(found: DataFrame) -> DataFrame:
    """Nodes that several documents hold: h, first (the smallest id), branching."""
    names = ("id", "edge_in", "edge_out")
    sides = found.groupBy("h").agg(*(f(n).alias(f"{s}_{n}") for n in names for s, f in (("lo", F.min), ("hi", F.max))))
    branching = (F.col("lo_edge_in") < F.col("hi_edge_in")) | (F.col("lo_edge_out") < F.col("hi_edge_out"))
    return sides.where("lo_id < hi_id").select("h", F.col("lo_id").alias("first"), branching.alias("branching"))


def paths(placed: DataFrame) -> DataFrame:
    """Paths between branching anchors that a smaller document holds too: id, before, after (the anchors around it, null at an end)."""
    order = Window.partitionBy("id").orderBy("pos")
    branch = F.when(F.col("branching"), F.col("pos"))
    back, ahead = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    around = placed.select(
        "id", "branching", "again", F.last(branch, True).over(back).alias("before"), F.first(branch, True).over(ahead).alias("after")
    )
    return around.where("NOT branching AND again").select("id", "before", "after").distinct()


def window_rows(docs: DataFrame, branching: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """The windows that hold a branching anchor: id, pos, and the digest (a, b) of their words."""
    lists = branching.groupBy("id").agg(F.collect_set("pos").alias("at"))

    def run(batches):
        for batch in batches:
            words = Words(Bytes(batch.column("text")))
            lists = batch.column("at")
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = words.first[row] + lists.flatten().to_numpy().astype(np.int64)
            starts = at[:, None] + np.arange(k - window, 1)
            fits = (starts >= words.first[row][:, None]) & (starts + window <= words.first[row + 1][:, None])
            starts = np.unique(starts[fits])
            owner = words.row[starts] if len(starts) else starts
            yield {
                "id": batch.column("id").take(pa.array(owner)),
                "pos": (starts - words.first[owner]).astype(np.int32),
                **{c: signed(range_hashes(words.hashes(s), starts, starts + window, s)) for s, c in enumerate("ab")},
            }

    held = docs.join(lists, "id").select("id", "text", "at")
    return map_batches(held, run, "id long, pos int, a long, b long")


def repeats(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> tuple[DataFrame, DataFrame]:
    """What smaller documents hold already: paths (id, before, after) and windows (id, pos)."""
    found = written(anchor_rows(docs, window, k), "anchors")
    # The nodes are written, as an aggregation between shuffle and join would keep the rows of a hot key in one task.
    placed = found.select("id", "pos", "h").join(written(nodes(found), "nodes"), "h")
    placed = written(placed.select("id", "pos", "branching", (F.col("id") > F.col("first")).alias("again")), "placed")
    compared = written(window_rows(docs, placed.where("branching"), window, k), "windows")
    first = compared.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    again = compared.join(written(first, "first"), ["a", "b"]).where(F.col("id") > F.col("first"))
    return paths(placed), again.select("id", "pos")


def deduplicate(docs: DataFrame, window: int = WINDOW, k: int = KMER, with_text: bool = True) -> DataFrame:
    """Each document without the words that a repeated window covers: doc_id, n_words, n_removed, kept_sha256 and, ``with_text``, kept."""
    every = texts(docs)
    along, single = repeats(every.where("id IS NOT NULL"), window, k)
    along = along.groupBy("id").agg(F.collect_list(F.struct("before", "after")).alias("paths"))
    single = single.groupBy("id").agg(F.collect_set("pos").alias("windows"))
    marks = along.join(single, "id", "full")

    def run(batches):
        for batch in batches:
            words = Words(Bytes(batch.column("text")))
            kept, removed, digests = [], [], []
            for row, (spans, starts) in enumerate(zip(batch.column("paths").to_pylist(), batch.column("windows").to_pylist(), strict=True)):
                n, origin = int(words.count[row]), int(words.first[row])
                edge = np.zeros(n + 1, np.int64)
                for s in spans or ():
                    begin = 0 if s["before"] is None else s["before"] + 1
                    end = n if s["after"] is None else min(n, s["after"] + k - 1)
                    if end - begin >= window:
                        edge[begin] += 1
                        edge[end] -= 1
                if starts:
                    at = np.array([x for x in starts if x + window <= n], np.int64)
                    edge[at] += 1
                    edge[at + window] -= 1
                left = np.flatnonzero(np.cumsum(edge)[:n] == 0) + origin
                data = words.source.data
                kept.append(b" ".join([data[b:e].tobytes() for b, e in zip(words.begin[left].tolist(), words.end[left].tolist(), strict=True)]))
                removed.append(n - len(left))
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            yield {
                "doc_id": batch.column("id"),
                "n_words": words.count.astype(np.int64),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()) if with_text else None,
            }

    marked = every.join(marks, "id", "left").select("id", "text", "paths", "windows")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return map_batches(marked, run, f"{schema}, kept string" if with_text else schema)
