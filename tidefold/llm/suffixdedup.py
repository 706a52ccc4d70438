"""Deduplication of long byte strings by suffix arrays of shards.

Each window of ``LENGTH`` bytes has an anchor, the k-mer of smallest hash in it, so equal windows have equal anchors, and a window whose
anchor occurs once is no repeat. The windows of an anchor follow each other; the bytes they cover are its context. An anchor whose
contexts are all equal needs no more work, nor does a context that occurs twice. The other contexts, one copy of each, are cut
into steps of ``STEP`` windows. The windows of a step share their middle: contexts whose middles differ (by a 128-bit
digest) have no equal window in this step, and where they agree, the middle is written as one symbol between the bytes before
and after it. A shard, chosen by the middle, sorts these strings by a suffix array (``suffixes``), in which equal windows are
neighbours, and the permuted common prefixes tell which are. An anchor with more than ``SHARD_CONTEXTS`` different contexts (2 MB of such strings a step) could fill a
task; its windows are compared by grouped aggregation of 128-bit digests instead. Either way a window is a repeat if it
stands at two different places, of one document or of two, and the result is the same.

Nulls: a null text is empty. Texts shorter than ``LENGTH`` keep all their bytes. Rows without id are left whole and not
compared. Repeated rows are documents of their own, so they remove each other if long enough; different texts under one id
are not told apart, so an id should name one text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import Bytes, anchors, map_batches, mixed, range_hashes, signed, texts, written
from tidefold.llm.suffixes import permuted_prefixes, suffix_array

LENGTH = 400
KMER = 32
STEP = 64
SHARD_BYTES = 4 << 20
SHARD_CONTEXTS = 16384


def context_rows(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """Anchors: id, pos (byte), h (k-mer), b and e (its context), d (hash of the context and of the anchor's place in it)."""

    def run(batches):
        for batch in batches:
            source = Bytes(batch.column("text"))
            n = len(source.data)
            at = np.arange(max(0, n - k + 1))
            row = np.repeat(np.arange(source.rows), np.diff(source.starts))
            at = at[row[: len(at)] == row[k - 1 :]] if len(at) else at
            kmers = range_hashes(source.data, at, at + k)
            chosen, first, last = anchors(kmers, row[at], length - k + 1) if len(at) else (at, at, at)
            pos, h, begin, end = at[chosen], kmers[chosen], at[first], at[last] + length
            d = range_hashes(source.data, begin, end, 1) ^ mixed((pos - begin).astype(np.uint64))
            owner = row[pos] if len(pos) else pos
            shift = source.starts[owner]
            yield {
                "id": batch.column("id").take(pa.array(owner)), "h": signed(h), "d": signed(d),
                "pos": pos - shift, "b": (begin - shift), "e": (end - shift),
            }

    return map_batches(docs, run, "id long, h long, d long, pos long, b long, e long")


def step_rows(docs: DataFrame, wanted: DataFrame, length: int, step: int) -> DataFrame:
    """The steps of contexts (id, h, pos, b, e): x and y (digest of anchor, step and middle), id, s (where the first window
    begins), sides (the bytes before and after the middle; what is outside the text is 0xFF, which no text has)."""
    lists = wanted.groupBy("id").agg(F.collect_list(F.struct("h", "pos", "b", "e")).alias("at"))
    side = step - 1

    def run(batches):
        for batch in batches:
            source = Bytes(batch.column("text"))
            contexts = batch.column("at")
            flat = contexts.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(contexts.offsets.to_numpy()))
            base = source.starts[row]
            h, pos, b, e = (flat.field(c).to_numpy() for c in ("h", "pos", "b", "e"))
            fits = e <= np.diff(source.starts)[row]
            h, pos, b, e, row, base = (v[fits] for v in (h, pos, b, e, row, base))
            # A window that begins r bytes before the anchor is in step r // step, so equal windows are in equal steps.
            low, high = (pos - (e - length)) // step, (pos - b) // step
            times = high - low + 1
            which = np.repeat(np.arange(len(h)), times)
            number = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + low[which]
            inner = (base + pos)[which] - number * step  # where the middle begins: its last window does
            outer = inner + length - side
            x, y = (range_hashes(source.data, inner, outer, seed) for seed in (0, 1))
            salt = mixed(h[which].view(np.uint64) + number.astype(np.uint64))
            begin, end = source.starts[row[which]], source.starts[row[which] + 1]
            offsets = np.concatenate((np.arange(-side, 0), np.arange(side) + length - side))
            places = inner[:, None] + offsets
            inside = (places >= begin[:, None]) & (places < end[:, None])
            sides = np.where(inside, source.data[np.clip(places, 0, len(source.data) - 1)], np.uint8(0xFF))
            yield {
                "x": signed(x ^ salt), "y": signed(y + salt), "id": batch.column("id").take(pa.array(row[which])),
                "s": inner - side - begin,
                "sides": pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * side), len(which), [None, pa.py_buffer(np.ascontiguousarray(sides))]).cast(pa.binary()),
            }

    return map_batches(docs.join(lists, "id").select("id", "text", "at"), run, "x long, y long, id long, s long, sides binary")


_MIDDLE = np.uint8(0xFF)


def repeated_starts(group: np.ndarray, sides: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of the windows of each row (bytes before and after its group's middle) that stand at two places.

    ``place`` is that of a row's first window; those of the following windows are the numbers after it.
    """
    n, side = len(sides), step - 1
    lines = np.zeros((n, 2 * step), np.uint8)
    lines[:, :side], lines[:, step : step + side] = sides[:, :side] + np.uint8(1), sides[:, side:] + np.uint8(1)
    lines[:, side] = _MIDDLE
    holes = np.concatenate((np.zeros((n, 1), np.int64), np.cumsum(lines == 0, axis=1)), axis=1)
    whole = np.zeros(lines.shape, bool)
    whole[:, :step] = holes[:, step : 2 * step] == holes[:, :step]
    text = lines.ravel()
    order = suffix_array(text, step)
    same = permuted_prefixes(text, order, step) >= step
    order_whole = whole.ravel()[order]
    kind = np.cumsum(~same[order])[order_whole]
    at = order[order_whole]
    row = at // (2 * step)
    # Equal strings around different middles are different windows.
    rank = np.argsort(kind * (int(group.max()) + 1) + group[row], kind="stable")
    at, row, kind = at[rank], row[rank], kind[rank]
    new = np.flatnonzero((np.diff(kind, prepend=-1) != 0) | (np.diff(group[row], prepend=-1) != 0))
    places = place[row] + (at % (2 * step)).astype(np.uint64)
    several = np.minimum.reduceat(places, new) != np.maximum.reduceat(places, new)
    found = np.sort(at[several.repeat(np.diff(np.append(new, len(at))))])
    return found // (2 * step), found % (2 * step)


def spans_of(row: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the stretches that windows from the given starts, in order, cover."""
    if not len(row):
        return row, row, row
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + length)
    first = np.flatnonzero(new)
    return row[first], start[first], start[np.append(first[1:], len(start)) - 1] + length


def in_shards(steps: DataFrame, shards: int, length: int, step: int) -> DataFrame:
    """Repeated stretches among the steps of each shard: id, b, e."""
    schema = pa.schema([("id", pa.int64()), ("b", pa.int64()), ("e", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        keys = np.stack([table["x"].to_numpy(), table["y"].to_numpy()], axis=1)
        _, group, times = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
        group = group.ravel()
        shared = np.flatnonzero(times[group] > 1)
        if not len(shared):
            return schema.empty_table()
        data = table["sides"].combine_chunks().take(pa.array(shared))
        sides = np.frombuffer(data.buffers()[2], np.uint8)[: len(shared) * 2 * (step - 1)].reshape(len(shared), -1)
        ids = table["id"].fill_null(-1).to_numpy()[shared]
        s = table["s"].to_numpy()[shared]
        row, window = repeated_starts(group[shared], sides, mixed(ids.view(np.uint64)) + s.astype(np.uint64), step)
        row, begin, end = spans_of(row, s[row] + window, length)
        owners = table["id"].take(pa.array(shared[row]))
        return pa.table({"id": owners, "b": begin, "e": end}, schema=schema)

    sharded = steps.withColumn("shard", F.pmod(F.xxhash64("x", "y"), F.lit(shards)))
    return sharded.groupBy("shard").applyInArrow(run, "id long, b long, e long")


def context_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of contexts (id, h, pos, b, e): id, h, pos, b, data."""
    lists = wanted.groupBy("id").agg(F.collect_list(F.struct("h", "pos", "b", "e")).alias("at"))

    def run(batches):
        kinds = {"id": pa.int64(), "h": pa.int64(), "pos": pa.int64(), "b": pa.int64(), "data": pa.binary()}
        for batch in batches:
            source = Bytes(batch.column("text"))
            ids, lists, out = batch.column("id").to_pylist(), batch.column("at").to_pylist(), []
            for row, contexts in enumerate(lists):
                base = int(source.starts[row])
                out += [(ids[row], c["h"], c["pos"], c["b"], source.data[base + c["b"] : base + c["e"]].tobytes()) for c in contexts]
            yield {name: pa.array(c, t) for (name, t), c in zip(kinds.items(), zip(*out, strict=True), strict=True)}

    return map_batches(docs.join(lists, "id").select("id", "text", "at"), run, "id long, h long, pos long, b long, data binary")


def by_digest(contexts: DataFrame, length: int) -> DataFrame:
    """The same for contexts of crowded anchors: every window's digest, and the places where it stands."""

    def run(batches):
        for batch in batches:
            source = Bytes(batch.column("data"))
            starts = np.arange(max(0, len(source.data) - length + 1))
            owner = source.row_of(starts)
            fits = source.starts[owner + 1] - starts >= length
            starts, owner = starts[fits], owner[fits]
            shift = batch.column("b").to_numpy() - source.starts[:-1]
            yield {
                "id": batch.column("id").take(pa.array(owner)), "s": starts + shift[owner],
                "x": signed(range_hashes(source.data, starts, starts + length, 0)),
                "y": signed(range_hashes(source.data, starts, starts + length, 1)),
            }

    windows = map_batches(contexts.withColumnRenamed("data", "text"), _renamed(run), "id long, s long, x long, y long")
    windows = written(windows, "windows")
    place = F.xxhash64("id", "s")
    several = windows.groupBy("x", "y").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo < hi").select("x", "y")
    return windows.join(several, ["x", "y"], "left_semi").select("id", F.col("s").alias("b"), (F.col("s") + length).alias("e"))


def _renamed(run):
    def over(batches):
        yield from run(b.rename_columns(["data" if n == "text" else n for n in b.schema.names]) for b in batches)

    return over


def repeats(docs: DataFrame, length: int = LENGTH, k: int = KMER, step: int = STEP) -> DataFrame:
    """Stretches to remove: id, b, e, overlapping."""
    found = written(context_rows(docs, length, k), "contexts")
    nodes = found.groupBy("h").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).where("n > 1")
    # Written, as an aggregation between shuffle and join would keep the rows of a hot anchor in one task.
    nodes = written(nodes.select("h", (F.col("lo") == F.col("hi")).alias("alike")), "nodes")
    again = written(found.join(nodes, "h"), "again")
    unlike = again.where("NOT alike")
    one = F.min_by(F.struct("id", "pos", "b", "e"), F.struct("id", "pos")).alias("one")
    several = written(unlike.groupBy("h", "d").agg(F.count("*").alias("n"), one).select("h", "d", "n", "one.*"), "several")
    copies = unlike.join(several.where("n > 1").select("h", "d"), ["h", "d"], "left_semi")
    parts = [again.where("alike").unionByName(copies).select("id", "b", "e")]
    counts = several.groupBy("h").agg(F.count("*").alias("contexts"))
    crowded = written(counts.where(F.col("contexts") > SHARD_CONTEXTS).select("h"), "crowded")
    columns = ("id", "h", "pos", "b", "e")
    usual = several.select(*columns)
    if not crowded.isEmpty():
        usual = usual.join(crowded, "h", "left_anti")
        full = several.select(*columns).join(crowded, "h", "left_semi")
        parts.append(by_digest(written(context_bytes(docs, full), "bytes"), length))
    steps = several.agg(F.sum((F.col("e") - F.col("b") - length) / step + 2)).first()[0] or 0
    shards = max(1, -(-int(steps) * 2 * step // SHARD_BYTES))
    parts.append(in_shards(step_rows(docs, usual, length, step), shards, length, step))
    return reduce(DataFrame.unionAll, parts)


def deduplicate(docs: DataFrame, length: int = LENGTH, k: int = KMER, with_bytes: bool = True) -> DataFrame:
    """Each document without its repeated bytes: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, ``with_bytes``, kept."""
    every = texts(docs)
    spans = repeats(every.where("id IS NOT NULL"), length, k, min(STEP, length // 2)).groupBy("id").agg(F.collect_set(F.struct("b", "e")).alias("spans"))

    def run(batches):
        for batch in batches:
            source = Bytes(batch.column("text"))
            kept, removed, pieces = [], [], []
            for row, spans in enumerate(batch.column("spans").to_pylist()):
                data = source.text(row)
                parts, at, n = [], 0, 0
                end = -1
                for b, e in sorted((s["b"], s["e"]) for s in spans or ()):
                    if b > end:
                        parts.append(data[at:b])
                        n += 1
                    at = end = max(end, e)
                kept.append(b"".join([*parts, data[at:]]))
                removed.append(len(data) - len(kept[-1]))
                pieces.append(n)
            yield {
                "doc_id": batch.column("id"),
                "n_bytes": np.diff(source.starts),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(pieces, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                "kept": pa.array(kept, pa.binary()) if with_bytes else None,
            }

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    marked = every.join(spans, "id", "left").select("id", "text", "spans")
    return map_batches(marked, run, schema)
