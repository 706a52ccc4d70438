"""Near-duplicate classes by weighted minhash: improved consistent weighted sampling over TF-IDF shingles.

A document is the bag of its five-word shingles (all its words, if it has fewer), weighted by count times inverse document frequency.
A shingle is at most as frequent as its rarest word, whose document frequency is counted over all documents in
``WORD_BUCKETS`` hashed buckets. Each of BANDS * ROWS samples picks a shingle with probability in proportion to weight, the same
one in two documents as often as their weighted Jaccard similarity says; documents that agree in all samples of a band share a
bucket. Equal texts are one text here.

Candidates are verified by their exact weighted Jaccard similarity, without listing the pairs of a bucket. First all
members are compared with the bucket's leader, the member that meets most others over all bands. Where a bucket still holds several
classes, its texts are known by what they differ in from the leader, and those that can share enough of these differences are compared:
first each text with the one of each difference that is nearest to others (``hub_pairs``), then, of those not connected yet, each pair
(``candidates``). So every pair of a bucket is verified, connected already, or ruled out exactly; what is left to chance is only
whether a similar pair shares a bucket at all (missed once in 100 000 at similarity 0.8).

Nulls: a null text is empty; texts without words are near only to equal texts. A row without id is a class of its own, of id
null. Repeated rows are one class; different texts under one id are not told apart, so an id should name one text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import Bytes, Words, map_batches, mixed, range_hashes, signed, texts, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 16
ROWS = 3
WORD_BUCKETS = 1 << 16
# The random numbers of a sample come from one table of this size, read at another place by each sample.
_TABLE = 1 << 16
_SEED = 20250101
SLOTS = 1 << 20


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Number of documents with a word of each hashed bucket, and of all documents; WORD_BUCKETS numbers for any corpus."""

    def count(batches):
        total, rows = np.zeros(WORD_BUCKETS, np.int64), 0
        for batch in batches:
            words = Words(Bytes(batch.column("text")))
            seen = np.unique(words.row.astype(np.int64) * WORD_BUCKETS + _bucket(words.hashes()))
            total += np.bincount(seen % WORD_BUCKETS, minlength=WORD_BUCKETS)
            rows += batch.num_rows
        at = np.flatnonzero(total)
        yield {"bucket": np.append(at, -1).astype(np.int64), "n": np.append(total[at], rows).astype(np.int64)}

    rows = map_batches(docs.select("text"), count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros(WORD_BUCKETS, np.int64), 0
    for r in rows:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, n


def inverse(found: tuple[np.ndarray, int]) -> np.ndarray:
    return np.log1p(found[1] / (1.0 + found[0])).astype(np.float32)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


class Shingles:
    """The distinct shingles of a batch of texts by row: row, key, weight, and where each row with any begins."""

    def __init__(self, column: pa.Array, idf: np.ndarray) -> None:
        words = Words(Bytes(column))
        hashes = words.hashes()
        rare = idf[_bucket(hashes)]
        n = len(hashes)
        at = np.arange(max(0, n - SHINGLE + 1))
        at = at[words.row[at] == words.row[at + SHINGLE - 1]] if len(at) else at
        few = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
        begin = np.concatenate((at, words.first[few]))
        end = np.concatenate((at + SHINGLE, words.first[few] + words.count[few]))
        idf_of = np.zeros(len(begin), np.float32)
        for i in range(SHINGLE):
            idf_of = np.maximum(idf_of, np.where(begin + i < end, rare[np.minimum(begin + i, n - 1)], 0)) if n else idf_of
        keys = range_hashes(hashes, begin, end)
        row = words.row[begin] if n else np.zeros(0, np.int64)
        order = np.lexsort((keys, row))
        keys, row, idf_of = keys[order], row[order], idf_of[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(keys)))
        self.rows = len(column)
        self.row, self.key = row[first], keys[first]
        self.weight = (times * idf_of[first]).astype(np.float32)
        self.begin = np.flatnonzero(np.diff(self.row, prepend=-1))
        self.held = self.row[self.begin]


def _random_table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    r = rng.gamma(2.0, 1.0, _TABLE).astype(np.float32)
    return r, np.log(rng.gamma(2.0, 1.0, _TABLE)).astype(np.float32), rng.random(_TABLE, dtype=np.float32)


def samples(s: Shingles, count: int) -> np.ndarray:
    """``count`` consistent weighted samples of each row that has shingles, as 64-bit numbers."""
    r, log_c, beta = _random_table()
    inverse_r, shift = 1 / r, log_c + r * (beta - 1)
    out = np.zeros((len(s.held), count), np.uint64)
    if not len(s.held):
        return out
    log_w = np.log(s.weight)
    lengths = np.diff(np.append(s.begin, len(s.row)))
    dense = np.repeat(np.arange(len(s.held)), lengths)
    for k in range(count):
        odd = np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) & (2**64 - 1) | 1)
        at = ((s.key * odd) >> np.uint64(48)).astype(np.int64)
        t = log_w * inverse_r.take(at)
        t += beta.take(at)
        np.floor(t, out=t)
        # log a = log c - r (t - beta + 1); the smallest is the sample.
        log_a = shift.take(at) - r.take(at) * t
        hit = np.flatnonzero(log_a == np.minimum.reduceat(log_a, s.begin).repeat(lengths))
        chosen = hit[np.flatnonzero(np.diff(dense[hit], prepend=-1))]
        out[:, k] = mixed(s.key[chosen] + t[chosen].astype(np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def signatures(docs: DataFrame, idf: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, digest of the text, and the keys of its bands (none for a text without words)."""

    def run(batches):
        for batch in batches:
            s = Shingles(batch.column("text"), idf)
            drawn = samples(s, bands * rows)
            keys = np.zeros((len(s.held), bands), np.uint64)
            for b in range(bands):
                # The band is part of the key, so buckets of different bands are apart.
                key = np.full(len(s.held), b + 1, np.uint64)
                for k in range(b * rows, (b + 1) * rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, k])
                keys[:, b] = key
            counts = np.zeros(s.rows + 1, np.int32)
            counts[s.held + 1] = bands
            yield {
                "id": batch.column("id"),
                "digest": [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in batch.column("text").to_pylist()],
                "keys": pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), pa.array(signed(keys.ravel()))),
            }

    return map_batches(docs, run, "id long, digest binary, keys array<long>")


def similarity(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each row of the two columns."""
    a, b = Shingles(left, idf), Shingles(right, idf)
    n = len(left)
    row, key = np.concatenate((a.row, b.row)), np.concatenate((a.key, b.key))
    weight = np.concatenate((a.weight, b.weight)).astype(np.float64)
    order = np.lexsort((key, row))
    row, key, weight = row[order], key[order], weight[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (key[1:] == key[:-1]))
    shared = np.bincount(row[same], weights=np.minimum(weight[same], weight[same + 1]), minlength=n)
    total = np.bincount(row, weights=weight, minlength=n)
    return shared / np.maximum(total - shared, 1e-12)


def verified(pairs: DataFrame, held: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) that are similar enough, with ``near``."""
    left, right = (held.select(F.col("id").alias(c), F.col("text").alias(name)) for c, name in (("a", "text"), ("b", "other")))

    def run(batches):
        for batch in batches:
            near = similarity(batch.column("text"), batch.column("other"), idf)
            kept = pa.array(near >= threshold)
            yield {"a": batch.column("a").filter(kept), "b": batch.column("b").filter(kept), "near": pa.array(near).filter(kept)}

    return map_batches(pairs.join(right, "b").join(left, "a"), run, "a long, b long, near double")


def components(links: DataFrame) -> DataFrame:
    """Smallest member of each linked group: id, class_id. In each round members point to their smallest neighbour, pointers are followed
    to their ends, and only links between different ends go on, so that later rounds are of what is left."""
    edges = written(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    found = None
    while True:
        ends = _ends(written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")), "labels"))
        found = ends.select(F.col("a").alias("id"), F.col("c").alias("class_id")) if found is None else written(_renamed(found, ends), "classes")
        left, right = ends.select("a", F.col("c").alias("from")), ends.select(F.col("a").alias("b"), F.col("c").alias("to"))
        rest = edges.join(left, "a").join(right, "b").where(F.col("from") != F.col("to"))
        edges = written(rest.select(F.col("from").alias("a"), F.col("to").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return found


def _ends(label: DataFrame) -> DataFrame:
    """Pointers from ``a`` to ``c``, followed to the members that point to themselves."""
    while True:
        jump = label.select(F.col("a").alias("n"), F.col("c").alias("m"))
        step = label.select("a", F.col("c").alias("n")).join(jump, "n")
        new = written(step.select("a", F.col("m").alias("c"), (F.col("m") < F.col("n")).alias("moved")), "labels")
        if new.where("moved").isEmpty():
            return label.select("a", "c")
        label = new.drop("moved")


def _renamed(classes: DataFrame, ends: DataFrame) -> DataFrame:
    """``classes`` (id, class_id) with the ends (c) of those classes that have one (a)."""
    new = ends.select(F.col("a").alias("class_id"), "c")
    return classes.join(new, "class_id", "left").select("id", F.coalesce("c", "class_id").alias("class_id"))


def merged(classes: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Classes with further links, which are followed between classes only."""
    if classes is not None:
        for column in ("a", "b"):
            known = classes.select(F.col("id").alias(column), F.col("class_id").alias("c"))
            links = links.join(known, column, "left").withColumn(column, F.coalesce("c", column)).drop("c")
    links = written(links.where("a <> b").distinct(), "links")
    if links.isEmpty():
        return classes
    found = components(links)
    if classes is None:
        return found
    # A member of ``links`` is a class, whose smallest member is a row of ``classes``, or a text that had none.
    alone = found.join(classes.select("id"), "id", "left_anti")
    ends = found.select(F.col("id").alias("a"), F.col("class_id").alias("c"))
    return written(_renamed(classes, ends).unionAll(alone.select("id", "class_id")), "classes")


def linked(reps: DataFrame, docs: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame | None:
    """Class of each of the distinct texts ``reps`` (rep, keys) that has any link: id, class_id. None if no two share a bucket."""
    members = reps.select("rep", F.explode("keys").alias("key"))
    # Written before it is joined: an aggregation between shuffle and join would keep a crowded bucket in one task.
    shared = written(members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    met = written(members.join(shared, "key"), "met")
    if met.isEmpty():
        return None
    popular = met.groupBy("rep").agg(F.sum("n").alias("popular"))
    met = written(met.join(popular, "rep").select("key", "rep", "popular"), "buckets")
    held = written(_named(docs, met.select(F.col("rep").alias("id")).distinct()).dropDuplicates(["id"]), "candidates")
    leaders = written(met.groupBy("key").agg(F.max(F.struct("popular", "rep"))["rep"].alias("leader")), "leaders")
    # Many buckets of a large group have one leader, so these are far fewer rows than there are members.
    led = written(met.join(leaders, "key").where(F.col("rep") != F.col("leader")).select("key", "rep", "leader"), "led")
    pairs = written(led.select("leader", "rep").distinct(), "pairs")
    rows = written(compared(pairs, held, idf, threshold), "compared")
    near = rows.where(F.col("kind") == _NEAR).select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    classes = merged(None, near)
    several = written(_several(_in_classes(led, classes)), "open")
    met = shared_differences(rows, several)
    # One pair a text and difference first: most of a crowd that its leader is not in the middle of is connected by these.
    first = written(hub_pairs(met), "pairs")
    links = written(verified(first, held, idf, threshold).select("a", "b"), "links")
    if not links.isEmpty():
        classes = merged(classes, links)
        several = written(_several(_in_classes(led, classes)), "open")
    found = written(candidates(met, several).join(first, ["a", "b"], "left_anti"), "pairs")
    return merged(classes, written(verified(found, held, idf, threshold).select("a", "b"), "links"))


# What a row says of a text and its leader: that they are similar or not, with the text's and the leader's part of what a similar text
# shares of the differences at least; or one difference with its weight.
_NEAR, _FAR, _DIFFERENCE = range(3)


def compared(pairs: DataFrame, held: DataFrame, idf: np.ndarray, threshold: float) -> DataFrame:
    """Each text next to its leader: leader, rep, kind, element (a difference; equal ones from one leader are equal), weight, base."""
    # Of two texts with weights T and U that differ by D, the similarity is (T + U - D) / (T + U + D).
    share = (1 - threshold) / (1 + threshold)
    left, right = (held.select(F.col("id").alias(c), F.col("text").alias(name)) for c, name in (("rep", "text"), ("leader", "other")))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            a, b = Shingles(batch.column("text"), idf), Shingles(batch.column("other"), idf)
            own, theirs = (np.bincount(s.row, weights=s.weight, minlength=n) for s in (a, b))
            row, key = np.concatenate((a.row, b.row)), np.concatenate((a.key, b.key))
            weight = np.concatenate((a.weight, -b.weight)).astype(np.float64)
            order = np.lexsort((key, row))
            row, key, weight = row[order], key[order], weight[order]
            twice = np.flatnonzero((row[1:] == row[:-1]) & (key[1:] == key[:-1]))
            shared = np.bincount(row[twice], weights=np.minimum(np.abs(weight[twice]), np.abs(weight[twice + 1])), minlength=n)
            near = shared / np.maximum(own + theirs - shared, 1e-12) >= threshold
            # One difference per shingle: what the text has more of it, or less.
            weight[twice] += weight[twice + 1]
            weight[twice + 1] = 0
            some = np.flatnonzero(weight)
            row, key, less, weight = row[some], key[some], weight[some] < 0, np.abs(weight[some])
            leader = batch.column("leader").to_numpy().view(np.uint64)
            element = mixed(mixed(key + less.astype(np.uint64)) ^ mixed(leader)[row])
            apart = np.bincount(row, weights=weight, minlength=n)
            part, base = (apart - share * own) / 2, share * theirs / 2
            at = pa.array(np.concatenate((np.arange(n), row)))
            yield {
                "leader": batch.column("leader").take(at), "rep": batch.column("rep").take(at),
                "kind": np.concatenate((np.where(near, _NEAR, _FAR), np.full(len(row), _DIFFERENCE))).astype(np.int32),
                "element": np.concatenate((np.zeros(n, np.int64), signed(element))),
                "weight": np.concatenate((part, weight)).astype(np.float32),
                "base": pa.array(np.concatenate((base, np.zeros(len(row)))).astype(np.float32)),
            }

    schema = "leader long, rep long, kind int, element long, weight float, base float"
    return map_batches(pairs.join(right, "leader").join(left, "rep"), run, schema)


def shared_differences(rows: DataFrame, several: DataFrame) -> DataFrame:
    """What the texts in open buckets (``several``: rep, leader, c) differ in from their leader, where another text of that leader does
    too and the two may be similar enough: element, leader, rep, c, left, part, far, first.

    A text is known by what it differs in from its leader: shingles it has more or less of. Two texts differ by what both differ from
    the leader, less twice what these differences have in common. Neither of two texts in question is similar to the leader and the other
    at once, so a text whose differences weigh D shares about D / 2 of them with the other. Then the two have one of their rarest differences in
    common: one of those that come, in order of rarity, before the ones too light to make up what has to be shared (``first``). And of the first
    one that they have in common, what follows it in either text (``left``) has to be heavy enough for both: two texts whose differences weigh D
    and E share (D + E) / 2 of them, less what similar texts of their weights may differ by. So neither copies with edits of their own
    nor texts that have in common what only their leader lacks are paired here; pairs that are not are ruled out exactly.
    """
    known = rows.where(F.col("kind") != _DIFFERENCE).join(several, ["leader", "rep"])
    known = written(known.withColumn("pair", F.xxhash64("leader", "rep")).withColumnRenamed("weight", "part").drop("element"), "open_pairs")
    open_ = rows.where(F.col("kind") == _DIFFERENCE).drop("base").join(known.select("leader", "rep", "pair"), ["leader", "rep"])
    open_ = written(open_.select("element", "pair", "weight"), "differences")
    # Written, as an aggregation between shuffle and join would keep the rows of a common difference in one task.
    counts = written(open_.groupBy("element").agg(F.count("*").cast("int").alias("n")).where("n > 1"), "common")
    rest = Window.partitionBy("pair").orderBy(F.asc_nulls_first("n"), "element").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ordered = open_.join(counts, "element", "left").withColumn("left", F.sum("weight").over(rest)).where("n IS NOT NULL")
    first = _enough(F.col("left"), F.col("part"), F.col("base")).alias("first")
    met = ordered.join(known, "pair").select("element", "leader", "rep", "c", "left", "part", (F.col("kind") == _FAR).alias("far"), first)
    return written(met.where("far OR first"), "shared")


def hub_pairs(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of each text and, for each of its shared differences, the text with that difference that needs least in common
    with others. They are among the pairs of ``candidates``, but never more than ``met`` has rows."""
    hub = F.min_by(F.struct("rep", "c", "left", "part", "far"), F.struct("part", "rep")).alias("hub")
    # Written before it is joined, like the counts.
    hubs = written(met.where("first").groupBy("element").agg(hub).select("element", "hub.*"), "hubs")
    return _meet(met, hubs, (F.col("far") | F.col("o_far")) & (F.col("first") | ~F.col("o_far"))).distinct()


def candidates(met: DataFrame, several: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts with a leader in common, in open buckets (``several``: rep, leader, c), that may be similar enough: those of
    different classes whose ``shared_differences`` do not rule it out."""
    met = written(met.drop("c").join(several, ["leader", "rep"]), "shared")
    far, near = met.where("far AND first"), met.where("NOT far")
    return _meet(far, far, F.col("rep") < F.col("o_rep")).unionAll(_meet(near, met.where("far"), F.lit(True))).distinct()


def _meet(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    other = right.select("element", *(F.col(c).alias(f"o_{c}") for c in ("rep", "c", "left", "part", "far")))
    enough = _enough(F.least("left", "o_left"), F.col("part"), F.col("o_part"))
    both = left.join(other, "element").where(condition & (F.col("c") != F.col("o_c")) & enough)
    return both.select(F.least("rep", "o_rep").alias("a"), F.greatest("rep", "o_rep").alias("b"))


def _named(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with one of the ids. Most others are left out before the shuffle, by the slots of the ids' hashes:
    these are SLOTS at most, which bounds what is broadcast; how many share a slot only changes what is saved."""
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(ids.select(slot).distinct())
    return docs.select("*", slot).join(slots, "slot", "left_semi").drop("slot").join(ids, "id", "left_semi")


# Sums of floating-point weights may differ by this share, depending on their order.
_SLACK = 1e-6


def _enough(weight: Column, part: Column, other: Column) -> Column:
    """Whether a weight may be as large as two parts together, which may be of different sign."""
    return weight + (1 + F.abs(part) + F.abs(other)) * _SLACK >= part + other


def _in_classes(led: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``led`` with the class of the text, ``c``, and of its leader, ``leader_c``."""
    if classes is None:
        return led.withColumns({"c": F.col("rep"), "leader_c": F.col("leader")})
    for column, found in (("rep", "c"), ("leader", "leader_c")):
        known = classes.select(F.col("id").alias(column), F.col("class_id").alias(found))
        led = led.join(known, column, "left").withColumn(found, F.coalesce(found, column))
    return led


def _several(state: DataFrame) -> DataFrame:
    """Texts (rep, leader, c) that share a bucket with a text of another class, once for each leader that they have there."""
    mixed_ = state.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("leader_c").alias("leader_c"))
    mixed_ = written(mixed_.where("lo < hi OR lo <> leader_c").select("key"), "mixed")
    return state.join(mixed_, "key", "left_semi").select("rep", "leader", "c").distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Class of each row: doc_id, class_id (the smallest id in the class)."""
    every = texts(docs)
    named = every.where("id IS NOT NULL")
    idf = inverse(frequencies(named))
    signed_docs = written(signatures(named, idf, bands, rows), "signatures")
    by_text = signed_docs.groupBy("digest").agg(F.min("id").alias("rep"), F.min_by("keys", "id").alias("keys"))
    reps = written(by_text, "texts")
    joined = linked(reps.select("rep", "keys"), named, idf, threshold)
    of_text = reps.select("digest", "rep")
    if joined is None:
        of_text = of_text.withColumn("class_id", F.col("rep"))
    else:
        of_text = of_text.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        of_text = of_text.withColumn("class_id", F.coalesce("class_id", "rep"))
    found = signed_docs.select("id", "digest").join(of_text.select("digest", "class_id"), "digest")
    lost = every.where("id IS NULL").select(F.col("id").alias("doc_id"), F.col("id").alias("class_id"))
    return found.select(F.col("id").alias("doc_id"), "class_id").unionAll(lost)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but one document of each class: the one with the smallest id, one row of it.

    Rows whose id is null, or names several different texts, cannot be told apart by it; they all stay and are not compared.
    """
    key = F.col("doc_id").cast("long")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    several = docs.groupBy(key.alias("id")).agg(F.min(text).alias("lo"), F.max(text).alias("hi")).where("lo <> hi OR id IS NULL")
    apart = written(several.select("id"), "several")
    same = key.eqNullSafe(apart["id"])
    named, rest = docs.join(apart, same, "left_anti"), docs.join(apart, same, "left_semi")
    kept = classes(named).where("doc_id = class_id").select(F.col("doc_id").alias("id")).distinct()
    one = docs.join(apart, same, "left_anti").join(kept, key == kept["id"], "left_semi")
    return one.dropDuplicates(["doc_id"]).unionAll(rest)
