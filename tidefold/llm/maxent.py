"""Scores of texts by a hashed maximum-entropy language model with class-factored softmax.

Tokens are the words of a text, A-Z in lower case, and one end. The probability of a word given those before it is that of its
class, times that of its slot within the class, times its share of the slot. Slots stand for words: the ``OWN`` most frequent
words have one each, and all others share ``SLOTS - OWN`` by hash; a class is ``MEMBERS`` slots of neighbouring frequency. The
first two factors are softmaxes over sums of weights, one weight row per feature: the last one, two and three slots, and, as
skip features, the slots two and three places back; rows are hashed. The third factor is context-free and exact: counts of
all words over all training documents, however many there are, so that no word is left out and none is cut off.

Training starts from the slots' frequencies. Each task walks through its documents and updates its copy of the weights after
each batch of tokens, by observed minus expected counts of feature rows; what is expected is drawn from the model's own
distribution, which keeps the gradient unbiased. The copies are then averaged row by row, weighted by how often a task met
the row; with more ``rounds`` the average is where the next one starts. What the driver holds is the weight tables (3 MB for any
corpus), the ``OWN`` words' hashes and three numbers per slot.

Nulls: a null text is empty, and an empty text is its end alone. A null id counts as empty text where held-out documents are
chosen. Repeated rows are documents of their own. With no training documents all weights are zero. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.chunks import DOCUMENT, ENTRY, by_chunk, chunked, column
from tidefold.llm.common import Bytes, Words, mixed, pieces, range_hashes, reachable, signed, written

SLOTS = 512
OWN = 256
MEMBERS = 16
CLASSES = SLOTS // MEMBERS
FEATURES = 5
# Rows of the weight tables, powers of two.
CLASS_ROWS = 1 << 13
SLOT_ROWS = 1 << 15
# Tokens per update, and the step: a row seen n times in a batch moves by its mean gradient times RATE * n / (n + INERTIA).
BATCH = 1 << 13
RATE = 1.5
INERTIA = 20.0
FOLDS, HELD_FOLD = 7, 2

# Bytes of text in a chunk: the more, the fewer chunks a word is listed in.
CHUNK_BYTES = 8 << 20
# Tokens scored at once, if not a single document has more.
_TOKENS = 1 << 17
_DOCUMENT = "doc_id long, held_out boolean, tokens array<int>"
_ENTRY = "place int, word binary, h long, n long"


def encoded(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_FOLD) -> DataFrame:
    """Documents as places in their chunk's dictionary, and the dictionary: word, hash, occurrences in training documents."""
    return chunked(_picked(docs, folds, fold), lambda: _encode, _DOCUMENT, _ENTRY, CHUNK_BYTES)


def _picked(docs: DataFrame, folds: int, fold: int) -> DataFrame:
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.crc32(name) % folds == fold).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _lowered(column_: pa.Array) -> tuple[Bytes, Words, np.ndarray]:
    source = Bytes(column_)
    data = source.data.copy()
    data[(data >= ord("A")) & (data <= ord("Z"))] += 32
    return source, Words(source), data


def _with_ends(of_words: np.ndarray, end, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The values of all words with ``end`` after those of each text, and where texts begin and the last one ends."""
    starts = np.zeros(len(words.count) + 1, np.int64)
    starts[1:] = np.cumsum(words.count + 1)
    out = np.full(starts[-1], end, of_words.dtype)
    out[np.arange(len(of_words)) + words.row] = of_words
    return out, starts


def _encode(batch: pa.RecordBatch) -> tuple[dict, dict]:
    source, words, data = _lowered(batch.column("text"))
    lengths = words.end - words.begin
    inside = np.zeros(len(data) + 1, np.int8)
    inside[words.begin] += 1
    inside[words.end] -= 1
    text = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    # The last entry is the end, which no word is: it has no bytes.
    ends = np.zeros(len(lengths) + 2, np.int64)
    ends[1:-1], ends[-1] = np.cumsum(lengths), lengths.sum()
    found = pa.Array.from_buffers(pa.large_binary(), len(lengths) + 1, [None, pa.py_buffer(ends), pa.py_buffer(text)]).dictionary_encode()
    codes = found.indices.to_numpy()
    tokens, starts = _with_ends(codes[:-1], codes[-1], words)
    learned = np.repeat(~_held(batch), np.diff(starts))
    entries = found.dictionary
    at = np.frombuffer(entries.buffers()[1], np.int64)[: len(entries) + 1]
    body = entries.buffers()[2]
    body = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    documents = {
        "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
        "tokens": pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(tokens)),
    }
    dictionary = {
        "place": np.arange(len(entries), dtype=np.int32), "word": entries, "h": signed(range_hashes(body, at[:-1], at[1:])),
        "n": np.bincount(tokens[learned], minlength=len(entries)),
    }
    return documents, dictionary


def _held(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    return np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)


@dataclass
class Model:
    """Weights and what is known of the slots; the same few megabytes whatever the corpus."""

    own: np.ndarray  # hashes of the words with a slot of their own, the most frequent first
    inside: np.ndarray  # tokens of each slot in training documents
    kinds: np.ndarray  # distinct words of each slot in training documents
    tokens: int
    distinct: int
    by_class: np.ndarray = field(default_factory=lambda: np.zeros((CLASS_ROWS, CLASSES), np.float32))
    by_slot: np.ndarray = field(default_factory=lambda: np.zeros((SLOT_ROWS, MEMBERS), np.float32))

    def __post_init__(self) -> None:
        self.order = np.argsort(self.own, kind="stable")
        share = (self.inside + 1) / (self.tokens + SLOTS)
        of_class = share.reshape(CLASSES, MEMBERS).sum(axis=1)
        self.class_bias = np.log(of_class).astype(np.float32)
        self.slot_bias = np.log(share.reshape(CLASSES, MEMBERS) / of_class[:, None]).astype(np.float32)
        # Natural logarithm of what a word's count plus one is divided by.
        self.spread = np.log(self.inside + self.kinds + 1.0)

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hashed word."""
        shared = OWN + (h & np.uint64(SLOTS - OWN - 1)).astype(np.int64)
        if not len(self.own):
            return shared
        ranked = self.own[self.order]
        at = np.minimum(np.searchsorted(ranked, h), len(ranked) - 1)
        return np.where(ranked[at] == h, self.order[at], shared)


def features(slots: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Hashed features of the places before each token; ``starts`` are the first tokens of texts."""
    back = [slots]
    for _ in range(3):
        before = np.empty_like(slots)
        before[1:] = back[-1][:-1]
        before[starts] = SLOTS
        back.append(before)
    one, two, three = (b.astype(np.uint64) for b in back[1:])
    width = np.uint64(2 * SLOTS)
    grams = (one, one + two * width, one + (two + three * width) * width, two, three)
    return [mixed(g * np.uint64(8) + np.uint64(kind + 1)) for kind, g in enumerate(grams)]


def rows_of(keys: list[np.ndarray], classes: np.ndarray | None = None) -> list[np.ndarray]:
    """Weight rows of the features: of the class table, or of the slot table given the classes."""
    if classes is None:
        return [(k & np.uint64(CLASS_ROWS - 1)).astype(np.int64) for k in keys]
    salt = (classes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return [(((k ^ salt) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64) & (SLOT_ROWS - 1) for k in keys]


def weighted(table: np.ndarray, rows: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    """Sums of the weights of each token's features, one column per outcome."""
    z = np.empty((len(rows[0]), table.shape[1]), np.float32)
    z[:] = bias
    one = np.empty_like(z)
    for r in rows:
        z += np.take(table, r, axis=0, out=one, mode="clip")
    # Exponentials have room for sums like these; larger ones are shifted.
    return z if not z.size or z.max() < _ROOM else z - z.max(axis=1, keepdims=True)


_ROOM = 60.0


def log_probability(model: Model, slots: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Natural logarithm of the probability of each slot after its history."""
    classes, member = slots // MEMBERS, slots % MEMBERS
    out = np.zeros(len(slots))
    for begin in range(0, len(slots), BATCH):
        part = slice(begin, begin + BATCH)
        c, m, k = classes[part], member[part], [x[part] for x in keys]
        out[part] = _chance(model.by_class, rows_of(k), model.class_bias, c)
        out[part] += _chance(model.by_slot, rows_of(k, c), model.slot_bias[c], m)
    return out


def _chance(table: np.ndarray, rows: list[np.ndarray], bias: np.ndarray, target: np.ndarray) -> np.ndarray:
    z = weighted(table, rows, bias)
    hit = z[np.arange(len(target)), target].astype(np.float64)
    return hit - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], np.float32))


def _step(table: np.ndarray, seen: np.ndarray, rows: list[np.ndarray], bias: np.ndarray, target: np.ndarray, draw: np.ndarray) -> None:
    """One update: towards the targets, away from one draw per token from the model's distribution."""
    z = weighted(table, rows, bias)
    width = table.shape[1]
    share = np.exp(z, out=z) @ np.triu(np.ones((width, width), np.float32))
    below = (share < (draw * share[:, -1])[:, None]).astype(np.float32) @ np.ones(width, np.float32)
    drawn = np.minimum(below.astype(np.int64), width - 1)
    every = np.concatenate(rows)
    met = np.bincount(every, minlength=len(table))
    step = (RATE / len(rows) / (met + INERTIA)).astype(np.float32)[every]
    flat = table.reshape(-1)
    np.add.at(flat, every * width + np.tile(target, len(rows)), step)
    np.subtract.at(flat, every * width + np.tile(drawn, len(rows)), step)
    seen += met


def learn(model: Model, slots: np.ndarray, starts: np.ndarray, seed: int | list[int], seen: tuple[np.ndarray, np.ndarray]) -> None:
    """Updates of the model's tables by the tokens of some texts, in place; ``seen`` counts the rows' tokens."""
    keys = features(slots, starts)
    draws = np.random.default_rng(seed).random((2, len(slots)), np.float32)
    for begin in range(0, len(slots), BATCH):
        part = slice(begin, begin + BATCH)
        k, c = [x[part] for x in keys], slots[part] // MEMBERS
        _step(model.by_class, seen[0], rows_of(k), model.class_bias, c, draws[0, part])
        _step(model.by_slot, seen[1], rows_of(k, c), model.slot_bias[c], slots[part] % MEMBERS, draws[1, part])


_WEIGHTS = "kind int, row int, seen double, weights array<float>"


def train(docs: DataFrame, model: Model, rounds: int = 1) -> Model:
    """The model after so many rounds over all training documents (``text``)."""
    spark = docs.sparkSession
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            own = _copy(shared.value)
            seen = np.zeros(CLASS_ROWS), np.zeros(SLOT_ROWS)
            first = TaskContext.get().partitionId() << 32
            for at, batch in enumerate(pieces(batches)):
                _, words, data = _lowered(batch.column("text"))
                hashes, starts = _with_ends(range_hashes(data, words.begin, words.end), _END, words)
                learn(own, own.slots(hashes), starts[:-1], [number, first + at], seen)
            for kind, (weights, met) in enumerate(zip((own.by_class, own.by_slot), seen, strict=True)):
                at = np.flatnonzero(met)
                yield _weight_rows(kind, at, met[at], weights[at])

        copies = docs.mapInArrow(run, _WEIGHTS)
        # Sums of whole tables, not of groups: a task holds one table however many copies there are.
        averaged = copies.repartition("kind", "row").mapInArrow(_averages, _WEIGHTS).collect()
        model = _copy(model)
        for r in averaged:
            (model.by_class, model.by_slot)[r["kind"]][r["row"]] = r["weights"]
        shared.destroy()
    return model


# The hash of no bytes.
_END = range_hashes(np.zeros(1, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64))[0]


def _copy(model: Model) -> Model:
    return Model(model.own, model.inside, model.kinds, model.tokens, model.distinct, model.by_class.copy(), model.by_slot.copy())


def _weight_rows(kind: int, at: np.ndarray, seen: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    ends = np.arange(len(at) + 1, dtype=np.int32) * weights.shape[1]
    flat = pa.array(weights.astype(np.float32).ravel())
    arrays = [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(seen), pa.ListArray.from_arrays(pa.array(ends), flat)]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "row", "seen", "weights"])


def _averages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = [np.zeros((CLASS_ROWS, CLASSES)), np.zeros((SLOT_ROWS, MEMBERS))]
    seen = [np.zeros(CLASS_ROWS), np.zeros(SLOT_ROWS)]
    for batch in batches:
        kinds, rows, met = (batch.column(c).to_numpy() for c in ("kind", "row", "seen"))
        lists = batch.column("weights")
        for kind, table in enumerate(total):
            mine = np.flatnonzero(kinds == kind)
            weights = lists.take(pa.array(mine)).flatten().to_numpy().reshape(len(mine), table.shape[1])
            order = np.argsort(rows[mine], kind="stable")
            row, new = np.unique(rows[mine][order], return_index=True)
            if len(row):
                table[row] += np.add.reduceat((weights * met[mine, None])[order], new, axis=0)
                seen[kind] += np.bincount(rows[mine], weights=met[mine], minlength=len(table))
    for kind, table in enumerate(total):
        at = np.flatnonzero(seen[kind])
        yield _weight_rows(kind, at, seen[kind][at], table[at] / seen[kind][at, None])


def counted(chunks: DataFrame) -> DataFrame:
    """Each chunk's words with their occurrences in all training documents: chunk, place, h, c; ``first`` in one of a word's rows.

    Each word has a row per chunk at most, and a shuffle by word both counts it and leaves the count with each row.
    """
    same = Window.partitionBy("h", "word").orderBy("chunk")
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    entries = chunks.where(F.col("kind") == ENTRY)
    return entries.select("chunk", "place", "h", F.sum("n").over(every).alias("c"), (F.row_number().over(same) == 1).alias("first"))


def untrained(counts: DataFrame) -> Model:
    """The model with zero weights: the slots and what is in them."""
    words = counts.where("first AND c > 0").select("h", "c")
    own = [r["h"] for r in words.orderBy(F.desc("c"), "h").limit(OWN).collect()]
    inside, kinds = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for r in _with_slots(words, own).groupBy("slot").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        inside[r["slot"]], kinds[r["slot"]] = r["c"], r["n"]
    return Model(np.array(own, np.int64).view(np.uint64), inside, kinds, int(inside.sum()), int(kinds.sum()))


def _with_slots(words: DataFrame, own: list[int]) -> DataFrame:
    """``slot`` of each hashed word, as ``Model.slots`` gives it; ``own`` are OWN hashes at most."""
    ranks = words.sparkSession.createDataFrame(list(enumerate(own)), "rank int, h long")
    shared = F.lit(OWN) + F.pmod("h", F.lit(SLOTS - OWN))
    return words.join(F.broadcast(ranks), "h", "left").withColumn("slot", F.coalesce(F.col("rank"), shared).cast("int")).drop("rank")


def scored(chunks: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """Scores of all documents, each chunk next to the corpus counts of its words."""
    # Two numbers a row, as there are many: place and slot in one, then the count; of a document its id, and less than zero.
    known = _with_slots(counts, model.own.view(np.int64).tolist())
    known = known.select("chunk", (F.col("place").cast("long") * SLOTS + F.col("slot")).alias("a"), F.col("c").alias("b"))
    texts = chunks.where(F.col("kind") == DOCUMENT)
    texts = texts.select("chunk", F.col("doc_id").alias("a"), F.when(F.col("held_out"), -2).otherwise(-1).cast("long").alias("b"), "tokens")
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    def run(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        total = math.log(model.tokens + model.distinct + 1)
        for table in tables:
            text = table["b"].to_numpy() < 0
            docs, found = (table.filter(pa.array(x)).combine_chunks() for x in (text, ~text))
            place, of_place = np.divmod(column(found, "a").to_numpy(), SLOTS)
            count, slot = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            count[place], slot[place] = column(found, "b").to_numpy(), of_place
            tokens = column(docs, "tokens")
            places = tokens.flatten().to_numpy()
            starts = np.concatenate(([0], np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)))
            share, met = np.log(count + 1.0), (count > 0).astype(np.int64)
            known, base, chance = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows), np.zeros(docs.num_rows)
            begin = 0
            while begin < docs.num_rows:
                # Some documents at a time, or one.
                end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + _TOKENS, side="right")) - 1)
                mine, heads = places[starts[begin] : starts[end]], starts[begin:end] - starts[begin]
                slots = slot[mine]
                scores = log_probability(model, slots, features(slots, heads)) + share[mine] - model.spread[slots]
                # Every document has a token, its end, so no stretch is empty.
                for out, values in ((known, met[mine]), (base, share[mine] - total), (chance, scores)):
                    out[begin:end] = np.add.reduceat(values, heads)
                begin = end
            arrays = [
                column(docs, "a"), pa.array(column(docs, "b").to_numpy() == -2), pa.array(np.diff(starts)), pa.array(known),
                pa.array(np.full(docs.num_rows, model.tokens, np.int64)), pa.array(base / math.log(10)), pa.array(chance / math.log(10)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_chunk(texts.unionByName(known, allowMissingColumns=True), run, schema)


def score(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_FOLD, rounds: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams), score (the model), both log10."""
    reachable(docs.sparkSession)
    chunks = written(encoded(docs, folds, fold), "chunks")
    counts = written(counted(chunks), "counts")
    learned = _picked(docs, folds, fold).where("NOT held_out").select("text")
    return scored(chunks, counts, train(learned, untrained(counts), rounds))
