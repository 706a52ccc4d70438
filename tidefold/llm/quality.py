"""Quality rules: counts over a text, and its distance from what is usual in its language.

A document is rejected if it is too short or repeats itself (base rules), or if its histogram of character classes or of
common words lies too far from its language's, by Jensen-Shannon distance (0 equal, 1 disjoint). The languages' histograms
come from all documents and all words, of any length, by grouped aggregation. Texts too short for a histogram to mean anything are
not compared.

How far a text without any common word can be from its language depends on the share s of its words that common ones are:
0.33 at s = 0.2, 0.42 at s = 0.31. So besides the fixed limit, what a text lacks of common words altogether is compared with
that farthest distance, if the text is long enough to be expected to hold ``MIN_EXPECTED`` of them.

Nulls: a null text has no words, so it fails the base rules; a null language is a language of its own. Repeated rows are
judged one by one. An empty table gives no rows. Columns other than the three named ones are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import Bytes, Words, map_batches, mixed, range_hashes, signed, written

MIN_WORDS = 10
REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
# A histogram is compared from so many code points or words on.
MIN_CLASS_CHARS = 200
MIN_COMMON_WORDS = 100
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.42
# A text lacks common words if its distance, with all of them taken as one, is so much of what a text without any has.
MAX_LACK = 0.8
MIN_EXPECTED = 20
COMMON_WORDS = 64
# Languages with a reference of their own, by number of words; the rest share the reference of all.
LANGUAGES = 256
_FLUSH = 1 << 18
EVERY = ("every language",)

# Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

LOWER, UPPER, DIGIT, SPACE, PUNCTUATION, SYMBOL, WIDE, CONTINUATION = range(8)
CLASSES = CONTINUATION


def _class_table() -> np.ndarray:
    out = np.full(256, PUNCTUATION, dtype=np.uint8)
    out[0x61:0x7B], out[0x41:0x5B], out[0x30:0x3A] = LOWER, UPPER, DIGIT
    out[0x00:0x21] = SPACE
    out[list(b"#*$%&|<>@^_~`\\{}[]=+/")] = SYMBOL
    out[0x80:0xC0], out[0xC0:] = CONTINUATION, WIDE
    return out


_CLASS = _class_table()
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 32
_ENDS_WORD = np.isin(np.arange(256), list(b".,;:!?"))


def _per_row(source: Bytes, mask: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[source.starts[1:]] - total[source.starts[:-1]]


def _class_counts(source: Bytes) -> np.ndarray:
    row = np.repeat(np.arange(source.rows), np.diff(source.starts))
    return np.bincount(row * 8 + _CLASS[source.data], minlength=8 * source.rows).reshape(-1, 8)[:, :CLASSES]


def _word_items(words: Words) -> np.ndarray:
    """A 64-bit hash of each word; case and a final mark are left off."""
    data = words.source.data
    if not len(words.begin):
        return np.zeros(0, np.int64)
    end = words.end - (_ENDS_WORD[data[words.end - 1]] & (words.end - words.begin > 1))
    return signed(range_hashes(_LOWERED[data], words.begin, end))


def histograms(docs: DataFrame) -> DataFrame:
    """How often each character class (kind 0) and each word (kind 1, by hash) occurs in each language: lang, kind, item, n."""

    def count(batches):
        total: dict = defaultdict(int)

        def flush():
            keys = list(total)
            out = {"lang": pa.array([k[0] for k in keys], pa.string()), "kind": pa.array([k[1] for k in keys], pa.int32())}
            out |= {"item": pa.array([k[2] for k in keys], pa.int64()), "n": pa.array(list(total.values()), pa.int64())}
            total.clear()
            return out

        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            names = [*coded.dictionary.to_pylist(), None]
            lang = coded.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            source = Bytes(batch.column("text"))
            words = Words(source)
            classes = np.zeros((len(names), CLASSES), np.int64)
            np.add.at(classes, lang, _class_counts(source))
            for at, kind in zip(*np.nonzero(classes), strict=True):
                total[names[at], 0, int(kind)] += int(classes[at, kind])
            item, of = _word_items(words), lang[words.row]
            order = np.lexsort((item, of))
            item, of = item[order], of[order]
            first = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (of[1:] != of[:-1]))[: len(item)])
            n = np.diff(np.append(first, len(item)))
            for at, key, times in zip(of[first].tolist(), item[first].tolist(), n.tolist(), strict=True):
                total[names[at], 1, key] += times
            if len(total) > _FLUSH:
                yield flush()
        yield flush()

    rows = map_batches(
        docs.select("lang", F.coalesce("text", F.lit("")).alias("text")), count, "lang string, kind int, item long, n long"
    )
    # Dealt out by item, so that what follows by item or by item and language needs no other shuffle.
    return rows.repartition("kind", "item").groupBy("lang", "kind", "item").agg(F.sum("n").alias("n"))


class Reference:
    """Shares of the character classes, and of the common words and all others, in one language."""

    def __init__(self, classes: dict[int, int], words: dict[int, int], n_words: int) -> None:
        self.classes = np.array([classes.get(k, 0) for k in range(CLASSES)], float) / max(1, sum(classes.values()))
        self.items = np.array(sorted(words), np.int64)
        shares = [words[k] / max(1, n_words) for k in sorted(words)]
        self.words = np.array([*shares, max(0.0, 1 - sum(shares))])
        # The share of the common words together, and how far a text without any is.
        self.common = 1 - self.words[-1]
        self.farthest = float(distance(np.array([0.0, 1.0]), np.array([self.common, self.words[-1]])))


def references(docs: DataFrame) -> dict:
    """The references of the languages with most words, and under ``EVERY`` that of all documents together.

    The driver gets at most (LANGUAGES + 1) * (COMMON_WORDS + classes + 1) rows, whatever the corpus.
    """
    in_language = F.struct(F.struct("lang", F.lit(False).alias("every")).alias("of"), "n")
    in_all = F.struct(F.struct(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every")).alias("of"), F.sum("n").alias("n"))
    items = histograms(docs).groupBy("kind", "item").agg(F.collect_list(in_language).alias("each"), in_all.alias("all"))
    both = written(items, "histograms").select(F.explode(F.concat("each", F.array("all"))).alias("at"), "kind", "item")
    both = both.select("at.of", "kind", "item", "at.n")
    size = both.where("kind = 1").groupBy("of").agg(F.sum("n").alias("size"))
    size = size.orderBy(F.desc("size"), "of").limit(LANGUAGES + 1).select(F.col("of").alias("large"), "size")
    best = Window.partitionBy("of", "kind").orderBy(F.desc("n"), "item")
    top = both.withColumn("place", F.row_number().over(best)).where(F.col("place") <= COMMON_WORDS)
    parts: dict = defaultdict(lambda: ({}, {}, [1]))
    for r in top.join(F.broadcast(size), F.col("of") == F.col("large")).collect():
        name = EVERY if r["of"]["every"] else r["of"]["lang"]
        parts[name][r["kind"]][r["item"]] = r["n"]
        parts[name][2][0] = r["size"]
    return {name: Reference(classes, words, n[0]) for name, (classes, words, n) in parts.items()}


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance, base 2, between each row of p and q."""
    m = (p + q) / 2

    def toward(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=-1)

    return np.sqrt(np.clip((toward(p) + toward(q)) / 2, 0, 1))


def repeated_words(words: Words) -> np.ndarray:
    """Words of each text that lie in a window of five which the text holds twice or more."""
    n, k = len(words.begin), REPEAT_WINDOW
    if n < k:
        return np.zeros(words.source.rows, np.int64)
    at = np.arange(n - k + 1)
    at = at[words.row[at] == words.row[at + k - 1]]
    keys = range_hashes(words.hashes(), at, at + k) ^ mixed(words.row[at].astype(np.uint64))
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + k, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover)[:n] > 0)))
    return covered[words.first[1:]] - covered[words.first[:-1]]


def repeated_lines(source: Bytes, words: Words) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    breaks = np.flatnonzero(source.data == 0x0A)
    begin = np.sort(np.concatenate((source.starts[:-1], breaks + 1)))
    # A line ends at its break or where its text ends.
    begin = begin[begin < len(source.data)]
    if not len(begin):
        return np.zeros(source.rows, np.int64)
    begin = np.unique(begin)
    row = source.row_of(begin)
    after = np.searchsorted(breaks, begin)
    end = np.minimum(source.starts[row + 1], np.append(breaks, len(source.data))[after])
    holds = np.searchsorted(words.begin, end) > np.searchsorted(words.begin, begin)
    begin, end, row = begin[holds], end[holds], row[holds]
    keys = range_hashes(source.data, begin, end) ^ mixed(row.astype(np.uint64))
    _, kept = np.unique(keys, return_index=True)
    return np.bincount(row, minlength=source.rows) - np.bincount(row[kept], minlength=source.rows)


def _verdicts(batch: pa.RecordBatch, known: dict) -> dict:
    """Counts, distances and verdict of each row of a batch with lang and text."""
    source = Bytes(batch.column("text"))
    words = Words(source)
    classes = _class_counts(source)
    n_chars = classes.sum(axis=1)
    row, items = words.row, _word_items(words)
    class_distance, word_distance = np.zeros(source.rows), np.zeros(source.rows)
    lacks = np.zeros(source.rows, bool)
    by_lang = defaultdict(list)
    for i, name in enumerate(batch.column("lang").to_pylist()):
        by_lang[name if name in known else EVERY].append(i)
    for name, members in by_lang.items():
        if name not in known:
            continue
        ref, members = known[name], np.array(members)
        class_distance[members] = distance(classes[members] / np.maximum(1, n_chars[members])[:, None], ref.classes)
        place = np.full(source.rows, -1)
        place[members] = np.arange(len(members))
        mine = place[row] >= 0
        at = np.searchsorted(ref.items, items[mine])
        hit = ref.items[np.minimum(at, len(ref.items) - 1)] == items[mine] if len(ref.items) else np.zeros(len(at), bool)
        wide = len(ref.items) + 1
        counts = np.bincount(place[row[mine]][hit] * wide + at[hit], minlength=wide * len(members)).reshape(-1, wide).astype(float)
        counts[:, -1] = words.count[members] - counts[:, :-1].sum(axis=1)
        n_words = np.maximum(1, words.count[members])
        word_distance[members] = distance(counts / n_words[:, None], ref.words)
        other = counts[:, -1] / n_words
        lack = distance(np.stack((1 - other, other), axis=1), np.array([ref.common, ref.words[-1]]))
        lacks[members] = (1 - other < ref.common) & (lack > MAX_LACK * ref.farthest) & (n_words * ref.common >= MIN_EXPECTED)
    repeats = repeated_words(words)
    failed = (words.count < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * words.count)
    class_distance[n_chars < MIN_CLASS_CHARS] = np.nan
    word_distance[words.count < MIN_COMMON_WORDS] = np.nan
    far = (class_distance > MAX_CLASS_DISTANCE) | (word_distance > MAX_WORD_DISTANCE) | lacks & (words.count >= MIN_COMMON_WORDS)
    in_word = np.zeros(len(source.data) + 1, np.int64)
    in_word[words.begin] += 1
    np.subtract.at(in_word, words.end, 1)
    lead = (np.cumsum(in_word[:-1]) > 0) & (_CLASS[source.data] != CONTINUATION)
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": _per_row(source, lead).astype(np.int64),
        "n_symbols": _per_row(source, _IS_SYMBOL[source.data]).astype(np.int64),
        "n_dup_lines": repeated_lines(source, words).astype(np.int64),
        "n_repeat_words": repeats.astype(np.int64),
        "class_distance": pa.array(class_distance, from_pandas=True),
        "word_distance": pa.array(word_distance, from_pandas=True),
        "base_failed": failed,
        "kept": ~failed & ~far,
    }


def judge(docs: DataFrame) -> DataFrame:
    """Counts, distances and verdict of each row of ``docs`` (doc_id, lang, text), by references made from the same rows."""
    known = references(docs)
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "class_distance double, word_distance double, base_failed boolean, kept boolean"
    )

    def run(batches):
        for batch in batches:
            yield {"doc_id": batch.column("doc_id"), **_verdicts(batch, known)}

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(picked, run, schema)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. (A null text does not, so none is passed on.)"""
    known = references(docs)
    names = docs.columns

    def run(batches):
        for batch in batches:
            kept = pa.array(_verdicts(batch, known)["kept"])
            yield {name: batch.column(name).filter(kept) for name in names}

    return map_batches(docs.where("text IS NOT NULL"), run, docs.schema)
