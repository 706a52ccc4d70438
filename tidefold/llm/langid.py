"""Language of web pages by Bayesian fusion of evidence.

Evidence on a page: its visible text, the language its markup declares, the suffix of its address, and its host. The text's
likelihood in each language comes from hashed byte trigrams of all documents of that language. How well declarations and suffixes
tell the language is learned from the pages: each counts with the languages its text makes probable, so what authors
declare wrongly weighs little. A host's prior is its pages' mean (the page itself left out), smoothed toward that of its suffix,
and this toward all pages. All counts are grouped sums over all rows.

Any number of languages, suffixes, declarations and hosts has a part. A row carries one number for each language, and a task holds the
model, 16 KB for each; the driver sees the languages' names and shares only, and no plan grows with their number. What is known of a host
is a written table before pages are joined with it, so that the pages of a hot host can be split.

Nulls: a null html has no text and declares nothing, a null url has no host and no suffix; what is missing is no
evidence. A page without any evidence has the languages' overall shares. Repeated rows are pages of their own. Without documents no
language is known, and ``lang`` is null; an empty page table gives no rows.
"""

from __future__ import annotations

import html as markup
import re

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefold.llm.common import Bytes, map_batches, reachable, written
from tidefold.session import scratch_path

BUCKETS = 4096
# A counting task holds the trigrams of so many languages, or the sums of so many hosts and the like, and then lets them go.
HELD = 64
HELD_VALUES = 1 << 12
# Trigrams of a text are not independent; a longer text counts as so many of them.
MAX_TRIGRAMS = 60
SMOOTHING = 2.0
HOST_SMOOTHING = 5.0

_HIDDEN = re.compile(r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")
_DECLARED = re.compile(r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,8})""")
_HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")

_LETTER = np.zeros(256, np.uint8)
_LETTER[0x61:0x7B] = np.arange(1, 27)
_LETTER[0x41:0x5B] = np.arange(1, 27)
_LETTER[0x80:] = np.arange(27, 155)


def visible(page: str) -> str:
    return markup.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def _trigrams(source: Bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of letters (all else is one gap), and the row of each."""
    code = _LETTER[source.data].astype(np.uint32)
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joined = code[:-2] << np.uint32(16) | code[1:-1] << np.uint32(8) | code[2:]
    row = np.repeat(np.arange(source.rows), np.diff(source.starts))
    good = (row[:-2] == row[2:]) & (code[1:-1] > 0)
    return (joined[good] * np.uint32(2654435761) >> np.uint32(20)).astype(np.int64), row[:-2][good]


def languages(docs: DataFrame) -> list[str]:
    """All languages, those with most documents first."""
    counted = docs.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"))
    return [r["lang"] for r in counted.orderBy(F.desc("n"), "lang").collect()]


def model(docs: DataFrame, names: list[str]) -> str:
    """Writes log P(trigram | language), a line per language in order of ``names``, and returns the folder."""
    index = {name: i for i, name in enumerate(names)}

    def count(batches):
        held: dict[int, np.ndarray] = {}

        def flush():
            for lang, total in held.items():
                at = np.flatnonzero(total)
                yield {"lang": np.full(len(at), lang, np.int32), "item": at.astype(np.int32), "n": total[at]}
            held.clear()

        for batch in batches:
            lang = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
            item, row = _trigrams(Bytes(batch.column("text")))
            of = lang[row]
            for each in np.unique(of).tolist():
                if each not in held and len(held) == HELD:
                    yield from flush()
                counted = np.bincount(item[of == each], minlength=BUCKETS)
                held[each] = held[each] + counted if each in held else counted
        yield from flush()

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, packed = batch.column("lang").to_pylist(), []
            for counts in batch.column("counts").to_pylist():
                line = np.full(BUCKETS, 0.5)
                for c in counts:
                    line[c["item"]] += c["n"]
                packed.append(np.log(line / line.sum()).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.int32()), pa.array(packed, pa.binary())], ["lang", "line"])

    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sums = map_batches(known, count, "lang int, item int, n long").groupBy("lang", "item").agg(F.sum("n").alias("n"))
    each = sums.groupBy("lang").agg(F.collect_list(F.struct("item", "n")).alias("counts"))  # at most BUCKETS items
    folder = scratch_path(docs.sparkSession, "languages")
    each.mapInArrow(lines, "lang int, line binary").write.parquet(folder)
    return folder


def _loaded(folder: str, size: int) -> np.ndarray:
    """The model as lines of numbers; a language without any trigram has an even line."""
    table = np.full((size, BUCKETS), -np.log(BUCKETS), np.float32)
    files, path = pafs.FileSystem.from_uri(folder)
    for batch in pads.dataset(path, filesystem=files, format="parquet").to_batches():
        for lang, line in zip(batch.column("lang").to_pylist(), batch.column("line"), strict=True):
            table[lang] = np.frombuffer(line.as_buffer(), np.float32)
    return table


def evidence(pages: DataFrame, folder: str, size: int) -> DataFrame:
    """page_id, host, suffix, declared, and ``scores``, the text's log-likelihoods."""

    def run(batches):
        table = None
        for batch in batches:
            table = _loaded(folder, size) if table is None else table
            pages_, urls = batch.column("text").to_pylist(), batch.column("url").to_pylist()
            source = Bytes(pa.array([visible(p) for p in pages_], pa.string()))
            item, row = _trigrams(source)
            n = np.bincount(row, minlength=source.rows)
            scale = np.minimum(1.0, MAX_TRIGRAMS / np.maximum(1, n))
            scores = np.array([np.bincount(row, weights=line[item], minlength=source.rows) * scale for line in table]).reshape(size, source.rows)
            hosts = [(m[1].lower().rstrip(".") if u and (m := _HOST.match(u)) else None) for u in urls]
            yield {
                "page_id": batch.column("page_id"),
                "host": pa.array(hosts, pa.string()),
                "suffix": pa.array([h.rsplit(".", 1)[-1] if h and "." in h else None for h in hosts], pa.string()),
                "declared": pa.array([m[1].lower() if (m := _DECLARED.search(p)) else None for p in pages_], pa.string()),
                "scores": _lists(scores.T),
            }

    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("text"))
    return map_batches(picked, run, "page_id long, host string, suffix string, declared string, scores array<double>")


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, size = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * size, pa.int32()), pa.array(np.ascontiguousarray(matrix).ravel(), pa.float64()))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists of ``size`` numbers as rows; a null list is a row of zeros."""
    known = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), size))
    out[known] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return out


def _normal(logs: np.ndarray) -> np.ndarray:
    """Probabilities from log-probabilities up to a constant, by row."""
    parts = np.exp(logs - logs.max(axis=1, keepdims=True))
    return parts / parts.sum(axis=1, keepdims=True)


EVIDENCE = ("host", "suffix", "declared")


def soft_counts(rows: DataFrame, size: int) -> DataFrame:
    """What the texts of all pages of a host, suffix or declaration make probable: kind, value, ``sums`` by language, n.

    Kind "all" holds all pages. Tasks add up their pages before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def flush():
            if held:
                kinds, values = zip(*held, strict=True)
                sums = np.array([x[0] for x in held.values()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.string()), pa.array(values, pa.string()), _lists(sums), pa.array([x[1] for x in held.values()], pa.int64())],
                    ["kind", "value", "sums", "n"],
                )
                held.clear()

        for batch in batches:
            p = _normal(_matrix(batch.column("scores"), size))
            for kind in ("all", *EVIDENCE):
                values = [""] * batch.num_rows if kind == "all" else batch.column(kind).to_pylist()
                number: dict[str, int] = {}
                of = np.array([-1 if v is None else number.setdefault(v, len(number)) for v in values], np.int64)
                sums = np.zeros((len(number), size))
                np.add.at(sums, of[of >= 0], p[of >= 0])
                counts = np.bincount(of[of >= 0], minlength=len(number))
                for value, total, n in zip(number, sums, counts.tolist(), strict=True):
                    if have := held.get((kind, value)):
                        have[0] += total
                        have[1] += n
                    else:
                        held[kind, value] = [total, n]
            if len(held) > HELD_VALUES:
                yield from flush()
        yield from flush()

    reachable(rows.sparkSession)
    partial = rows.select("scores", *EVIDENCE).mapInArrow(run, "kind string, value string, sums array<double>, n long")
    numbers = partial.select("kind", "value", "n", F.posexplode("sums").alias("i", "x"))
    each = numbers.groupBy("kind", "value", "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    lists = each.groupBy("kind", "value").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("all"), F.first("n").alias("n"))
    return lists.select("kind", "value", F.col("all.x").alias("sums"), "n")


def fused(rows: DataFrame, names: list[str], mass: np.ndarray) -> DataFrame:
    """Each page's language, from its scores and from what is known of its host, suffix and declaration (``host_sums``, ``host_n`` ...)."""
    size, share = len(names), mass / mass.sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = np.array(names, dtype=object)
        for batch in batches:
            scores = _matrix(batch.column("scores"), size)
            text = _normal(scores)
            sums, known = {}, {}
            for kind in EVIDENCE:
                column = batch.column(f"{kind}_sums")
                known[kind] = column.is_valid().to_numpy(zero_copy_only=False)[:, None]
                sums[kind] = _matrix(column, size), np.array(batch.column(f"{kind}_n").fill_null(0), np.float64)[:, None]
            prior = share
            for kind in ("suffix", "host"):
                total, n = sums[kind]
                # The page's own text is taken out of the sums that make its prior.
                prior = (np.where(known[kind], total - text, 0.0) + HOST_SMOOTHING * prior) / (np.where(known[kind], n - 1, 0.0) + HOST_SMOOTHING)
            logs = scores + np.log(np.maximum(prior, 1e-9))
            for kind in ("declared", "suffix"):
                told = np.log((sums[kind][0] + SMOOTHING * share) / (mass + SMOOTHING))
                logs += np.where(known[kind], told, 0.0)
            q = _normal(logs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), pa.array(labels[q.argmax(axis=1)], pa.string()), pa.array(q.max(axis=1)),
                    pa.array(labels[text.argmax(axis=1)], pa.string()), batch.column("declared"), batch.column("suffix"),
                ],
                ["page_id", "lang", "posterior", "text_lang", "declared", "suffix"],
            )

    reachable(rows.sparkSession)
    return rows.mapInArrow(run, "page_id long, lang string, posterior double, text_lang string, declared string, suffix string")


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, posterior, text_lang (by the text alone), declared, suffix."""
    names = languages(docs)
    found = evidence(pages, model(docs, names), len(names))
    if not names:
        none = F.lit(None)
        return found.select("page_id", none.cast("string").alias("lang"), none.cast("double").alias("posterior"), none.cast("string").alias("text_lang"), "declared", "suffix")
    rows = written(found, "evidence")
    counts = written(soft_counts(rows, len(names)), "soft-counts")
    overall = counts.where("kind = 'all'").select("sums").first()
    mass = (np.array(overall["sums"]) if overall else np.zeros(len(names))) + 1.0
    for kind in EVIDENCE:
        # No side is told to be broadcast: the planner knows the size of a written table.
        known = written(counts.where(F.col("kind") == kind).select(F.col("value").alias(kind), F.col("sums").alias(f"{kind}_sums"), F.col("n").alias(f"{kind}_n")), f"{kind}-counts")
        rows = rows.join(known, kind, "left")
    return fused(rows, names, mass)
