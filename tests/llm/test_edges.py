"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; then the whole pipeline."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.test_operators import near_oracle
from tidefold.llm import debruijn, langid, minhash, mixing, packing, pii, quality, queries, spotsigs, suffixdedup, warc

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "some ordinary text that says a thing or two about the weather of the day", "en", "s"),
    (2, None, "en", "s"), (3, "", "en", None), (4, LONG, "en", "s"), (5, LONG, None, "s"), (5, LONG, None, "s"),
    (None, "a text without a number", None, None), (7, " \n\t ", "zz", "t"), (8, "x", "en", "s"), (9, "\u00e9" * 500, "fr", "\u00e9"),
    (-3, "negative", "en", "s"), (11, LONG[:9000], "en", "s"), (11, "short " + LONG[2000:8000], "en", "s"), (12, LONG[1000:7000], "en", "s"), (2**62, "large id", "en", "s"),
]
# Names that the operators use inside.
EXTRA = ("id", "h", "n", "key", "keys", "spans", "kept", "rep", "bucket", "order", "size", "block", "digest", "target", "copies")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

DOCUMENTS = {
    "quality": quality.judge, "pii": pii.find, "debruijn": debruijn.deduplicate, "suffixes": suffixdedup.deduplicate,
    "mixing": mixing.mix, "minhash": minhash.classes, "spotsigs": spotsigs.compare_edited, "packing": packing.pack_documents,
}


def table(spark, rows):
    df = spark.createDataFrame([(*r, None) for r in rows], SCHEMA)
    return df.withColumns({c: F.lit(1) for c in EXTRA})


@pytest.mark.parametrize("name", DOCUMENTS)
def test_odd_rows(spark, name):
    got = DOCUMENTS[name](table(spark, ROWS))
    ids = sorted(r[0] for r in got.select("doc_id").where("doc_id IS NOT NULL").distinct().collect())
    assert ids == sorted({r[0] for r in ROWS if r[0] is not None})
    assert got.where("doc_id IS NULL").count() == 1
    if name != "packing":
        assert got.count() == len(ROWS)


@pytest.mark.parametrize("name", DOCUMENTS)
def test_no_rows(spark, name):
    assert DOCUMENTS[name](table(spark, [])).count() == 0


@pytest.mark.parametrize("name", DOCUMENTS)
def test_one_row(spark, name):
    assert DOCUMENTS[name](table(spark, [(1, "one two three", "en", "s")])).count() == 1


def test_repeated_rows_have_defined_results(spark):
    df = table(spark, ROWS)
    words = {(r.doc_id, r.n_removed) for r in debruijn.deduplicate(df).collect()}
    assert (4, 0) in words and (5, 60_000) in words  # removed by 4, not by each other
    found = {r.doc_id: r.n_removed for r in suffixdedup.deduplicate(df).collect()}
    assert found[4] == found[5] == len(LONG)
    near = {r.doc_id: r.class_id for r in minhash.classes(df).collect()}
    assert near[5] == near[4] == 4 and near[None] is None and near[8] == 8
    # 5 goes with 4; 2 and 3 are equal; the two texts under 11 both stay.
    assert len(minhash.keep_one(df).collect()) == len({r[0] for r in ROWS}) - 1 - 1 + 1


def test_stages_lose_nothing(spark):
    """Null and shared ids, and extra columns of any name, through all stages that keep the columns of documents."""
    docs = table(spark, ROWS + [(None, "a text without a number", None, None), (11, "third text of one id", "en", "s")])
    docs = docs.withColumns({c: F.lit(1) for c in ("row", "row_", "times", "_row", "lo", "hi", "n_copies")})
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, DATA).cache()
        if name == "quality_rules":
            assert got.columns == docs.columns
            continue
        if name == "packed":
            assert got.where("piece = 0").count() == docs.count()
            continue
        assert got.columns == docs.columns
        texts_ = sorted(str(r.doc_id) for r in got.collect())
        if name == "near_duplicates":
            assert texts_.count("11") == 3 and texts_.count("None") == 2 and texts_.count("5") == 0
        if name == "personal_data":
            assert texts_ == sorted(str(r.doc_id) for r in docs.collect())
        if name == "mixed_sources":
            taken = [r.copies for r in mixing.mix(docs).collect()]
            assert len(texts_) == sum(taken)
    empty = table(spark, [])
    assert all(stage(spark, empty, DATA).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_long_runs_neither_stop_nor_slow_the_patterns():
    nines, letters = "9" * 5000, "a" * 400_000
    assert pii.base_spans(f"1.1.1.{nines}") == [] and pii.base_spans("1.1.1.000255 ") == [(0, "ip", 12)]
    for text in (letters + "@", "@" * 100_000, "1" * 400_000, "1." * 100_000, "+" * 200_000, "a@" * 100_000, letters + "@x.y" + letters, "." * 300_000):
        pii.base_spans(text)
    plain = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice("ab.@@ -%9") for _ in range(rng.randrange(14)))
        assert pii._emails(text) == [m.span() for m in plain.finditer(text)], text
    octets = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
    for _ in range(4000):
        text = "".join(rng.choice("0129...a ") for _ in range(rng.randrange(24)))
        want = [m.span() for m in octets.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert [(b, e) for b, k, e in pii.base_spans(text) if k == "ip"] == want, text


def test_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    docs = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(none).count() == 0
    assert langid.identify(none, docs).count() == 0
    odd = spark.createDataFrame([(None, None, None), (1, "", ""), (1, "x://", "<"), (2, "http://h", LONG)], "page_id long, url string, html string")
    odd = odd.withColumns({c: F.lit(1) for c in ("file", "offset", "host", "text", "digest", "p0")})
    assert warc.round_trip(odd).count() == 4
    assert [r.lang for r in langid.identify(odd, docs).collect()] == [None] * 4
    some = spark.read.parquet(f"{DATA}/documents.parquet")
    assert langid.identify(odd, some).where("lang IS NOT NULL").count() == 4


def test_every_operator_is_registered():
    names = list(queries.QUERIES)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_pipeline(spark):
    """Each stage against what it has to do with what the stage before left."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    left = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, left = left, stage(spark, left, DATA).cache()
        seen[name] = left
        if name != "packed":
            assert left.schema.simpleString() == docs.schema.simpleString()
        if name == "quality_rules":
            want = {r.doc_id for r in quality.judge(before).where("kept").collect()}
            assert {r.doc_id for r in left.collect()} == want and len(want) > 100
        if name == "near_duplicates":
            texts = {r.doc_id: r.text for r in before.collect()}
            assert sorted(r.doc_id for r in left.collect()) == sorted(set(near_oracle(texts).values()))
        if name == "personal_data":
            assert {r.doc_id for r in left.collect()} == {r.doc_id for r in before.collect()}
            assert not any(pii.base_spans(r.text) for r in left.collect())
            assert all(r.n_chars == len(r.text) for r in left.collect())
        if name == "mixed_sources":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
            assert {r.doc_id: r["count"] for r in left.groupBy("doc_id").count().collect()} == {i: n for i, n in copies.items() if n}
        if name == "packed":
            assert left.where("piece = 0").count() == before.count()
    assert seen["packed"].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
