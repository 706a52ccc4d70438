"""The corpus operators over the given tables, with production parameters, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidefold.llm import alignment, debruijn, langid, maxent, minhash, mixing, packing, pii, quality, spotsigs, suffixdedup, turns, warc
from tidefold.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "pages"), table(spark, sf, "documents"))


@query
def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find(table(spark, sf, "documents"))


@query
def op3_debruijn_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return debruijn.deduplicate(table(spark, sf, "documents"), with_text=False)


@query
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


SQL["op4_warc"] = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages
), f AS (
    SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h
)
SELECT page_id, n AS payload_bytes, p.h AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h"""


@query
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents"))


@query
def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixdedup.deduplicate(table(spark, sf, "documents"))


@query
def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query
def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.classes(table(spark, sf, "documents"))


@query
def op9_spotsigs(spark: SparkSession, sf: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf, "documents"))


@query
def op10_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"))


@query
def op11_maxent_lm(spark: SparkSession, sf: str) -> DataFrame:
    return maxent.score(table(spark, sf, "documents"))


@query
def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return turns.repair(table(spark, sf, "conversations"))


QUERIES["pipeline"] = corpus_pipeline.run
