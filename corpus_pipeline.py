"""Documents to packed training sequences, in five stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm import minhash, mixing, packing, pii, quality
from tidefold.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; each row is judged by its own text, and a null text does not pass."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id. Rows without an id, or whose id names several
    texts, all stay."""
    return minhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text. Rows stay as many as they are, whatever their ids."""
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes its first word: not at all, or up to three times. Rows are told apart by a number of
    their own, so null and shared ids are like any others."""
    row, times = (_unused(docs, name) for name in ("row", "times"))
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    copies = mixing.mix(numbered, row=row).where("copies > 0").select(F.col("_row").alias(row), F.col("copies").alias(times))
    repeated = numbered.join(copies, row).withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return repeated.select(docs.columns)


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences; each row is a document of its own."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixed_sources", mixed_sources),
    ("packed", packed),
]

#: Samples by hashed random numbers, fitted weights and tokenizer ids are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
