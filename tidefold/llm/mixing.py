"""Mixing sources to target weights, with DataFrame functions only.

The words of a source, its documents in a hashed order, are cut into blocks of fixed length. A source's target becomes a
number of draws of its blocks; each draw falls on an output shard by a hash, so the counts of the sources in a
shard are a multinomial draw whose totals are the targets. Draw j of a source with n blocks takes block
(a * j + c) mod n: a permutation of the block numbers, run through again when the draws exceed the blocks, so no block
is used a second time before all have been used once. Blocks and draws are joined by source and block number, which no
key dominates. Where the words of a source begin is a running sum in two steps, over buckets of rows and inside each,
so that a hot source is not one task.

Nulls: a null text has no words, and null is a source of its own, last in order. Documents without words take no
part (taken 0). Repeated rows are documents of their own. Equal ids are told apart by size only, which is enough, since equal
rows may stand for one another. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefold.llm.common import written

BLOCK_WORDS = 64
MAX_EPOCHS = 3
BUCKET_ROWS = 512
SHARD_DRAWS = 1 << 16
CHUNK = 4096
TASK_DRAWS = 1 << 18
# A prime above any number of blocks of one source; its multiples permute the block numbers.
_PRIME = 2147483647
_SEED = 7

WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, size in words, and ``_s``, a key for the source that is never null; ``_row`` is the column that tells rows apart."""
    own = [F.col(row).alias("_row")] if row else []
    return docs.select(
        *own,
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("-")).alias("_s"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Target of each source (source, _s, source_size): shares of all words by weight 1, 2, 3, 1, ... in order of the
    source's name, none above MAX_EPOCHS times its size, what is above reshared by weight.

    Sources by size for their weight: the first ones are full, and the rest share what these leave. The windows hold one row
    per source.
    """
    order = Window.orderBy(F.asc_nulls_last("source"))
    full = Window.orderBy("ratio", F.asc_nulls_last("source"))
    every = Window.partitionBy(F.lit(0))
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    most = F.col("source_size") * MAX_EPOCHS
    return (
        sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
        .withColumn("ratio", most / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum(most).over(before), F.lit(0))) / F.sum("weight").over(after))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(every))
        .withColumn("target", F.least(most.cast("double"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight")))
        .select("source", "_s", "source_size", "target")
    )


def with_draws(sources: DataFrame, block: int) -> DataFrame:
    """Number of blocks of each source, and of draws that make its target."""
    blocks = F.ceil(F.col("source_size") / block)
    draws = F.round(F.col("target") * blocks / F.greatest(F.col("source_size"), F.lit(1)))
    return sources.withColumn("blocks", blocks.cast("long")).withColumn("draws", draws.cast("long"))


def permuted(number: Column, n: Column, key: Column) -> Column:
    """A permutation of 0 .. n - 1 for each key."""
    step = F.lit(_PRIME) % n * (F.lit(_PRIME) % n) % n  # coprime to n, as the prime is
    return F.pmod(step * F.pmod(number, n) + F.pmod(F.xxhash64(F.lit(_SEED), key), n), n)


def draw(sources: DataFrame) -> DataFrame:
    """One row per draw: shard, _s, draw (its number in the source), block."""
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("draws") - 1) / CHUNK))
    total = sources.agg(F.sum("draws")).first()[0] or 0
    shards = max(1, -(-total // SHARD_DRAWS))
    first = F.col("chunk") * CHUNK
    # The chunks are dealt out before they become draws: a hot source has most of them.
    spread = sources.where("draws > 0").select("_s", "blocks", "draws", F.explode(chunks).alias("chunk"))
    spread = spread.repartition(max(1, -(-total // TASK_DRAWS)), "_s", "chunk")
    each = F.sequence(first, F.least(first + CHUNK, F.col("draws")) - 1)
    draws = spread.select("_s", "blocks", F.explode(each).alias("draw"))
    shard = F.pmod(F.xxhash64(F.lit(_SEED), "_s", "draw"), F.lit(shards))
    return draws.select(shard.alias("shard"), "_s", "draw", permuted(F.col("draw"), F.col("blocks"), F.col("_s")).alias("block"))


def placed(rows: DataFrame, sources: DataFrame, sums: DataFrame, buckets: int) -> DataFrame:
    """Each document with the place of its first word in its source (``start``), and what its source is due."""
    over = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(over), F.lit(0)))
    offsets = offsets.join(sources, "_s").select("_s", "_bucket", "offset", "source_size", "target")
    inside = Window.partitionBy("_s", "_bucket").orderBy("doc_id", "size", *(c for c in rows.columns if c == "_row"))
    earlier = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = rows.withColumn("_n", F.row_number().over(inside)).withColumn("_before", earlier)
    return counted.join(offsets, ["_s", "_bucket"]).withColumn("start", F.col("offset") + F.col("_before"))


def pieces(documents: DataFrame, block: int) -> DataFrame:
    """Each document once per block that holds words of it, with the number of these words."""
    end = F.col("start") + F.col("size")
    numbers = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block)))
    exploded = documents.withColumn("block", F.explode_outer(numbers))
    words = F.least(end, (F.col("block") + 1) * block) - F.greatest(F.col("start"), F.col("block") * block)
    return exploded.withColumn("words", F.coalesce(words, F.lit(0)))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, row: str | None = None) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken, and ``copies``, how often its first word is taken.

    ``row`` names a column of ``docs`` that tells its rows apart; it comes back as ``_row``.
    """
    own = ["_row"] if row else []
    rows = written(sized(docs, row), "sizes")
    buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
    sums = written(rows.groupBy("source", "_s", "_bucket").agg(F.sum("size").alias("words")), "sums")
    sources = written(with_draws(targets(sums.groupBy("source", "_s").agg(F.sum("words").alias("source_size"))), block), "sources")
    used = draw(sources).groupBy("_s", "block").agg(F.count("*").alias("times"))
    parts = pieces(placed(rows, sources, sums.drop("source"), buckets), block)
    # The draws come from a table of a few rows, by which the planner would judge them small enough to broadcast.
    taken = parts.join(used.hint("merge"), ["_s", "block"], "left").withColumn("times", F.coalesce("times", F.lit(0)))
    first = F.floor(F.col("start") / block)
    return (
        taken.groupBy("_s", "_bucket", "_n", *own, "doc_id", "size", "source_size", "target")
        .agg(
            F.sum(F.col("words") * F.col("times")).cast("long").alias("taken"),
            F.max(F.when(F.col("block") == first, F.col("times"))).alias("copies"),
        )
        .select(*own, "doc_id", "size", "source_size", "target", "taken", F.coalesce("copies", F.lit(0)).cast("long").alias("copies"))
    )
