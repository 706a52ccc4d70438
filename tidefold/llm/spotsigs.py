"""SpotSigs fingerprints, with DataFrame functions only.

Common words are anchors; the signature at an anchor is the chain of the next ``CHAIN`` content words. A text's fingerprint is
the set of hashes of its signatures, written in order. Sets are compared by Jaccard similarity; a search compares only sets
whose lengths allow the threshold, found in the same or a neighbouring length class, that share one of the few smallest hashes
which similar sets must share.

Nulls: a null text is empty. A text with few common words has a chain at every content word, and one without content words is
fingerprinted as a whole, so equal texts always have equal fingerprints and no fingerprint is empty. Null ids come after all others in descending
order; equal ids are ordered by their texts. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 2
# A text with fewer anchors has a chain at every content word; those at its anchors are among them.
FEW = 8
BUCKET_ROWS = 512
RANGES = 256
GROUP = 4096
_MARK = "\u0001"

# Common words of the languages at hand.
ANCHORS = (
    "a an and are as at be been but by for from had has have he her his i if in is it its not of on or she that the their "
    "there they this to was were which will with you "
    "au aux avec ce ces dans de des du elle en est et il la le les mais ne ou par pas plus pour que qui sur un une "
    "als am auf aus bei das dem den der des die ein eine einer es für im ist mit nicht sich sie und von vor wie zu "
    "al como con del el ella ellos en es esta la las lo los más no o para pero por que se sin sobre su sus un una y"
).split()


def signatures(text: Column) -> Column:
    """The set of signature hashes of a text, ascending."""
    common = sorted(set(ANCHORS))
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def marked(words: Column) -> Column:
        """Content words only; one that follows a common word is marked."""
        previous = lambda i: F.get(words, i - 1).isin(common)
        kept = F.transform(words, lambda w, i: F.when(w.isin(common), None).when((i > 0) & previous(i), F.concat(F.lit(_MARK), w)).otherwise(w))
        return F.filter(kept, lambda w: w.isNotNull())

    def hashes(words: Column) -> Column:
        plain = lambda w: F.ltrim(w, F.lit(_MARK))
        chain = lambda w, i: F.hash(plain(w), *(plain(F.get(words, i + k)) for k in range(1, CHAIN)))
        anchored = F.transform(words, lambda w, i: F.when(w.startswith(_MARK), chain(w, i)))
        found = F.filter(anchored, lambda h: h.isNotNull())
        return F.when(F.size(found) >= FEW, found).when(F.size(words) > 0, F.transform(words, chain))

    found = _with(_with(tokens, marked), hashes)
    return F.sort_array(F.array_distinct(F.coalesce(found, F.array(F.hash(F.lit("text"), text)))))


def _with(value: Column, function) -> Column:
    """function(value), with the value computed once however often the function names it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def written_out(hashes: Column) -> Column:
    """A fingerprint as text."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)))), " ")


def jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return shared / (F.size(a) + F.size(b) - shared)


def _below(buckets: DataFrame) -> DataFrame:
    """For each bucket number the next lower one there is, for the lowest the highest: bucket, next_bucket.

    Neighbours are found inside groups of numbers, then between groups, so no task gets all.
    """
    grouped = buckets.select("bucket", F.floor(F.col("bucket") / GROUP).alias("g"))
    inside = Window.partitionBy("g").orderBy(F.desc("bucket"))
    tops = grouped.groupBy("g").agg(F.max("bucket").alias("top"))
    over = Window.orderBy(F.desc("g"))
    highest = F.max("top").over(Window.partitionBy(F.lit(0)))
    tops = tops.select("g", F.coalesce(F.lead("top").over(over), highest).alias("under"))
    return (
        grouped.withColumn("next_bucket", F.lead("bucket").over(inside))
        .join(tops, "g")
        .select("bucket", F.coalesce("next_bucket", "under").alias("next_bucket"))
    )


def _bucket(docs: DataFrame) -> Column:
    """A bucket number for each row of doc_id and order, lower for rows that come later by descending id.

    Quantiles cut the ids into ranges of about equal rows, each of which has as many buckets of equal width. So ids that
    lie far apart leave no more than a range to one bucket. Rows without id are dealt by their order, below all others.
    """
    ids = docs.agg(F.count("*"), F.count("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    rows, known, low, high = ids[0], ids[1], ids[2] or 0, ids[3] or 0
    ranges = max(1, min(RANGES, known // BUCKET_ROWS))
    inner = max(1, known // ranges // BUCKET_ROWS)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted({low, *(docs.agg(F.percentile_approx("doc_id", shares)).first()[0] or ())} if shares else {low})
    ends = [*cuts[1:], high + 1]
    widths = F.array(*(F.lit((end - cut) / inner) for cut, end in zip(cuts, ends, strict=True)))
    starts = F.array(*(F.lit(cut).cast("long") for cut in cuts))
    at = F.size(F.filter(starts, lambda cut: F.col("doc_id") >= cut))
    # In doubles, as the distance of two longs may be none; rounding keeps the order.
    place = (F.col("doc_id").cast("double") - F.element_at(starts, at).cast("double")) / F.element_at(widths, at)
    numbered = (at - 1).cast("long") * inner + F.least(F.floor(place), F.lit(inner - 1))
    unknown = (rows - known) // BUCKET_ROWS + 1
    dealt = F.least(F.floor((F.col("order") / F.lit(2.0**64) + 0.5) * unknown), F.lit(unknown - 1))
    return F.when(F.col("doc_id").isNull(), -1 - dealt).otherwise(numbered)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text of the next document by descending id, after the last that of the first.

    Ids are dealt to buckets of about BUCKET_ROWS; a window in each finds the neighbour, and the last row of a bucket takes the first of
    the next bucket. The texts are shuffled once, by bucket.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("order", F.xxhash64("text"))
    bucket = _bucket(docs)
    rows = docs.withColumn("bucket", bucket)
    downward = Window.partitionBy("bucket").orderBy(F.desc("doc_id"), "order")
    placed = rows.withColumn("next_text", F.lead("text").over(downward)).withColumn("place", F.row_number().over(downward))
    heads = placed.where("place = 1").select(F.col("bucket").alias("next_bucket"), F.col("text").alias("first_text"))
    below = _below(docs.select(bucket.alias("bucket")).distinct())
    tails = placed.where("next_text IS NULL").join(below, "bucket").join(heads, "next_bucket")
    inner = placed.where("next_text IS NOT NULL")
    return inner.select("doc_id", "text", "next_text").unionAll(tails.select("doc_id", "text", F.col("first_text").alias("next_text")))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last third is the next document's beginning."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    return (
        with_next(docs)
        .withColumn("edited", edited)
        .select(
            "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("other"), signatures(F.col("next_text")).alias("next"),
        )
        .select(
            "doc_id", "n_chars", "edited_sha256", written_out(F.col("own")).alias("fingerprint"),
            written_out(F.col("other")).alias("edited_fingerprint"), jaccard(F.col("own"), F.col("other")).alias("near_edited"),
            jaccard(F.col("own"), F.col("next")).alias("near_next"),
        )
    )


def length_class(size: Column, threshold: float) -> Column:
    """Sets of similarity ``threshold`` or more lie in the same or in neighbouring classes."""
    return F.floor(F.log(size.cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")


def search(queries: DataFrame, docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Documents whose fingerprint is at least so similar to a query's: query_id, doc_id, near.

    Both tables have doc_id and text. A similar set shares one of the query's smallest hashes, as many as it may lack and one more.
    """

    def prefixes(rows: DataFrame, key: str) -> DataFrame:
        sets = rows.select(F.col("doc_id").alias(key), signatures(F.coalesce("text", F.lit(""))).alias(f"{key}_set"))
        size = F.size(f"{key}_set")
        lacking = (size - F.ceil(size * threshold) + 1).cast("int")
        return sets.withColumn("c", length_class(size, threshold)).withColumn("h", F.explode(F.slice(f"{key}_set", F.lit(1), lacking)))

    asked = prefixes(queries, "query_id").withColumn("c", F.explode(F.array(F.col("c") - 1, F.col("c"), F.col("c") + 1)))
    pairs = asked.join(prefixes(docs, "doc_id"), ["h", "c"])
    small = F.least(F.size("query_id_set"), F.size("doc_id_set")) >= F.greatest(F.size("query_id_set"), F.size("doc_id_set")) * threshold
    near = pairs.where(small).withColumn("near", jaccard(F.col("query_id_set"), F.col("doc_id_set"))).where(F.col("near") >= threshold)
    return near.select("query_id", "doc_id", "near").distinct()
