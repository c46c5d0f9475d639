"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a target in words. A source takes as many complete epochs as fit
into its target, and a weighted sample without replacement for the rest: documents
in the order of exponential keys -ln(u) / weight, until their words reach what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardinel.llm.common import WORD, all_columns, prefix_sums, row_key, saved

MOST_EPOCHS = 3
# Documents that one task sorts, on average.
BUCKET_ROWS = 5000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_weight(text: Column) -> Column:
    """Quality weight from 1 down to 1/2, the lower the more marks and digits a text has."""
    marks = F.regexp_count(text, F.lit(r"[!-@\[-`{-~]"))
    ratio = marks / F.greatest(word_count(text), F.lit(1))
    return F.coalesce(1 / (1 + F.least(ratio, F.lit(1.0))), F.lit(0.5))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number between 0 and 1 from an id, the same on every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(2.0**48)


def targets(sources: DataFrame) -> DataFrame:
    """`target` for rows of `source` and `source_size`, which sum up to all words.

    Sources by code point, null last, weigh 1, 2, 3, repeating. None gets more than
    three times its size; what is over goes to the others by weight. With sources in
    the order of the level at which they are full, the level of the rest follows from
    running sums, without iteration.
    """
    row = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    full = sources.withColumn("_weight", (row - 1) % 3 + 1).withColumn(
        "_most", MOST_EPOCHS * F.col("source_size")
    )
    order = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(earlier), F.lit(0))
    ) / F.sum("_weight").over(later)
    open_ = F.col("_most") / F.col("_weight") >= F.col("_level")
    return (
        full.withColumn("_level", level)
        .withColumn("_level", F.max(F.when(open_, F.col("_level"))).over(everything))
        .withColumn("target", F.least(F.col("_most").cast("double"), F.col("_level") * F.col("_weight")))
        .drop("_weight", "_most", "_level")
    )


def mix(docs: DataFrame, seed: int = 17) -> DataFrame:
    """Adds `source_size`, `target` and `taken` to rows of doc_id, source, size, weight.

    `size` is a document's words and `weight` its quality weight (above 0); `taken` is
    the words the mix takes of it, repeats counted. Rows with equal ids and sizes are
    interchangeable. Documents without words take nothing.
    """
    key = -F.log(uniform(F.col("doc_id"), seed)) / F.col("weight")
    sources = docs.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
    )
    by_source = targets(sources).select(
        F.struct(F.col("source")).alias("_source"), "source_size", "target", "_rows"
    )
    parts = F.floor(F.col("_rows") / BUCKET_ROWS) + 1
    joined = (
        docs.withColumn("_source", F.struct(F.col("source")))
        .join(by_source, "_source")
        .withColumn("_order", key)
        .withColumn("_bucket", F.floor((1 - F.exp(-F.col("_order"))) * parts))
    )
    order = [F.col("_order"), F.col("doc_id"), F.col("size")]
    summed = prefix_sums(joined, ["source"], "_bucket", order, "size", "_before")
    epochs = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    rest = F.col("target") - epochs * F.col("source_size")
    # The document on the boundary is taken if that comes nearer to the target.
    picked = (F.col("_before") + F.col("size") / 2 <= rest).cast("long")
    return summed.withColumn("taken", (F.col("size") * (epochs + picked)).cast("long")).drop(
        "_source", "_rows", "_order", "_bucket", "_before"
    )


def mixed(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself: each document as often as the mix takes it.

    All columns are kept, whatever their names.     Rows with one id, source and text are taken alike. Documents without words are left
    out, as they count for nothing.
    """
    key = row_key(F.col("doc_id"), F.col("source"), F.xxhash64("text"))
    text = F.col("text")
    rows = docs.select(
        "doc_id", "source", key.alias("_row"), word_count(text).alias("size"),
        text_weight(text).alias("weight"),
    )
    one = rows.groupBy("doc_id", "source", "_row").agg(
        F.sum("size").alias("size"), F.min("weight").alias("weight")
    )
    taken = mix(saved(one, "mixing-sizes"), seed).filter("taken > 0")
    copies = taken.select("_row", F.expr("taken div size").cast("int").alias("_copies"))
    own = docs.select(all_columns(docs), key.alias("_row"))
    joined = own.join(saved(copies, "mixing-copies"), "_row")
    repeated = joined.select("_all", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select("_all.*")
