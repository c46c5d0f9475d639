"""Benchmark decontamination by winnowing.

Of every 6 consecutive 5-word hashes the smallest is a fingerprint. Two texts that
share 10 words in a row share 6 hashes in a row, and so the smallest of them: no
shared window is missed. Fingerprints of documents and benchmark items are joined, and
where they meet, the 10-word windows they stand for are compared as text.

Items of fewer than 10 words are one window; their few lengths are looked up among
all word runs of these lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardinel.llm.common import all_columns, let, lower_ascii, row_key, saved

WORDS_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
GRAMS = WINDOW - GRAM + 1
ADDED = ("n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "hits")


def words_of(text: Column) -> Column:
    lowered = lower_ascii(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(lowered, WORDS_APART), "")


def _runs(words: Column, length: int) -> Column:
    """Hashes of all runs of `length` words; none if there are fewer words."""
    starts = F.sequence(F.lit(1), F.size(words) - (length - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, length)))
    return F.when(F.size(words) >= length, hashes).otherwise(F.array().cast("array<bigint>"))


def _minima(grams: Column) -> Column:
    """The smallest of each 6 consecutive hashes, one for each 10-word window."""
    starts = F.sequence(F.lit(1), F.size(grams) - (GRAMS - 1))
    least = F.transform(starts, lambda i: F.array_min(F.slice(grams, i, GRAMS)))
    return F.when(F.size(grams) >= GRAMS, least).otherwise(F.array().cast("array<bigint>"))


def fingerprints(words: Column, short: list[int]) -> Column:
    """Distinct (length, hash) of the winnowed hashes, and of all runs of short lengths."""

    def tagged(hashes: Column, length: int) -> Column:
        return F.transform(F.array_distinct(hashes), lambda h: F.struct(F.lit(length).alias("len"), h.alias("h")))

    found = tagged(let(_runs(words, GRAM), _minima), WINDOW)
    return F.concat(found, *[tagged(_runs(words, n), n) for n in short])


def placed(words: Column, short: list[int]) -> Column:
    """(length, hash, place) of the fingerprint of each window, and of all short runs."""

    def cut(length: int, least: Column) -> Column:
        return F.transform(least, lambda h, i: F.struct(F.lit(length).alias("len"), h.alias("h"), i.alias("at")))

    parts = [cut(WINDOW, let(_runs(words, GRAM), _minima))]
    return F.concat(*parts, *[cut(n, _runs(words, n)) for n in short])


def windows(words: Column, spans: Column) -> Column:
    """The words of spans given as `at` and `len`, as `len`, `at` and `window`."""
    return F.transform(spans, lambda x: F.struct(
        x["len"].alias("len"), x["at"].alias("at"),
        F.array_join(F.slice(words, x["at"] + 1, x["len"]), " ").alias("window"),
    ))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Adds `n_words`, `n_hit`, `n_items`, `items`, `items_sha256`, `contaminated`.

    Documents come as doc_id and text, items as item_id and text. Null texts have no
    words. Items without an id mark words but are not named. Repeated documents and
    items get the same result each. `hits` are the longest runs of hit words, as the first
    word and the number of words. Columns of the names that are added are replaced, all
    others are kept, whatever their names.
    """
    items = benchmark.select("item_id", words_of(F.col("text")).alias("_w")).filter(F.size("_w") > 0)
    items = saved(items, "benchmark-words")
    lengths = items.filter(F.size("_w") < WINDOW).select(F.size("_w").alias("n")).distinct()
    short = sorted(r["n"] for r in lengths.collect())  # nine at most
    own = F.when(F.size("_w") >= WINDOW, fingerprints(F.col("_w"), []))
    for n in short:
        whole = F.array(F.struct(F.lit(n).alias("len"), F.xxhash64("_w").alias("h")))
        own = own.when(F.size("_w") == n, whole)
    prints = saved(items.select(F.explode(own).alias("_p")).distinct(), "benchmark-prints")
    starts = F.sequence(F.lit(0), F.size("_w") - WINDOW)
    every = F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(WINDOW).alias("len")))
    cut = F.when(F.size("_w") >= WINDOW, windows(F.col("_w"), every))
    cut = cut.otherwise(F.array(F.struct(
        F.size("_w").alias("len"), F.lit(0).alias("at"), F.array_join("_w", " ").alias("window")
    )))
    of_items = items.select("item_id", F.explode(cut).alias("x"))
    of_items = of_items.select("item_id", F.col("x.len"), F.col("x.window")).distinct()
    of_items = saved(of_items.groupBy("len", "window").agg(F.collect_set("item_id").alias("_items")), "benchmark-windows")

    key = row_key(F.col("doc_id"), F.xxhash64("text"))
    rows = docs.select(all_columns(docs, *ADDED), key.alias("_key"), "text")
    words = words_of(F.col("text"))
    seen = rows.select("_key", F.explode(let(words, lambda w: fingerprints(w, short))).alias("_p"))
    meets = saved(seen.join(prints, "_p").select("_key").distinct(), "document-meets")
    near = rows.drop("_all").join(meets, "_key").dropDuplicates(["_key"])
    near = saved(near.select("_key", words.alias("_w")), "document-words")
    # Places of fingerprints that meet, joined rather than looked up in an array.
    at = near.select("_key", F.explode(placed(F.col("_w"), short)).alias("x"))
    at = at.withColumn("_p", F.struct("x.len", "x.h")).join(prints, "_p")
    at = at.groupBy("_key").agg(F.collect_list(F.struct("x.at", "x.len")).alias("_spans"))
    cut = near.join(at, "_key").select("_key", F.explode(windows(F.col("_w"), F.col("_spans"))).alias("x"))
    found = saved(cut.select("_key", "x.*").join(of_items, ["len", "window"]), "document-windows")
    named = found.groupBy("_key").agg(F.array_distinct(F.flatten(F.collect_set("_items"))).alias("items"))
    spans = _runs_of(found).groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("hits"))
    spans = saved(named.join(spans, "_key"), "document-hits")
    ids = F.sort_array(F.transform("items", lambda x: x.cast("string")))
    result = rows.select("_all", "_key", F.size(words).cast("long").alias("n_words"))
    result = result.join(spans, "_key", "left")
    hit = F.coalesce(F.aggregate("hits", F.lit(0), lambda a, x: a + x["n"]), F.lit(0)).cast("long")
    return result.select(
        "_all.*",
        "n_words",
        "items",
        "hits",
        hit.alias("n_hit"),
        F.greatest(F.coalesce(F.size("items"), F.lit(0)), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(ids, ","), F.lit("")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def _runs_of(found: DataFrame) -> DataFrame:
    """Longest runs of words that windows (`at`, `len`) cover, as `at` and `n`.

    A run begins where no earlier window reaches; the windows sorted together are those of
    one document.
    """
    spans = found.groupBy("_key", "at").agg(F.max(F.col("at") + F.col("len")).alias("end"))
    order = Window.partitionBy("_key").orderBy("at")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (F.col("at") > before)).cast("int")
    spans = spans.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(order))
    runs = spans.groupBy("_key", "_run").agg(F.min("at").alias("at"), F.max("end").alias("end"))
    return runs.select("_key", "at", (F.col("end") - F.col("at")).alias("n"))


def clean(docs: DataFrame, benchmark: DataFrame, most: float = 0.0) -> DataFrame:
    """Documents with at most the share `most` of their words hit.

    All columns are kept, whatever their names.
    """
    key = row_key(F.col("doc_id"), F.xxhash64("text")).alias("_key")
    found = find(docs.select("doc_id", "text"), benchmark)
    dirty = found.filter(F.col("n_hit") > most * F.col("n_words")).select(key).distinct()
    return docs.select(all_columns(docs), key).join(dirty, "_key", "left_anti").select("_all.*")
