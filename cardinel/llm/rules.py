"""Quality rules whose thresholds adapt to language and source.

For each language and source, and each measure, a quantile sketch counts texts in
buckets of equal ratio. Such sketches merge by adding counts and give every quantile
within a fixed relative error. A text fails where it lies far outside its group's middle
half; the limits of small groups are drawn to those of their language, and these to those
of everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardinel.llm.common import SPACE, WORD, let, saved, word_list

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
# Buckets of the sketch: quantiles are within one percent.
RATIO = 1.02
LEAST = 1e-4
# The limits one level up count as much as so many texts of a group.
PRIOR_TEXTS = 10
# Widths of the middle half that a text may lie outside of it.
REACH = 6.0
# A text may lie so many times as far out as an outer quantile is from the median. The
# outermost one that stays below the measure's cap is taken: beyond it are bad texts.
OUTER = (0.98, 0.95, 0.9)
OUTER_REACH = 3.0
# Each measure: whether low values are bad too, and the cap, which is also the distance
# allowed where no outer quantile differs from the median or all are above it.
MEASURES: dict[str, tuple[bool, float]] = {
    "word_length": (True, 3.0),
    "symbols_per_word": (False, 0.25),
    "marks_per_word": (False, 0.75),
    "capital_share": (False, 0.3),
    "dup_line_share": (False, 0.3),
    "repeat_share": (False, 0.2),
    "echo_share": (False, 0.2),
}


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of 8 words which the text has twice or more."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeats(own: Column) -> Column:
            def near(i: Column, step: int) -> Column:
                return F.coalesce(F.get(own, i + step)["h"] == F.get(own, i)["h"], F.lit(False))

            both = F.filter(own, lambda _, i: near(i, 1) | near(i, -1))
            starts = F.sort_array(F.transform(both, lambda x: x["i"]))

            def total(at: Column) -> Column:
                gap = F.transform(
                    at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
                )
                return F.aggregate(gap, F.lit(0), lambda a, b: a + b)

            return let(starts, total)

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            let(placed, repeats)
        )

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(windows, covered))


def _echoes(words: Column) -> Column:
    """Words equal to the word before."""
    return F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False))))


def measured(docs: DataFrame) -> DataFrame:
    """Adds counts of words, symbols, repeated lines and windows, and the measures."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    line_counts = let(lines, lambda x: F.struct(
        F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")
    ))
    counts = let(word_list(F.col("text")), lambda w: F.struct(
        F.size(w).alias("n"), _repeated_words(w).alias("repeat"), _echoes(w).alias("echo")
    ))
    rows = (
        docs.withColumn("_lines", line_counts)
        .withColumn("_words", counts)
        .withColumn("_capitals", F.regexp_count(text, F.lit(r"\p{Lu}")))
        .withColumn("_marks", F.regexp_count(text, F.lit(r"[!-/:-@\[-`{-~]")))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(text, SPACE, "")).cast("long"))
        .withColumn("n_words", F.col("_words.n").cast("long"))
        .withColumn("n_repeat_words", F.col("_words.repeat").cast("long"))
        .withColumn("n_dup_lines", F.col("_lines.dup").cast("long"))
    )
    words = F.greatest(F.col("n_words"), F.lit(1))
    values = {
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "marks_per_word": F.col("_marks") / words,
        "capital_share": F.col("_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("_lines.n"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "echo_share": F.col("_words.echo") / words,
    }
    measures = F.struct(*[value.alias(name) for name, value in values.items()])
    return rows.withColumn("measures", measures).drop("_lines", "_words", "_capitals", "_marks")


def _base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def sketches(rows: DataFrame) -> DataFrame:
    """Counts of texts by lang, source, measure and bucket, of texts that pass the base rules."""
    each = [F.struct(F.lit(m).alias("measure"), F.col(f"measures.{m}").alias("value")) for m in MEASURES]
    bucket = F.floor(F.log(F.greatest("value", F.lit(LEAST))) / F.log(F.lit(RATIO)))
    return (
        rows.filter(~_base_failed())
        .select("lang", "source", F.inline(F.array(*each)))
        .groupBy("lang", "source", "measure", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def limits(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Lowest and highest values allowed, from sketches merged over all but `by`."""
    keys = [*by, "measure"]
    merged = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("bucket")
    whole = Window.partitionBy(*keys)
    value = F.when(
        F.col("bucket") > F.lit(0) + F.floor(F.log(F.lit(LEAST)) / F.log(F.lit(RATIO))),
        F.pow(F.lit(RATIO), F.col("bucket") + 0.5),
    ).otherwise(0.0)
    placed = merged.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(whole))

    def quantile(p: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.col("_all") * p, value))

    low, high = F.col("_q1"), F.col("_q3")
    cap = F.create_map(*[F.lit(x) for m, (_, d) in MEASURES.items() for x in (m, d)])[F.col("measure")]
    two_sided = F.col("measure").isin(*[m for m, (both, _) in MEASURES.items() if both])

    def reach(side: str) -> Column:
        apart = [OUTER_REACH * F.abs(F.col(f"_{side}{i}") - F.col("_q2")) for i in range(len(OUTER))]
        outer = F.coalesce(*[F.when((x > 0) & (x < cap), x) for x in apart], cap)
        return F.greatest(REACH * (high - low), outer)

    outer = [quantile(q).alias(f"_{side}{i}") for i, p in enumerate(OUTER) for side, q in (("up", p), ("down", 1 - p))]
    middle = [quantile(k / 4).alias(f"_q{k}") for k in (1, 2, 3)]
    bounds = (
        placed.groupBy(*keys)
        .agg(*middle, *outer, F.max("_all").alias("_n"))
        .select(
            *keys,
            "_n",
            F.struct(
                F.when(two_sided, low - reach("down")).otherwise(F.lit(-1.0)).alias("low"),
                (high + reach("up")).alias("high"),
            ).alias("_bounds"),
        )
    )
    columns = [F.first(F.when(F.col("measure") == m, F.col("_bounds")), True).alias(m) for m in MEASURES]
    return bounds.groupBy(*by).agg(F.max("_n").alias("_n"), *columns).select(
        F.struct(*[F.col(c) for c in by]).alias("_key") if by else F.lit(True).alias("_key"),
        F.struct("_n", *MEASURES).alias("_limits"),
    )


def _drawn(own: Column, above: Column, measure: str, side: str) -> Column:
    """A group's limit, drawn to the one a level up by the number of its texts."""
    weight = own["_n"] / (own["_n"] + PRIOR_TEXTS)
    return F.coalesce(weight * own[measure][side] + (1 - weight) * above, above)


def judge(docs: DataFrame) -> DataFrame:
    """Adds counts, `base_failed`, `failed` (names of measures out of range) and `kept`.

    Null texts count as empty; a text with fewer than 20 words, or with more than 30 % of
    its words in repeated windows, fails at the base. Null languages and sources are
    groups of their own. Limits are set by the texts that pass the base. The text is dropped.
    """
    rows = saved(measured(docs).drop("text"), "rule-measures")
    sketch = saved(sketches(rows), "rule-sketches")
    found = rows
    names = []
    for i, by in enumerate((["lang", "source"], ["lang"], [])):
        key = F.struct(*[F.col(c) for c in by]) if by else F.lit(True)
        own = limits(sketch, by).withColumnsRenamed({"_key": f"_key{i}", "_limits": f"_limits{i}"})
        found = found.withColumn(f"_own{i}", key)
        found = found.join(own, F.col(f"_own{i}") == F.col(f"_key{i}"), "left")
        names.append(f"_limits{i}")
    group, language, whole = [F.col(name) for name in names]

    def limit(measure: str, side: str) -> Column:
        above = _drawn(language, whole[measure][side], measure, side)
        return _drawn(group, above, measure, side)

    failed = [
        F.when(
            (F.col(f"measures.{m}") > limit(m, "high")) | (F.col(f"measures.{m}") < limit(m, "low")),
            F.lit(m),
        )
        for m in MEASURES
    ]
    return (
        found.withColumn("base_failed", _base_failed())
        .withColumn("failed", F.array_compact(F.array(*failed)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
        .drop(*names, "_key0", "_key1", "_key2", "_own0", "_own1", "_own2")
    )
