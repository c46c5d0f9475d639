"""Transactions counted over event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Event time, how late a row may be, and the window sizes.
EVENT_TIME = "transaction_timestamp"
LATENESS = "5 minutes"
TUMBLING = "1 minute"
SLIDING = "5 minutes"
SLIDE = "1 minute"


def count_tumbling(
    transactions: DataFrame, size: str = TUMBLING, lateness: str = LATENESS
) -> DataFrame:
    """Count per window. A stream emits a window once the watermark passes it."""
    window = F.window(EVENT_TIME, size)
    return _count(transactions.withWatermark(EVENT_TIME, lateness), window, F.count(F.lit(1)))


def count_sliding(
    transactions: DataFrame, size: str = SLIDING, slide: str = SLIDE, lateness: str = LATENESS
) -> DataFrame:
    """Count per overlapping window; each row falls in size / slide of them.

    A table is first counted per slide, so that only these counts, not the
    rows, are copied into the overlapping windows. That takes a size that is a
    multiple of the slide. A stream cannot do so: counting in two stages would
    drop a late row from every window, although some of its windows are still
    open.
    """
    rows = transactions.withWatermark(EVENT_TIME, lateness)
    if transactions.isStreaming or not _is_multiple(transactions, size, slide):
        return _count(rows, F.window(EVENT_TIME, size, slide), F.count(F.lit(1)))
    slides = count_tumbling(transactions, slide, lateness)
    return _count(
        slides, F.window("window_start", size, slide), F.sum("transaction_count")
    )


def missed(
    transactions: DataFrame, counts: DataFrame, size: str = TUMBLING, slide: str | None = None
) -> DataFrame:
    """Closed windows that lack rows that came after they were closed.

    `counts` are those that a stream has given out for the transactions of a table. What a
    window lacks are the rows that the stream dropped as late; a window that was closed
    before any of its rows came has given out none. Windows beyond the last one given out
    may still be open and are not looked at.
    """
    window = F.window(EVENT_TIME, size, slide) if slide else F.window(EVENT_TIME, size)
    whole = _count(transactions, window, F.count(F.lit(1)))
    # The last window given out, as one row: bounded, whatever the table's size.
    last = counts.agg(F.max("window_end").alias("last_end"))
    ends = ["window_start", "window_end"]
    given = counts.select(*ends, F.col("transaction_count").alias("given_count"))
    closed = whole.join(F.broadcast(last), F.col("window_end") <= F.col("last_end")).drop("last_end")
    lacking = F.col("transaction_count") - F.coalesce("given_count", F.lit(0))
    joined = closed.join(given, ends, "left").withColumn("missed", lacking)
    return joined.filter(F.col("missed") > 0).select(*ends, "transaction_count", "missed")


def late_candidates(transactions: DataFrame, missed_windows: DataFrame, size: str = TUMBLING) -> DataFrame:
    """The rows of windows that lack some, late ones and those that came in time."""
    windows = missed_windows.select(F.struct("window_start", "window_end").alias("_window"))
    at = F.window(EVENT_TIME, size)
    own = transactions.withColumn(
        "_window", F.struct(at["start"].alias("window_start"), at["end"].alias("window_end"))
    )
    return own.join(windows, "_window", "left_semi").drop("_window")


def _is_multiple(df: DataFrame, size: str, slide: str) -> bool:
    """By Spark's own reading of the intervals."""
    parts = [f"cast(timestamp '1970-01-01' + {_interval(text)} as double)" for text in (size, slide)]
    return df.sparkSession.sql(f"select {parts[0]} % {parts[1]} = 0").first()[0]


def _interval(text: str) -> str:
    return text if text.strip().lower().startswith("interval") else f"interval {text}"


def _count(df: DataFrame, window: Column, count: Column) -> DataFrame:
    return (
        df.groupBy(window.alias("window"))
        .agg(count.alias("transaction_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "transaction_count",
        )
    )
