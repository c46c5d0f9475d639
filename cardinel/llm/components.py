"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardinel.llm.common import saved


def _least(pairs: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours; neighbours are in `b`."""
    return pairs.groupBy("a").agg(F.min("b").alias("_m")).select(
        "a", F.least("a", "_m").alias("_m")
    )


def _both(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two rows of `a` and `b` from one."""
    return F.inline(F.array(F.struct(a.alias("a"), b.alias("b")), F.struct(c.alias("a"), d.alias("b"))))


def _only_stars(pairs: DataFrame) -> bool:
    """Whether no node that is linked to a smaller one has another link."""
    ends = pairs.select(_both(F.col("a"), F.lit(1), F.col("b"), F.lit(0)))
    ends = ends.groupBy("a").agg(F.max("b").alias("_up"), F.count(F.lit(1)).alias("_n"))
    return ends.filter("_up = 1 and _n > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, its smallest node, for all nodes of links `a`, `b` but the smallest.

    Larger neighbours of a node are linked to the smallest node next to it, then the
    smaller ones, in turn, until only stars are left; this takes a number of rounds
    about logarithmic in the longest chain. The smallest neighbours are found by
    partial aggregation, so that a node may have any number of links. The links are read
    several times, so they should be a table.
    """
    a, b = F.col("a"), F.col("b")
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b")
    while True:
        both = pairs.select(_both(a, b, b, a))
        # No more rows than there are links, so repeated ones can wait for the other half.
        large = both.join(_least(both), "a").filter("b > a").select(b.alias("a"), F.col("_m").alias("b"))
        large = saved(large, "large-stars")
        small = large.join(_least(large), "a").select(_both(b, F.col("_m"), a, F.col("_m")))
        pairs = saved(small.filter("a <> b").distinct(), "small-stars")
        if _only_stars(pairs):
            return pairs.select(a.alias("node"), b.alias("component"))
