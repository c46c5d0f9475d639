"""Near duplicates by bottom-k sketches of word shingles.

One hash function numbers the shingles; a sketch retains a set's 64 smallest hashes
(all, if there are fewer). Inverted lists of retained values bring sets together.
Of each sketch only the rarest values are listed, as many as two sketches of similar
sets cannot miss each other with; so common passages make no lists of their own.

A list is not turned into all its pairs. Candidates with more shingles of their own than
similar sets can differ by go first. Members are compared with one of them, the pivot,
which joins copies of one text into one component. Members still apart are compared with
a second one, and then with those of other components, where their distances from the
pivot and their own shingles allow them to be similar; this is exact, as distances by
differing shingles are a metric. Such candidates go through an estimate from the union
of two sketches, and every link is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardinel.llm.common import all_columns, row_key, saved
from cardinel.llm.components import components
from cardinel.llm.text_arrays import mix, pieces, word_hashes

RETAINED = 64
# How often at most two sketches of sets just similar enough have too few in common.
MISSED = 1e-6

_MIXERS = np.random.default_rng(7).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def in_common(percent: int) -> float:
    """Share of retained values that sketches of similar sets have in common, but for MISSED."""
    p, least, below = percent / 100, 0, 0.0
    while least < RETAINED:
        below += comb(RETAINED, least) * p**least * (1 - p) ** (RETAINED - least)
        if below > MISSED:
            break
        least += 1
    return least / RETAINED


def shingle_hashes(
    data: np.ndarray, at: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted by text and hash, and their text numbers.

    A text of fewer words than a shingle has one of all its words.
    """
    words, text = word_hashes(data, at)
    if not len(words):
        return words, text
    n = len(at) - 1
    count = np.bincount(text, minlength=n)
    first = np.cumsum(count) - count
    left = (first + count)[text] - np.arange(len(words))  # words from here to the text's end
    whole = (count[text] < size) & (np.arange(len(words)) == first[text])
    begins = np.flatnonzero((left >= size) | whole)
    length = np.minimum(left[begins], size)
    total = np.zeros(len(begins), np.uint64)
    for k in range(size):
        inside = length > k
        total[inside] += words[begins[inside] + k] * _MIXERS[k % 8] * np.uint64(2 * (k // 8) + 1)
    hashes = mix(total + length.astype(np.uint64))
    owner = text[begins]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])]
    return hashes[new], owner[new]


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Adds `n_shingles`, `node` (digest of the set; null if empty) and `sketch`; drops the text."""
    added = T._parse_datatype_string("n_shingles long, node binary, sketch array<bigint>")
    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType([*docs.select(*rest).schema, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, at in pieces(batch.column(len(rest))):
                n = end - row
                hashes, owner = shingle_hashes(data, at, size)
                count = np.bincount(owner, minlength=n)
                first = np.cumsum(count) - count
                digests = np.zeros((n, 2), np.uint64)
                for k, salt in enumerate((0x1234567, 0x89ABCDEF)):
                    sums = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(mix(hashes ^ np.uint64(salt)), out=sums[1:])
                    digests[:, k] = sums[first + count] - sums[first]
                nodes = [d.tobytes() if c else None for d, c in zip(digests, count, strict=True)]
                kept = np.arange(len(hashes)) - first[owner] < RETAINED
                cuts = np.r_[0, np.cumsum(np.minimum(count, RETAINED))].astype(np.int32)
                values = pa.array(hashes[kept].view(np.int64))
                yield pa.record_batch(
                    [
                        *[c[row:end] for c in batch.columns[: len(rest)]],
                        pa.array(count.astype(np.int64)),
                        pa.array(nodes, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(cuts), values),
                    ],
                    names=schema.names,
                )

    return docs.select(*rest, F.col("text").cast("string")).mapInArrow(run, schema)


def rare_lists(classes: DataFrame, percent: int) -> DataFrame:
    """Rows of value, node and set size: the rarest values of each sketch, if shared.

    Two sketches with at least the share `in_common` of their values in common have one of
    these among them: the values in the order of rarity, without the last ones that
    are one fewer than they must have in common.
    """
    values = classes.select(
        "node", "n_shingles", F.size("sketch").alias("_kept"), F.explode("sketch").alias("value")
    )
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    counts = saved(counts, "shared-values")
    listed = F.col("_kept") - F.ceil(F.col("_kept") * in_common(percent)) + 1
    # At most 64 rows of a node are sorted, as an array.
    shared = (
        values.join(counts, "value")
        .groupBy("node", "n_shingles", "_kept")
        .agg(F.sort_array(F.collect_list(F.struct("_n", "value"))).alias("_shared"))
    )
    take = (listed - F.col("_kept") + F.size("_shared")).cast("int")
    rows = shared.filter(take > 0).select(
        "node", "n_shingles", F.explode(F.slice("_shared", F.lit(1), take)).alias("_x")
    )
    return rows.select(F.col("_x.value").alias("value"), "node", "n_shingles")


def own_shingles(texts: DataFrame, size: int) -> DataFrame:
    """`nid` and `own`: how many shingles of a candidate no other candidate has.

    Only values that one candidate has are counted back to it, so that no list of the
    candidates of a value is ever made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, at in pieces(batch.column(1)):
                hashes, owner = shingle_hashes(data, at, size)
                nid = batch.column(0)[row:end].take(pa.array(owner))
                yield pa.record_batch([nid, pa.array(hashes.view(np.int64))], names=["nid", "value"])

    rows = texts.select(_nid(), "text").mapInArrow(run, "nid long, value long")
    once = rows.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("nid").alias("nid"))
    return once.filter("n = 1").groupBy("nid").agg(F.count(F.lit(1)).alias("own"))


def _nid() -> Column:
    return F.xxhash64("node").alias("nid")


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether two sets of these sizes, with that many own shingles, can be similar.

    What either has alone is not in common, and adds to the other in the union.
    """
    n, m = F.col(f"{x}n_shingles"), F.col(f"{y}n_shingles")
    own, other = F.col(f"{x}own"), F.col(f"{y}own")
    common = F.least(n - own, m - other)
    return 100 * common >= percent * F.greatest(n + other, m + own)


def with_pivots(lists: DataFrame) -> DataFrame:
    """Adds `pivot`, a member of each list, chosen alike in all lists.

    That is one with few shingles of its own, as it is similar to most.
    """
    place = F.struct(F.col("own") / F.col("n_shingles"), F.xxhash64("node"), "node", "n_shingles")
    pivots = lists.groupBy("value").agg(F.min(place).alias("_p"))
    pivots = pivots.select("value", F.col("_p.node").alias("pivot"), F.col("_p.n_shingles").alias("pivot_size"))
    return lists.join(pivots, "value")


def with_distances(lists: DataFrame, compared: DataFrame) -> DataFrame:
    """Adds `delta`, how many shingles only one of a member and its list's pivot has."""
    known = compared.select(
        F.col("a").alias("node"), F.col("b").alias("pivot"), F.col("common")
    ).union(compared.select(F.col("b"), F.col("a"), F.col("common")))
    delta = F.col("n_shingles") + F.col("pivot_size") - 2 * F.col("common")
    itself = F.when(F.col("node") == F.col("pivot"), F.lit(0).cast("long"))
    joined = lists.join(known, ["node", "pivot"], "left")
    return joined.withColumn("delta", F.coalesce(itself, delta)).drop("common")


def _second_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Members with another one that is not in the component of the list's pivot."""
    first = lists.filter("node = pivot").select("value", F.col("component").alias("_first"))
    left = lists.join(first, "value").filter("component <> _first").drop("_first")
    place = F.struct(F.col("own") / F.col("n_shingles"), F.xxhash64("node"), *PAIRED)
    chosen = left.groupBy("value").agg(F.min(place).alias("_p"))
    chosen = chosen.select("value", *[F.col(f"_p.{c}").alias(f"_p_{c}") for c in PAIRED])
    apart = F.col("component") != F.col("_p_component")
    joined = lists.join(chosen, "value").filter(apart & _possible("", "_p_", percent))
    return _pairs(joined, F.col("node"), F.col("_p_node"))


PAIRED = ["node", "n_shingles", "own", "component", "delta"]


def _apart_by_pivot(x: str, y: str, percent: int) -> Column:
    """Whether the distances of two sets from the pivot show that they are not similar.

    Of what they differ in from the pivot they can have in common at most what is not
    their own; the rest of it they differ in from each other. Sets of n and m shingles are
    similar if they differ in at most (100 - percent) / (100 + percent) of n + m.
    """
    d, e = F.col(f"{x}delta"), F.col(f"{y}delta")
    common = F.least(d - F.col(f"{x}own"), e - F.col(f"{y}own"))
    differ = d + e - 2 * F.greatest(common, F.lit(0))
    n = F.col(f"{x}n_shingles") + F.col(f"{y}n_shingles")
    return F.coalesce((100 + percent) * differ > (100 - percent) * n, F.lit(False))


def _cross_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Members of one list that are in different components, as pairs.

    Of the lists that two sets share, only the one of the smallest value pairs them.
    """
    on = (F.col("x.value") == F.col("y.value")) & (F.col("x.component") < F.col("y.component"))
    on &= _possible("x.", "y.", percent) & ~_apart_by_pivot("x.", "y.", percent)
    shared = F.array_intersect("x.listed", "y.listed")
    on &= F.col("x.value") == F.array_min(shared)
    joined = lists.alias("x").join(lists.alias("y"), on)
    return _pairs(joined, F.col("x.node"), F.col("y.node"))


def _pairs(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches have enough of their union's smallest values in common."""
    own = classes.select("node", "sketch")
    both = pairs.join(own.withColumnsRenamed({"node": "a", "sketch": "_s"}), "a").join(
        own.withColumnsRenamed({"node": "b", "sketch": "_t"}), "b"
    )
    # Hashes are in unsigned order: flipping the sign bit makes it Spark's order.
    flip = lambda s: F.transform(s, lambda x: x.bitwiseXOR(F.lit(-(2**63))))
    s, t = flip(F.col("_s")), flip(F.col("_t"))
    union = F.slice(F.array_sort(F.array_union(s, t)), 1, RETAINED)
    common = F.size(F.array_intersect(F.array_intersect(s, t), union))
    return both.filter(common >= in_common(percent) * F.size(union)).select("a", "b")


def compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs with the shingles their full sets have in `common`, and whether they are `similar`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = np.zeros(batch.num_rows, np.int64)
            similar = np.zeros(batch.num_rows, bool)
            sides = zip(_sets(batch.column(2), size), _sets(batch.column(3), size), strict=True)
            for i, (x, y) in enumerate(sides):
                common[i] = len(np.intersect1d(x, y, assume_unique=True))
                similar[i] = 100 * common[i] >= percent * (len(x) + len(y) - common[i])
            columns = [*batch.columns[:2], pa.array(common), pa.array(similar)]
            yield pa.record_batch(columns, names=["a", "b", "common", "similar"])

    own = texts.select("node", "text")
    both = pairs.join(own.withColumnsRenamed({"node": "a", "text": "_s"}), "a").join(
        own.withColumnsRenamed({"node": "b", "text": "_t"}), "b"
    )
    schema = "a binary, b binary, common long, similar boolean"
    return both.select("a", "b", "_s", "_t").mapInArrow(run, schema)


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for row, end, data, at in pieces(column):
        hashes, owner = shingle_hashes(data, at, size)
        cuts = np.searchsorted(owner, np.arange(end - row + 1))
        yield from (hashes[i:j] for i, j in zip(cuts, cuts[1:], strict=False))


def group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """`n_shingles`, `component_id` and `kept` for rows of `doc_id` and `text`.

    Documents are linked if their sets of `size`-word shingles (ASCII capitals as small
    letters) have at least `percent` % of their union in common. `component_id` is the
    smallest doc_id that links lead to. `kept` is true for one row of each group: the one
    with that id and, of several, the smallest text hash. Null texts and texts without
    words are linked with nothing. Repeated rows are copies of each other, and kept alike.
    A null id is never smallest; a group without ids has none.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash"), "text")
    known = saved(sketches(rows, size), "sketches")
    classes = known.filter("node is not null").groupBy("node", "n_shingles").agg(
        F.min(_place()).alias("_row"),
        F.first("sketch").alias("sketch"),
    )
    classes = saved(classes, "classes")
    lists = saved(rare_lists(classes, percent), "rare-lists")
    # Texts of the sets that share a listed value with another.
    open_ = lists.groupBy("value").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    open_ = lists.join(open_, "value", "left_semi").select("node").distinct()
    wanted = classes.join(open_, "node", "left_semi").select("node", "_row")
    texts = rows.withColumn("_row", _place()).join(wanted, "_row")
    texts = saved(texts.select("node", "text").dropDuplicates(["node"]), "candidate-texts")
    own = saved(own_shingles(texts, size), "own-shingles")
    lists = lists.withColumn("nid", _nid()).join(own, "nid", "left").drop("nid")
    lists = lists.withColumn("own", F.coalesce("own", F.lit(0)))
    # A set with more of its own than similar sets can differ by is similar to none.
    lists = lists.filter(100 * (F.col("n_shingles") - F.col("own")) >= percent * F.col("n_shingles"))
    lists = saved(lists.withColumn("component", F.col("node")), "rare-lists")
    # Each list's members with its pivot: links, and distances that rule out others.
    lists = saved(with_pivots(lists), "pivot-lists")
    pairs = _pairs(lists.filter("node <> pivot"), F.col("node"), F.col("pivot"))
    found = saved(compared(pairs, texts, size, percent), "pivot-pairs")
    # The first of these maps nodes to components, the others components to larger ones.
    merges = [components(found.filter("similar"))]
    lists = with_distances(_mixed(placed(lists, "component", merges)), found)
    lists = saved(lists, "rare-lists")
    for step in (_second_pairs, _cross_pairs):
        if lists.isEmpty():
            break
        pairs = estimated(step(lists, percent), classes, percent)
        found = saved(compared(pairs, texts, size, percent).filter("similar"), "new-links")
        new = []
        if not found.isEmpty():
            ends = placed(placed(found.select("a", "b"), "a", merges), "b", merges)
            new = [components(saved(ends, "links"))]
        merges += new
        if step is _second_pairs:
            lists = saved(_with_listed(lists, placed(lists, "component", new)), "mixed-lists")
    least = classes.select("node", "_row", F.col("node").alias("component"))
    least = placed(least, "component", merges)
    # Components are told apart by their own node, as several can have one id, or none.
    best = least.groupBy("component").agg(F.min("_row").alias("_best"))
    nodes = least.join(best, "component").select("node", "_best")
    result = known.select("doc_id", "_hash", "n_shingles", "node").join(nodes, "node", "left")
    alone = F.col("node").isNull()
    return result.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_best.doc_id")).alias("component_id"),
        (alone | _place().eqNullSafe(F.col("_best"))).alias("kept"),
        "_hash",
    )


def _place() -> Column:
    """Rows in order of id, those without one last, then text hash."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash")


def placed(df: DataFrame, column: str, merges: list[DataFrame]) -> DataFrame:
    """Nodes or components of a column replaced by the components they are in after these merges.

    Merges of later steps are mostly few, and then Catalyst broadcasts them.
    """
    for merge in merges:
        to = merge.select(F.col("node").alias("_from"), F.col("component").alias("_to"))
        df = df.join(to, F.col(column) == F.col("_from"), "left")
        df = df.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")
    return df


def _mixed(lists: DataFrame) -> DataFrame:
    """Lists whose members are not all in one component yet."""
    mixed = lists.groupBy("value").agg(F.min("component").alias("_x"), F.max("component").alias("_y"))
    return lists.join(mixed.filter("_x <> _y").select("value"), "value", "left_semi")


def _with_listed(before: DataFrame, lists: DataFrame) -> DataFrame:
    """Lists that are still mixed, and the values each member is `listed` by.

    The values of lists that were mixed before will do: all lists of two sets that are apart
    are mixed still.
    """
    listed = before.groupBy("node").agg(F.collect_set("value").alias("listed"))
    return _mixed(lists).join(listed, "node")


def dedupe(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group: the one with the smallest id.

    All columns are kept, whatever their names.     Of a group's rows with that id the one with the smallest text hash stays, and of equal
    rows one. Each text without words is a group of its own, so it stays; only if it has
    an id can it be a repeated row.
    """
    found = group(docs.select("doc_id", "text"), size, percent).filter("kept")
    best = found.groupBy("doc_id", "_hash").agg(F.max("n_shingles").alias("_size"), F.count(F.lit(1)).alias("_n"))
    apart = F.col("doc_id").isNull() & (F.col("_size") == 0)
    best = best.select(row_key(F.col("doc_id"), F.col("_hash")).alias("_key"), "_n", apart.alias("_apart"))
    best = saved(best, "kept-documents")
    key = row_key(F.col("doc_id"), F.xxhash64("text")).alias("_key")
    rows = docs.select(all_columns(docs), key).join(best, "_key")
    if best.filter("_n > 1 and not _apart").isEmpty():
        return rows.select("_all.*")
    once = rows.filter("not _apart").dropDuplicates(["_key"])
    return once.union(rows.filter("_apart")).select("_all.*")
