"""Sharding by a k-d tree over document metadata.

A node is split at the weighted median of its widest dimension, with document sizes
as weights, until its leaves reach the target bytes. A node that becomes k shards
splits at k//2 parts of k, so that any number of shards comes out even.

Medians come from two histograms, one of cells along the dimension and one of hashes
within the cell where the median lies. Both have a fixed number of bins for each node
and are added up before they are shuffled, so no task sees the rows of a node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardinel.llm.common import all_columns, prefix_sums, saved

CELLS = 4096
BINS = 4096
DIMENSIONS = ("lang", "source", "log_size", "doc_id")


def text_number(value: Column) -> Column:
    """The first six bytes as a number, which keeps the order of texts."""
    first = F.rpad(F.hex(F.substring(F.encode(value, "UTF-8"), 1, 6)), 12, "0")
    return F.coalesce(F.conv(first, 16, 10).cast("double"), F.lit(0.0))


def measured(docs: DataFrame, overhead: int = 16) -> DataFrame:
    """Adds size, checksum, coordinates and a spreading hash to documents.

    Ids that are no numbers are placed by their first bytes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + overhead).cast("long")
    number = F.nanvl(F.col("doc_id").try_cast("double"), F.lit(0.0))
    number = F.coalesce(number, text_number(F.col("doc_id").cast("string")))
    place = [text_number(F.col("lang")), text_number(F.col("source")), F.log2(size), number]
    return (
        docs.withColumn("size", size)
        .withColumn("text_crc32", F.crc32(text.cast("binary")))
        .withColumn("_at", F.array(*place))
        .withColumn("_spread", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(BINS * 4096)))
    )


def root(rows: DataFrame, shards: int) -> DataFrame:
    """All rows in one node, which is to become shards 0 to `shards` - 1."""
    return rows.withColumn("shard", F.lit(0)).withColumn("_shards", F.lit(shards))


def route(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Send rows of the nodes that are split to their halves."""
    cell = _cell(F.element_at("_at", F.col("_axis")), F.col("_low"), F.col("_high"))
    bin_ = F.floor(F.col("_spread") / 4096)
    right = (cell > F.col("_cell")) | ((cell == F.col("_cell")) & (bin_ >= F.col("_bin")))
    left_shards = F.floor(F.col("_shards") / 2).cast("int")
    joined = rows.join(splits.withColumnRenamed("_node", "shard"), "shard", "left")
    right = F.col("_axis").isNotNull() & right
    moved = F.when(right, F.col("shard") + left_shards).otherwise(F.col("shard"))
    number = (
        F.when(F.col("_axis").isNull(), F.col("_shards"))
        .when(right, F.col("_shards") - left_shards)
        .otherwise(left_shards)
    )
    kept = [F.col(c) for c in rows.columns if c not in ("shard", "_shards")]
    return joined.select(*kept, moved.alias("shard"), number.alias("_shards"))


def _cell(value: Column, low: Column, high: Column) -> Column:
    width = F.when(high > low, high - low).otherwise(F.lit(1.0))
    return F.least(F.floor((value - low) / width * CELLS), F.lit(CELLS - 1))


def find_splits(rows: DataFrame) -> DataFrame:
    """Axis, cell and bin at which each node of more than one shard is split."""
    axes = range(1, len(DIMENSIONS) + 1)
    open_ = rows.filter(F.col("_shards") > 1)
    at = [F.element_at("_at", i) for i in axes]
    bounds = rows.agg(
        F.array(*[F.min(a) for a in at]).alias("_all_low"),
        F.array(*[F.max(a) for a in at]).alias("_all_high"),
    )
    nodes = open_.groupBy(F.col("shard").alias("_node"), "_shards").agg(
        F.sum("size").alias("_bytes"),
        F.array(*[F.min(a) for a in at]).alias("_lows"),
        F.array(*[F.max(a) for a in at]).alias("_highs"),
    )

    def share(i: int) -> Column:
        """A node's width along an axis, as a share of the whole table's."""
        whole = F.element_at("_all_high", i) - F.element_at("_all_low", i)
        own = F.element_at("_highs", i) - F.element_at("_lows", i)
        return F.when(whole > 0, own / whole).otherwise(F.lit(0.0))

    widths = F.array(*[share(i) for i in axes])
    # One row of bounds meets one row for each node.
    nodes = nodes.join(bounds, F.lit(True)).withColumn(
        "_axis", F.array_position(widths, F.array_max(widths)).cast("int")
    )
    left = F.floor(F.col("_shards") / 2) / F.col("_shards")
    nodes = nodes.select(
        "_node",
        "_axis",
        F.element_at("_lows", F.col("_axis")).alias("_low"),
        F.element_at("_highs", F.col("_axis")).alias("_high"),
        (F.col("_bytes") * left).alias("_goal"),
    )
    nodes = saved(nodes, "kd-nodes")
    placed = open_.join(nodes, F.col("shard") == F.col("_node"))
    cell = _cell(F.element_at("_at", F.col("_axis")), F.col("_low"), F.col("_high"))
    key = ["_node", "_axis", "_low", "_high", "_goal"]
    cells = placed.groupBy(*key, cell.alias("_cell")).agg(F.sum("size").alias("_sum"))
    upto = Window.partitionBy("_node").orderBy("_cell")
    first = Window.partitionBy("_node").orderBy("_cell")
    cells = (
        cells.withColumn("_upto", F.sum("_sum").over(upto))
        .filter(F.col("_upto") >= F.col("_goal"))
        .withColumn("_row", F.row_number().over(first))
        .filter("_row = 1")
        .select(*key, "_cell", (F.col("_goal") - F.col("_upto") + F.col("_sum")).alias("_rest"))
    )
    cells = saved(cells, "kd-cells")
    inside = open_.join(cells, F.col("shard") == F.col("_node")).filter(cell == F.col("_cell"))
    key += ["_cell", "_rest"]
    bins = inside.groupBy(*key, F.floor(F.col("_spread") / 4096).alias("_bin")).agg(
        F.sum("size").alias("_sum")
    )
    upto = Window.partitionBy("_node").orderBy("_bin")
    bins = bins.withColumn("_upto", F.sum("_sum").over(upto))
    near = F.col("_upto") - F.col("_sum") / 2 <= F.col("_rest")
    found = bins.groupBy("_node", "_axis", "_low", "_high", "_cell").agg(
        (F.coalesce(F.max(F.when(near, F.col("_bin"))), F.lit(-1)) + 1).alias("_bin")
    )
    return saved(found, "kd-splits")


def assign(rows: DataFrame, shards: int) -> tuple[DataFrame, list[DataFrame]]:
    """`shard` for measured rows, 0 to `shards` - 1, of nearly equal bytes; and the splits.

    Rows with equal metadata are divided by hash; equal rows stay together. Fewer rows
    than shards leave some shards empty.
    """
    rows, levels = saved(root(rows, shards), "kd-rows"), []
    for _ in range(max(shards - 1, 0).bit_length()):
        levels.append(find_splits(rows))
        rows = saved(route(rows, levels[-1]), "kd-rows")
    return rows.drop("_shards"), levels


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """How many shards of about `target_bytes` measured rows make."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    return max(1, round(total / target_bytes))


def with_slots(rows: DataFrame) -> DataFrame:
    """`slot`: a row's place within its shard, from 0 without gaps."""
    order = [F.col("_spread"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    counted = rows.withColumn("_one", F.lit(1).cast("long")).withColumn(
        "_bin", F.floor(F.col("_spread") / 4096)
    )
    return prefix_sums(counted, ["shard"], "_bin", order, "_one", "slot").drop("_one", "_bin")


def shard(docs: DataFrame, shards: int) -> DataFrame:
    """Shard and slot of each document: one row each, without its text.

    Null texts have no bytes; a row counts 16 bytes more than its text.
    """
    rows, _ = assign(_bare(docs), shards)
    return with_slots(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _bare(docs: DataFrame) -> DataFrame:
    return measured(docs.select("doc_id", "text", "lang", "source")).drop("text", "lang", "source")


def with_shards(docs: DataFrame, shards: int) -> DataFrame:
    """All rows with their `shard`; texts are not shuffled for it.

    The tree is built from the metadata alone, and rows then pass through its splits.
    Columns `shard`, `size` and `text_crc32` are replaced, all others kept, whatever their
    names.
    """
    _, levels = assign(_bare(docs), shards)
    own = all_columns(docs, "shard", "size", "text_crc32")
    rows = measured(docs.select(own, "doc_id", "text", "lang", "source"))
    rows = root(rows.drop("doc_id", "text", "lang", "source"), shards)
    for splits in levels:
        rows = route(rows, splits)
    return rows.select("_all.*", "size", "text_crc32", F.col("shard").cast("int").alias("shard"))


def write_shards(docs: DataFrame, shards: int, folder: str) -> None:
    """Parquet files in a folder for each shard."""
    with_shards(docs, shards).repartition("shard").write.partitionBy("shard").parquet(folder)
