"""Joins of two streams without state: new rows with all earlier ones, from files by key.

A match of what is new with what has been seen, in either order of arrival, needs every
earlier row of both sides. A stateful join keeps them in its state stores for good; here
they are files, dealt into buckets by the join key and sorted by it. A batch joins

    new left rows   with  earlier and new right rows
    earlier left rows  with  new right rows

so that each pair is found once, by the batch that brings its later row. Earlier rows are
read only from the buckets of the new keys, and, if these are few, only from the row
groups whose statistics and Bloom filters may have them. The joins are batch joins:
adaptive execution broadcasts a small side and splits the partitions of hot keys, also of
those that became hot while the stream was running.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardinel.sources.paths import delete_folder, is_present
from cardinel.streaming.batches import Step, follow, is_written, write_batch, writer_id
from cardinel.streaming.folds import side_by_side
from cardinel.streaming.runner import CATCH_UP

BUCKET = "_bucket"
# Keys that are listed in a scan's filter; more go by buckets alone.
LISTED = 1000


@dataclass(frozen=True)
class History:
    """Rows of all batches of one side, by key.

    Each batch has a folder of its own, which a batch that is run again writes anew. The
    folders of `roll` batches are merged once the next ones begin, one file a bucket
    where it fits, so that a row is written twice and small files do not pile up.
    """

    folder: str
    schema: T.StructType
    key: str
    buckets: int = 16
    roll: int = 256

    def _own(self, number: int) -> str:
        return f"{self.folder}/rows/roll={number // self.roll}/batch={number}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, place: str) -> None:
        # A hot bucket is written by several tasks, as adaptive execution sees fit.
        dealt = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
        writer = dealt.sortWithinPartitions(BUCKET, self.key).write.mode("overwrite")
        bloom = {f"parquet.bloom.filter.enabled#{self.key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        writer.options(**bloom).partitionBy(BUCKET).parquet(place)

    def add(self, rows: DataFrame, number: int) -> None:
        """Keep the rows of a batch; those without a key can match nothing and are left out."""
        self._merge(rows.sparkSession, number // self.roll)
        kept = rows.select(*self.schema.names).filter(F.col(self.key).isNotNull())
        self._write(kept, self._own(number))

    def _merge(self, spark: SparkSession, now: int) -> None:
        """Merge the folders of the roll before, if that has not been done."""
        past = f"{self.folder}/rows/roll={now - 1}"
        if now == 0 or not is_present(spark, past):
            return
        done = f"{self.folder}/done/roll={now - 1}"
        if not is_present(spark, f"{done}/_SUCCESS"):
            place = f"{self.folder}/merged/roll={now - 1}"
            self._write(self._read(spark, past).select(*self.schema.names), place)
            spark.createDataFrame([("done",)], "value string").coalesce(1).write.mode("overwrite").text(done)
        delete_folder(spark, past)

    def _read(self, spark: SparkSession, place: str, *parts: str) -> DataFrame | None:
        schema = T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])
        for part in parts:
            schema = schema.add(part, "long")
        return spark.read.schema(schema).parquet(place) if is_present(spark, place) else None

    def own(self, spark: SparkSession, number: int) -> DataFrame:
        """The rows that a batch has kept."""
        return self._read(spark, self._own(number)).select(*self.schema.names)

    def before(self, spark: SparkSession, number: int, keys: DataFrame) -> DataFrame:
        """Earlier rows, at least those with one of the `keys` (one column, of a batch)."""
        merged = self._read(spark, f"{self.folder}/merged", "roll")
        single = self._read(spark, f"{self.folder}/rows", "roll", "batch")
        roll = number // self.roll
        parts = []
        if merged is not None:
            parts.append(merged.filter(F.col("roll") < roll))
        if single is not None and number > 0:
            parts.append(single.filter((F.col("roll") == roll) & (F.col("batch") < number)))
        if not parts:
            return spark.createDataFrame([], self.schema)
        rows = parts[0].select(*self.schema.names, BUCKET)
        for part in parts[1:]:
            rows = rows.union(part.select(*self.schema.names, BUCKET))
        wanted = keys.toDF(self.key).withColumn(BUCKET, self._bucket()).distinct()
        listed = wanted.limit(LISTED + 1).collect()
        if len(listed) <= LISTED:
            rows = rows.filter(F.col(self.key).isin(*[row[0] for row in listed]))
            hit = {row[1] for row in listed}
        else:
            hit = {row[0] for row in wanted.select(BUCKET).distinct().collect()}
        return rows.filter(F.col(BUCKET).isin(*hit)).select(*self.schema.names)


def append_joined(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    join: Callable[[DataFrame, DataFrame], DataFrame],
    table: str,
    folder: str,
    checkpoint: str,
    trigger: Mapping[str, object] = CATCH_UP,
    steps: Sequence[Step] = (),
    buckets: int = 16,
    roll: int = 256,
) -> StreamingQuery:
    """Start writing the join of two streams to a table partitioned by `batch`.

    `join` gets tables of both sides and gives their pairs with equal keys `on` (it may
    drop some of them, but find no others). `folder` gets the rows of both streams.
    """
    spark = left.sparkSession
    sides = [
        History(f"{folder}/{name}", T.StructType([T.StructField(f.name, f.dataType) for f in side.schema]), key, buckets, roll)
        for name, side, key in (("left", left, on[0]), ("right", right, on[1]))
    ]
    lefts, rights = sides
    writer = writer_id(spark, checkpoint)
    tagged = left.select(F.struct("*").alias("left"), F.lit(None).cast(rights.schema).alias("right")).union(
        right.select(F.lit(None).cast(lefts.schema).alias("left"), F.struct("*").alias("right"))
    )

    def write(batch: DataFrame, number: int) -> None:
        session, key = batch.sparkSession, f"{writer}-{number}"
        if not is_written(session, table, key):
            side_by_side(
                session,
                lambda: lefts.add(batch.filter("left is not null").select("left.*"), number),
                lambda: rights.add(batch.filter("right is not null").select("right.*"), number),
            )
            new_left, new_right = lefts.own(session, number), rights.own(session, number)
            found = []
            if not new_left.isEmpty():
                earlier = rights.before(session, number, new_left.select(on[0]))
                found.append(join(new_left, earlier.union(new_right)))
            if not new_right.isEmpty():
                found.append(join(lefts.before(session, number, new_right.select(on[1])), new_right))
            rows = found[0] if found else join(new_left, new_right)
            for more in found[1:]:
                rows = rows.union(more)
            write_batch(rows, table, key)
        follow(session, table, writer, number, steps)

    return (
        tagged.writeStream.option("checkpointLocation", checkpoint)
        .queryName(table)
        .trigger(**trigger)
        .foreachBatch(write)
        .start()
    )
