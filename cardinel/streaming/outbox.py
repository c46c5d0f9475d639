"""Notifications as a table for a mail service to deliver.

Alerts that carry the batch that raised them (their upstream batch) are delivered by that
batch: its part of the outbox is made from all of its alerts, as they stand, and replaces
what was there. Alerts that are read twice because their batch was written again thus
leave their notifications there once, as do batches of the outbox that are run again.
Other alerts are delivered by the micro-batch that reads them. A new checkpoint leaves
what an old one has delivered alone.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardinel.session import settings
from cardinel.sources.paths import read_if_present
from cardinel.streaming.batches import BATCH, OWN_PARTITION, rows_of_batches, writer_id
from cardinel.streaming.runner import CATCH_UP

log = logging.getLogger(__name__)

NOTIFICATION = (
    "alert_id string, recipient string, subject string, body string, "
    "deliverable boolean, batch_id bigint, query_id string, upstream string"
)


def write_outbox(notifications: DataFrame, folder: str, query_id: str, batch_id: int) -> None:
    """Put notifications into the parts of the outbox of their upstream batches.

    Those without a `batch` column go into the part of this batch of the outbox.
    """
    by = F.col(BATCH) if BATCH in notifications.columns else F.lit(str(batch_id))
    rows = notifications.withColumns(
        {"batch_id": F.lit(batch_id).cast("long"), "query_id": F.lit(query_id), "upstream": by}
    )
    with settings(notifications.sparkSession, OWN_PARTITION):
        rows.drop(BATCH).write.mode("overwrite").partitionBy("query_id", "upstream").parquet(folder)


def attach_outbox(
    alerts: DataFrame,
    render: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
    enabled: bool = True,
    trigger: Mapping[str, object] = CATCH_UP,
    table: str | None = None,
) -> StreamingQuery:
    """Start rendering a stream of alerts into an outbox.

    `table` names the table that the alerts stream from, if it is one that `append_batches`
    writes. If not enabled, batches are passed over, as if they had been delivered.
    """
    query_id = writer_id(alerts.sparkSession, checkpoint)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        if not enabled:
            log.warning("batch %s: notifications are off, nothing written", batch_id)
            return
        if table is not None:
            # A batch of the outbox may have got some files of an upstream batch only.
            keys = [row[0] for row in batch.select(BATCH).distinct().collect()]
            batch = rows_of_batches(batch.sparkSession, table, keys)
        write_outbox(render(batch), folder, query_id, batch_id)
        log.info("batch %s: notifications written to %s", batch_id, folder)

    return (
        alerts.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(deliver)
        .start()
    )


def read_outbox(spark: SparkSession, folder: str) -> DataFrame:
    """All notifications; none if no batch has been written yet."""
    outbox = read_if_present(lambda: spark.read.schema(NOTIFICATION).parquet(folder))
    return spark.createDataFrame([], NOTIFICATION) if outbox is None else outbox


def outbox_stats(outbox: DataFrame) -> DataFrame:
    """Notifications of each batch: all, those that can be delivered, and the rest."""
    return outbox.groupBy("query_id", "batch_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("deliverable").alias("succeeded"),
        F.count_if(~F.col("deliverable")).alias("failed"),
    )
