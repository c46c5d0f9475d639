"""What the micro-batches of queries report: rule counts, late rows, state.

A query object remembers its last hundred reports only, and forgets them when it stops.
The keeper writes each one to a folder, under the query's id (which lives as long as
its checkpoint) and the batch; a batch that is run again overwrites its own report. A
report comes after its batch, so that one may be missing if the driver dies; counts that
must be exact belong to the batch itself, as in `append_batches`.
"""

from __future__ import annotations

import json
import threading
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cardinel.sources.paths import read_if_present

REPORT = "name string, late_rows bigint, metrics string"
KEYS = "query_id string, batch_id bigint"


class ProgressKeeper(StreamingQueryListener):
    """Keeps the reports of all queries of a session, between `start` and `stop`.

    With `only_late` just those of batches that dropped late rows, so that others cost nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, only_late: bool = False):
        self.spark, self.folder, self.only_late = spark, folder, only_late
        self.ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self.failed: list[Exception] = []

    def start(self) -> ProgressKeeper:
        self.spark.streams.addListener(self)
        return self

    def stop(self, *queries: StreamingQuery) -> None:
        """Wait until all reports of stopped queries are kept, then keep no more.

        However long that takes; raises the error of a report that could not be written.
        """
        for query in queries:
            self.ended[str(query.runId)].wait()
        self.spark.streams.removeListener(self)
        if self.failed:
            raise self.failed[0]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def onQueryProgress(self, event) -> None:
        try:
            self._keep(event.progress)
        except Exception as error:  # it would only be logged, and the report be missing
            self.failed.append(error)

    def _keep(self, progress) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        if self.only_late and not late:
            return
        metrics = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        row = self.spark.createDataFrame([(progress.name, late, json.dumps(metrics))], REPORT)
        place = f"{self.folder}/query_id={progress.id}/batch_id={progress.batchId}"
        row.coalesce(1).write.mode("overwrite").json(place)


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All kept reports; none if there are none yet."""
    schema = f"{REPORT}, {KEYS}"
    reports = read_if_present(lambda: spark.read.schema(schema).json(folder))
    return spark.createDataFrame([], schema) if reports is None else reports


def kept_counts(reports: DataFrame, metric: str) -> DataFrame:
    """`rule` and `n` of a metric, added up over all batches."""
    counts = F.from_json("metrics", "map<string,map<string,bigint>>")[metric]
    return reports.select(F.explode(counts).alias("rule", "n")).groupBy("rule").agg(
        F.sum("n").alias("n")
    )


def kept_late_rows(reports: DataFrame) -> DataFrame:
    """Rows of each query that were dropped as older than the watermark."""
    return reports.groupBy("query_id").agg(F.sum("late_rows").alias("late_rows"))


def observed_counts(query: StreamingQuery, metric: str) -> dict[str, int]:
    """Rule counts of a query's recent batches, a hundred at most, added up."""
    total: Counter[str] = Counter()
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(metric)
        if row is not None:
            total.update({name: count or 0 for name, count in row.asDict().items()})
    return dict(total)


def late_rows(query: StreamingQuery) -> int:
    """Rows of a query's recent batches, a hundred at most, older than the watermark.

    A salted match drops a late watchlist entry once per salt.
    """
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def state_rows(query: StreamingQuery) -> int:
    """Rows in state after the last micro-batch; 0 if they are not counted."""
    last = query.lastProgress
    return sum(operator.numRowsTotal for operator in last.stateOperators) if last else 0
