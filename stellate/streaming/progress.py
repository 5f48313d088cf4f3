"""Progress of streams as load metrics: a listener appends each micro-batch to a history.

The listener receives one small event for each micro-batch on the driver; rows are counted
by Spark. The history is a table in the shared folder, one row a micro-batch, so the metrics
of many runs and streams are queried like any table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "stream string, run string, batch bigint, at string, rows bigint, sec double, rows_per_sec double"


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of micro-batches until ``write`` appends them to ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows, self.ended = spark, path, [], set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        sec = p.durationMs.get("triggerExecution", 0) / 1000.0
        self.rows.append((str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, sec, float(p.processedRowsPerSecond or 0)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def write(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


@contextmanager
def recorded(spark: SparkSession, path: str) -> Iterator[ProgressLog]:
    """Record the streams that run inside the block to the history at ``path``. Events still
    under way when the block ends are waited for."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        spark.streams.removeListener(log)
        log.write()


def progress_history(spark: SparkSession, path: str) -> DataFrame:
    """One row for each micro-batch that read rows; a replayed one counts once."""
    rows = spark.read.schema(SCHEMA).parquet(path).where("rows > 0")
    return rows.groupBy("stream", "batch").agg(F.max("run").alias("run"), F.max("rows").alias("rows"), F.max("sec").alias("sec"))
