"""What the batches of streaming jobs report, as a table."""

import datetime
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from matchlive.sources.tables import read_table

BATCHES = """
    query_name STRING,
    run_id STRING,
    batch_id BIGINT,
    started TIMESTAMP,
    rows_in BIGINT,
    rows_late BIGINT,
    state_rows BIGINT,
    milliseconds BIGINT
"""


class BatchTable(StreamingQueryListener):
    """Appends a row for every batch of the session's queries.

    Rows are written some at a time, and when a query ends. ``rows_late`` are
    those that came behind the watermark and were dropped. ``state_rows`` is
    what the state operators report, which RocksDB only counts if it is told to.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 100):
        self.spark, self.path, self.rows_per_file = spark, path, rows_per_file
        self.rows: list[tuple] = []
        self.ended = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        batch = event.progress
        operators = batch.stateOperators
        self.rows.append(
            (
                batch.name,
                str(batch.runId),
                batch.batchId,
                datetime.datetime.fromisoformat(batch.timestamp.replace("Z", "+00:00")),
                batch.numInputRows,
                sum(state.numRowsDroppedByWatermark for state in operators),
                sum(state.numRowsTotal for state in operators),
                batch.durationMs.get("triggerExecution", 0),
            )
        )
        if len(self.rows) >= self.rows_per_file:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()
        self.ended += 1

    def wait_for(self, runs: int, seconds: float = 60) -> None:
        """Until so many runs are known to have ended; news of batches comes a little after they end."""
        deadline = time.monotonic() + seconds
        while self.ended < runs and time.monotonic() < deadline:
            time.sleep(0.1)

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            frame = self.spark.createDataFrame(rows, BATCHES)
            frame.coalesce(1).write.mode("append").parquet(self.path)


def batches(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BATCHES)
