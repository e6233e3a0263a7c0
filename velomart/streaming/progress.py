"""Progress of streaming queries as a table, and verdicts on it.

A listener notes every micro-batch: its number, input rows, rows that came too late, state rows and
watermark. A query that hangs makes no progress though others may write to its folders, so this
tells more than the age of files.
"""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from velomart.functions import elapsed
from velomart.params import Params
from velomart.sources import storage

PROGRESS = (
    "query string, run_id string, batch long, happened_at timestamp, input_rows long, "
    "late_rows long, state_rows long, watermark timestamp"
)


class ProgressLog(StreamingQueryListener):
    """Notes progress in small JSON files below ``path``, ``every`` batches to a file.

    Add it with ``spark.streams.addListener``; what a query has left is written when it ends.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self._spark, self._path, self._every = spark, path, every
        self._rows: list[dict] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._note(event.progress)

    def catch_up(self, query: StreamingQuery) -> None:
        """Note what a query that ended has told; events arrive later than the end of a query."""
        for progress in query.recentProgress:
            self._note(progress)
        self.flush()

    def _note(self, p: StreamingQueryProgress) -> None:
        states = p.stateOperators
        row = {
            "query": p.name or str(p.id),
            "run_id": str(p.runId),
            "batch": p.batchId,
            "happened_at": p.timestamp,
            "input_rows": p.numInputRows,
            "late_rows": sum(s.numRowsDroppedByWatermark for s in states),
            "state_rows": sum(s.numRowsTotal for s in states),
            "watermark": dict(p.eventTime).get("watermark"),
        }
        with self._lock:
            self._rows.append(row)
            due = len(self._rows) >= self._every
        if due:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            text = "\n".join(map(json.dumps, rows))
            storage.write_text(self._spark, f"{self._path}/{uuid.uuid4().hex}.json", text)


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).json(path)


def check_queries(progress: DataFrame, expected: DataFrame, p: Params) -> DataFrame:
    """(query, status, batches, input_rows, late_rows, minutes) for each ``query`` expected to run.

    EMPTY without any progress, STALE if the last is older than ``liveness_minutes``. A batch that
    was noted twice, since it ran again, counts once.
    """
    seconds = elapsed("SECOND", F.lit(p.as_of).cast("timestamp"), F.col("last_at"))
    once = progress.groupBy("query", "batch").agg(
        F.max("happened_at").alias("last_at"), F.max("input_rows").alias("input_rows"), F.max("late_rows").alias("late_rows")
    )
    seen = once.groupBy("query").agg(
        F.max("last_at").alias("last_at"),
        F.count_if(F.col("input_rows") > 0).alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"),
    )
    verdict = (
        F.when(F.col("last_at").isNull(), "EMPTY")
        .when(seconds > p.liveness_minutes * 60, "STALE")
        .otherwise("OK")
    )
    none = F.lit(0).cast("long")
    return expected.join(seen, "query", "left").select(
        "query",
        verdict.alias("status"),
        *[F.coalesce(c, none).alias(c) for c in ("batches", "input_rows", "late_rows")],
        F.round(seconds / 60, 1).alias("minutes"),
    )
