"""A2 at job level: running totals of observed metrics, per streaming query.

The reference collects its audit lines in a job-wide accumulator. Here each
micro-batch reports an observed metric (`df.observe(name, ...)`), and this
listener keeps one running total per (query, metric), like an accumulator's
value, so the driver never holds the lines themselves. The listener's totals end
with the driver; `record_total` keeps a run's total, and a bounded number of
lines, in the shared folder with each batch, and `audit_total` reads them back.
"""

from __future__ import annotations

import logging
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from packetflow.sinks.batch import CommitLog, stream_run_id

log = logging.getLogger(__name__)


class ObservedTotals(StreamingQueryListener):
    """Sums the numeric fields of the named observed metrics over batches."""

    def __init__(self, names: tuple[str, ...] = ("messages",)):
        self.names = names
        self._lock = threading.Lock()
        self._totals: dict[tuple[str, str], int] = {}
        self._last: dict[str, int] = {}        # last batch counted, by query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query = str(progress.id)
        with self._lock:
            if progress.batchId <= self._last.get(query, -1):  # an event may repeat a batch
                return
            self._last[query] = progress.batchId
            for name in self.names:
                row = (progress.observedMetrics or {}).get(name)
                if row is None:
                    continue
                for field, value in row.asDict().items():
                    key = (query, f"{name}.{field}")
                    self._totals[key] = self._totals.get(key, 0) + int(value or 0)
                    log.info("query %s batch %d: %s.%s = %s (total %d)", progress.name,
                             progress.batchId, name, field, value, self._totals[key])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query_id, metric: str) -> int:
        """Running total of `metric` ("<observation>.<field>") for one query."""
        with self._lock:
            return self._totals.get((str(query_id), metric), 0)


# ------------------------------------------------------- totals that outlive the driver

AUDIT_SAMPLE = 20          # audit lines that a batch's record holds at most


def totals_log(checkpoint: str) -> CommitLog:
    return CommitLog(f"{checkpoint.rstrip('/')}/audit-totals")


def record_total(spark: SparkSession, checkpoint: str, batch_id: int, run_id: str, count: int,
                 lines: list[str]) -> None:
    """Note a batch's count, some of its lines and the run's total, with the batch before.

    A batch that is replayed is noted anew, from the same batch before.
    """
    marks = totals_log(checkpoint)
    before = marks.note(spark, batch_id - 1, run_id) or {"total": 0}
    marks.mark(spark, batch_id, run_id, {"batch": batch_id, "count": count,
                                         "total": before["total"] + count, "lines": lines})


def audit_total(spark: SparkSession, checkpoint: str, run_id: str | None = None) -> dict:
    """A2 after a restart: {batch, count, total, lines} as of the run's last recorded batch.

    Without `run_id`, that of the stream with this checkpoint.
    """
    marks = totals_log(checkpoint)
    run_id = run_id or stream_run_id(spark, checkpoint)
    last = marks.last(spark, run_id)
    if last is None:
        return {"batch": None, "count": 0, "total": 0, "lines": []}
    return marks.note(spark, last, run_id)
