"""Starting and finishing streaming queries.

Every query gets a checkpoint location in the shared checkpoint folder and a
query name, so a restarted driver resumes from the last committed batch.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

BatchFn = Callable[[DataFrame, int], None]


def trigger_options(trigger: str | dict | None) -> dict:
    """"available-now" (default), "once", or an interval such as "200 milliseconds" for a processing-time trigger."""
    if isinstance(trigger, dict):
        return trigger
    if trigger in (None, "available-now", "availableNow"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def start_stream(df: DataFrame, checkpoint: str, query_name: str,
                 each_batch: BatchFn | None = None, path: str | None = None,
                 fmt: str = "parquet", trigger: str | dict | None = None,
                 output_mode: str = "append") -> StreamingQuery:
    """Start `df` into `each_batch` (foreachBatch) or a file sink at `path`."""
    writer = (df.writeStream.outputMode(output_mode).queryName(query_name)
              .option("checkpointLocation", checkpoint)
              .trigger(**trigger_options(trigger)))
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    if path is None:
        raise ValueError("need a batch function or an output path")
    return writer.format(fmt).option("path", path).start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an available-now / once query to finish; re-raise its error."""
    finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError(f"stream {query.name} did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name} failed: {query.exception()}")
    return query


def observed(query: StreamingQuery, name: str) -> list[dict]:
    """Observed metrics named `name` from every progress report still held."""
    out = []
    for progress in query.recentProgress:
        metrics = (progress.get("observedMetrics") or {}).get(name)
        if metrics:
            out.append(metrics.asDict() if hasattr(metrics, "asDict") else dict(metrics))
    return out


def late_rows_dropped(query: StreamingQuery) -> int:
    """W4's counter: rows dropped as late by stateful operators, over the
    progress reports still held (`numRowsDroppedByWatermark`)."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for progress in query.recentProgress
               for op in progress.get("stateOperators", []))
