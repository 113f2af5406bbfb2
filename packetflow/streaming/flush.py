"""The windows that a drained stream still holds.

A stream emits a window once the watermark has passed its end, so the last
windows of a bounded replay stay in its state. Spark's state data source reads
them from the checkpoint when the stream has ended; they are written once, as
one more batch of the run, and the checkpoint is closed: a stream that went on
from it would count those packets again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.functions.columns import count_as_int
from packetflow.sinks.files import hadoop_path

FLUSH_BATCH = -1           # batches of a stream count from 0


def open_traffic(spark: SparkSession, checkpoint: str, job_id: str) -> DataFrame:
    """The counts of the windows that are still open at the checkpoint, in schema.TRAFFIC."""
    state = spark.read.format("statestore").load(checkpoint)
    key, window = F.col("key"), F.col("key.window")
    return state.select(
        key["from_node"].alias("from_node"), key["to_node"].alias("to_node"),
        count_as_int(F.col("value.count")).alias("packet_count"),
        window["start"].alias("window_start"), window["end"].alias("window_end"),
        key["kind"].alias("kind"), F.lit(job_id).alias("job_id"))


def has_state(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a batch of the stream has been committed."""
    p, fs = hadoop_path(spark, f"{checkpoint}/commits")
    return fs.exists(p) and any(not s.getPath().getName().startswith(".") for s in fs.listStatus(p))


def _closed_mark(spark: SparkSession, checkpoint: str):
    return hadoop_path(spark, f"{checkpoint}/flushed")


def is_closed(spark: SparkSession, checkpoint: str) -> bool:
    p, fs = _closed_mark(spark, checkpoint)
    return fs.exists(p)


def close(spark: SparkSession, checkpoint: str) -> None:
    p, fs = _closed_mark(spark, checkpoint)
    fs.create(p, True).close()


def refuse_closed(spark: SparkSession, checkpoint: str) -> None:
    if is_closed(spark, checkpoint):
        raise RuntimeError(f"the stream at {checkpoint} has been flushed; start a new one")
