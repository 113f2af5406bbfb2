"""Which notifications of a batch have been sent.

A task writes down each message it has sent, by the message's key, in files of
the shared folder, while it runs. If it dies half-way, its next attempt skips
what is written down under its own name; if the job dies, a replay of the batch
sends only what isn't written down at all. Messages may be equal to each other,
so a key counts as often as it was sent.

Workers write through pyarrow's file systems (local and shared mounts, HDFS,
S3). A file is written under a hidden name and then renamed, so a reader sees
whole files only.
"""

from __future__ import annotations

import time
import uuid
from collections import Counter
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.sinks.batch import DEFAULT_RUN
from packetflow.sinks.files import hadoop_path

RECORD_EVERY = 20          # messages that a file of the ledger holds
RECORD_AFTER_S = 1.0       # a message waits no longer than that for its file


def worker_filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Hadoop path and the path in it, for use in a Python worker."""
    if folder.startswith("file:") or "://" not in folder:
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class TaskRecords:
    """What one task has sent: earlier attempts' records, and its own as it goes."""

    def __init__(self, folder: str, every: int):
        context = TaskContext.get()
        self.fs, base = worker_filesystem(folder)
        self.folder = f"{base}/part-{context.partitionId():05d}"
        self.name = f"{context.attemptNumber()}-{uuid.uuid4().hex}"
        self.every, self.files = every, 0
        self.pending: list[str] = []
        self.since = time.monotonic()
        self.fs.create_dir(self.folder, recursive=True)
        self.before: Counter[str] = Counter()
        for info in self.fs.get_file_info(pafs.FileSelector(self.folder)):
            if not info.base_name.startswith("_"):
                with self.fs.open_input_stream(info.path) as f:
                    self.before.update(line.split(",")[0] for line in f.read().decode().splitlines())

    def sent_before(self, key: str) -> bool:
        """Whether an earlier attempt sent a message of this key that isn't accounted for yet."""
        if not self.before[key]:
            return False
        self.before[key] -= 1
        return True

    def add(self, key: str, status: int) -> None:
        self.pending.append(f"{key},{status}")
        if len(self.pending) >= self.every or time.monotonic() - self.since > RECORD_AFTER_S:
            self.flush()

    def flush(self) -> None:
        if self.pending:
            name = f"{self.name}-{self.files:06d}"
            with self.fs.open_output_stream(f"{self.folder}/_{name}") as f:
                f.write(("\n".join(self.pending) + "\n").encode())
            self.fs.move(f"{self.folder}/_{name}", f"{self.folder}/{name}.csv")
            self.files, self.pending = self.files + 1, []
        self.since = time.monotonic()


@dataclass
class Ledger:
    """The records of a run's batches, in `folder`."""

    folder: str
    record_every: int = RECORD_EVERY

    def batch(self, batch_id: int, run_id: str = DEFAULT_RUN) -> str:
        return f"{self.folder.rstrip('/')}/{run_id}/{int(batch_id)}"

    def attempt(self, batch_id: int, run_id: str = DEFAULT_RUN) -> str:
        """A folder for one job that sends the batch."""
        return f"{self.batch(batch_id, run_id)}/{uuid.uuid4().hex}"

    def sent(self, spark: SparkSession, batch_id: int, run_id: str = DEFAULT_RUN) -> DataFrame | None:
        """(key, status) of each message of the batch that was sent; None if none is written down."""
        p, fs = hadoop_path(spark, self.batch(batch_id, run_id))
        if not fs.exists(p):
            return None
        return (spark.read.schema("key string, status int").option("recursiveFileLookup", "true")
                .csv(self.batch(batch_id, run_id)))

    def forget(self, spark: SparkSession, batch_id: int, run_id: str = DEFAULT_RUN) -> None:
        """Remove the records of a batch that is marked as delivered."""
        p, fs = hadoop_path(spark, self.batch(batch_id, run_id))
        fs.delete(p, True)


def not_sent(messages: DataFrame, sent: DataFrame | None) -> DataFrame:
    """The messages (with `key`) but for those sent, each as often as it is still due.

    Equal messages are counted before they meet, so one that makes up a third
    of the batch is one row a task in the shuffle.
    """
    if sent is None:
        return messages
    columns = [c for c in messages.columns if c != "key"]
    due = messages.groupBy("key", *columns).agg(F.count("*").alias("n"))
    done = sent.groupBy("key").agg(F.count("*").alias("m"))
    left = F.col("n") - F.coalesce("m", F.lit(0))
    return (due.join(done, "key", "left").withColumn("left", left.cast("int")).where("left > 0")
            .select("key", *columns, F.explode(F.sequence(F.lit(1), "left")).alias("_copy"))
            .select(*messages.columns))
