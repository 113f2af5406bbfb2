"""Writing each micro-batch to a table, known by run and batch id.

`foreachBatch` is at-least-once: after a failure Spark replays the last batch
with the same id. Batch ids start at 0 in every run, so a batch is known by the
run's id as well: a stream's is kept with its checkpoint (`stream_run_id`), a
bounded run has a new one unless the caller names it. Another run adds its
rows; the same run again replaces or skips its own. Two targets:

* `TableTarget` - any Spark file format. Rows go to partition
  `run_id=<run>/batch_id=<id>` with dynamic partition overwrite, so a replay
  replaces the batch instead of adding it again (exactly-once).
* `JdbcTarget` - Spark's JDBC writer. A marker file per committed batch in the
  shared checkpoint folder makes a replay skip a batch that already committed.
  Spark commits each partition by itself, so a plain append is at-least-once:
  if the batch fails part-way, or the driver is lost before the marker, what
  was committed is there twice after the replay. With a staging table the
  append is one statement of the user's, which can be made to repeat safely.
  The reference binds rows into free-form SQL (possibly an upsert); here that
  is `merge_sql`: the batch is written to `staging_table` (overwritten each
  batch) and the statement, e.g. `INSERT INTO t SELECT * FROM t_staging ON
  CONFLICT DO NOTHING`, runs once per batch over one JDBC connection.

Retries: what can be repeated (a file partition, a staging table, the merge
statement) is tried again up to `retries` times with a pause (the reference's
JDBC policy: batches of 100 rows, 5 retries). A plain append is not: its retry
would add the committed partitions again.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.fixed import JDBC_BATCH_SIZE, JDBC_RETRIES
from packetflow.sinks.compaction import is_merged, manifest, merge_batches, read_table
from packetflow.sinks.files import hadoop_path, list_names, read_text, write_text

log = logging.getLogger(__name__)

JDBC_RETRY_PAUSE_S = 0.2


DEFAULT_RUN = "0"


def new_run_id() -> str:
    return uuid.uuid4().hex


def stream_run_id(spark: SparkSession, checkpoint: str) -> str:
    """The run id of the stream with this checkpoint: made at its first start, kept there.

    It is the name of an empty file, so that making it is one atomic step.
    """
    p, fs = hadoop_path(spark, f"{checkpoint.rstrip('/')}/run-id")
    if not fs.exists(p):
        first, _ = hadoop_path(spark, f"{checkpoint.rstrip('/')}/run-id/{new_run_id()}")
        fs.create(first, True).close()
    return sorted(s.getPath().getName() for s in fs.listStatus(p))[0]


class CommitLog:
    """An empty marker file for each of a run's last two committed batches, in a shared folder.

    Spark only ever replays a run's last batch, so older markers are removed.
    """

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def _marker(self, batch_id: int, run_id: str) -> str:
        return f"{self.folder}/{run_id}/{int(batch_id)}"

    def done(self, spark: SparkSession, batch_id: int, run_id: str = DEFAULT_RUN) -> bool:
        p, fs = hadoop_path(spark, self._marker(batch_id, run_id))
        return fs.exists(p)

    def mark(self, spark: SparkSession, batch_id: int, run_id: str = DEFAULT_RUN,
             note: dict | None = None) -> None:
        """Mark a batch; a `note` is kept in its marker, which is there as a whole or not at all."""
        p, fs = hadoop_path(spark, self._marker(batch_id, run_id))
        if note is None:
            fs.create(p, True).close()
        else:
            write_text(spark, self._marker(batch_id, run_id), json.dumps(note))
        old, _ = hadoop_path(spark, self._marker(batch_id - 2, run_id))
        fs.delete(old, False)

    def note(self, spark: SparkSession, batch_id: int, run_id: str = DEFAULT_RUN) -> dict | None:
        """What was noted with a batch that is still kept."""
        p, fs = hadoop_path(spark, self._marker(batch_id, run_id))
        return json.loads(read_text(spark, self._marker(batch_id, run_id))) if fs.exists(p) else None

    def last(self, spark: SparkSession, run_id: str = DEFAULT_RUN) -> int | None:
        """The run's last batch that is marked."""
        names = list_names(spark, f"{self.folder}/{run_id}")
        return max((int(n) for n in names if n.lstrip("-").isdigit()), default=None)


def with_retries(action, retries: int, pause_s: float, what: str):
    for attempt in range(retries + 1):
        try:
            return action()
        except Exception as exc:  # noqa: BLE001 - any write failure is retried
            if attempt == retries:
                raise
            log.warning("%s failed (attempt %d of %d): %s", what, attempt + 1, retries + 1, exc)
            time.sleep(pause_s * (2 ** attempt))


@dataclass
class TableTarget:
    """A file table at `path`, partitioned by run and batch id (exactly-once).

    One partition per micro-batch: on a long-running stream use a trigger of
    a minute or more, and merge the folders of closed batches, by
    `sinks.compaction.merge_batches` or every `merge_every` batches here. Merged
    tables are to be read by `read`, which knows what has been merged.
    """

    path: str
    format: str = "parquet"
    retries: int = 2
    retry_pause_s: float = 0.2
    merge_every: int | None = None

    def write(self, df: DataFrame, batch_id: int, run_id: str = DEFAULT_RUN) -> None:
        if is_merged(manifest(df.sparkSession, self.path), run_id, batch_id):
            raise ValueError(f"batch {batch_id} of run {run_id} is closed: {self.path} has merged it")
        out = df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(int(batch_id))})
        with_retries(
            lambda: (out.write.format(self.format).mode("overwrite")
                     .option("partitionOverwriteMode", "dynamic")
                     .partitionBy("run_id", "batch_id").save(self.path)),
            self.retries, self.retry_pause_s, f"write of batch {batch_id} to {self.path}")
        if self.merge_every and batch_id > 0 and batch_id % self.merge_every == 0:
            merge_batches(df.sparkSession, self.path, run_id, self.format)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, self.format).drop("run_id", "batch_id")


@dataclass
class JdbcTarget:
    """N4 connection + N3 write policy for Spark's JDBC writer."""

    url: str
    table: str
    driver: str | None = None
    user: str | None = None
    password: str | None = None
    batch_size: int = JDBC_BATCH_SIZE
    retries: int = JDBC_RETRIES
    retry_pause_s: float = JDBC_RETRY_PAUSE_S
    # Writers at a time. The rows to write are dealt to as many partitions, so that the
    # stages before keep theirs (Spark's own cap would run them in as few tasks).
    max_connections: int = 8
    commit_log: str | None = None
    staging_table: str | None = None
    merge_sql: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if (self.staging_table is None) != (self.merge_sql is None):
            raise ValueError("staging_table and merge_sql go together")

    def options(self) -> dict[str, str]:
        table = self.staging_table or self.table
        opts = {"url": self.url, "dbtable": table, "batchsize": str(self.batch_size),
                "numPartitions": str(self.max_connections)}
        if self.staging_table:
            # Overwrite keeps the staging table's definition (TRUNCATE, not DROP).
            opts["truncate"] = "true"
        for key, value in (("driver", self.driver), ("user", self.user),
                           ("password", self.password)):
            if value is not None:
                opts[key] = value
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts

    def with_commit_log(self, folder: str) -> JdbcTarget:
        """This target with its markers in `folder`, unless it has a place for them already."""
        return self if self.commit_log else replace(self, commit_log=folder)

    def _save(self, rows: DataFrame, mode: str) -> None:
        rows.write.format("jdbc").options(**self.options()).mode(mode).save()

    def write(self, df: DataFrame, batch_id: int, run_id: str = DEFAULT_RUN) -> None:
        spark = df.sparkSession
        marks = CommitLog(self.commit_log) if self.commit_log else None
        if marks and marks.done(spark, batch_id, run_id):
            log.info("batch %d already written to %s; skipped", batch_id, self.table)
            return
        rows = df.repartition(self.max_connections)
        if not self.staging_table:
            self._save(rows, "append")
        else:
            with_retries(lambda: self._save(rows, "overwrite"),
                         self.retries, self.retry_pause_s, f"JDBC write of batch {batch_id}")
            with_retries(lambda: run_jdbc_statement(spark, self.url, self.merge_sql, self.user,
                                                    self.password, self.driver),
                         self.retries, self.retry_pause_s, f"merge of batch {batch_id}")
        if marks:
            marks.mark(spark, batch_id, run_id)


def run_jdbc_statement(spark: SparkSession, url: str, sql: str, user: str | None = None,
                       password: str | None = None, driver: str | None = None) -> int:
    """Run one SQL statement over a JDBC connection opened by the driver's JVM.

    Returns the update count (-1 for statements without one).
    """
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    props = jvm.java.util.Properties()
    if user is not None:
        props.setProperty("user", user)
    if password is not None:
        props.setProperty("password", password)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        stmt = conn.createStatement()
        try:
            stmt.execute(sql)
            return stmt.getUpdateCount()
        finally:
            stmt.close()
    finally:
        conn.close()


def traffic_bind_order(traffic: DataFrame) -> DataFrame:
    """The traffic sink's column order (from, to, count, start, end, kind, job)."""
    return traffic.select("from_node", "to_node", "packet_count", "window_start",
                          "window_end", "kind", "job_id")


def text_bind_order(messages: DataFrame) -> DataFrame:
    """Text sink columns; the local `time` is stored as if it were UTC."""
    from packetflow.functions.columns import local_as_utc_instant

    return messages.select("from_node", "to_node", "channel",
                           local_as_utc_instant("time").alias("time"), "text", "job_id")
