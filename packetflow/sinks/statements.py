"""N1-N3 by bound statements: the user's own SQL, executed for batches of rows.

The reference prepares one statement, e.g. `INSERT INTO t VALUES (?, ?, ...) ON
CONFLICT ...`, binds each row's columns in order, sends 100 rows at a time and
repeats a failing batch up to five times. Here each task opens one connection
(from a factory that the caller gives, e.g. a driver's `connect`), and does the
same over its rows with `executemany`, a transaction a batch.

A batch that fails is rolled back and repeated alone; batches that are
committed stay. If the task is lost in between, Spark runs it again from its
first row, so the statement should be one that can be repeated (an upsert), as
in the reference.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow.fixed import JDBC_BATCH_SIZE, JDBC_RETRIES
from packetflow.session import ship_package
from packetflow.sinks.batch import DEFAULT_RUN, JDBC_RETRY_PAUSE_S, CommitLog

log = logging.getLogger(__name__)

Connect = Callable[[], Any]        # -> a DB-API 2.0 connection


class _Writer:
    """One connection; statements are executed a batch at a time."""

    def __init__(self, connect: Connect, sql: str, retries: int, pause_s: float):
        self.connect, self.sql, self.retries, self.pause_s = connect, sql, retries, pause_s
        self.connection = connect()
        self.repeated = 0

    def _recover(self) -> None:
        """Roll back; a connection that can't is replaced."""
        try:
            self.connection.rollback()
        except Exception as exc:  # noqa: BLE001 - any driver's error
            log.warning("connection lost: %s", exc)
            self.close()
            self.connection = self.connect()

    def execute(self, rows: list[tuple]) -> None:
        for attempt in range(self.retries + 1):
            try:
                cursor = self.connection.cursor()
                try:
                    cursor.executemany(self.sql, rows)
                finally:
                    cursor.close()
                self.connection.commit()
                return
            except Exception as exc:  # noqa: BLE001 - any driver's error
                if attempt == self.retries:
                    raise
                log.warning("batch of %d rows failed (attempt %d of %d): %s", len(rows),
                            attempt + 1, self.retries + 1, exc)
                self.repeated += 1
                time.sleep(self.pause_s * 2 ** attempt)
                self._recover()

    def close(self) -> None:
        try:
            self.connection.close()
        except Exception as exc:  # noqa: BLE001 - it is of no use any more
            log.warning("closing the connection failed: %s", exc)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


@dataclass
class StatementTarget:
    """Rows bound, column by column, to `sql` over connections of `connect`.

    Timestamps are bound as date-times in UTC, with their zone; those without a
    zone as they are. `max_connections` tasks write at a time; the rows are
    dealt to them, so the stages before keep their partitions.
    """

    sql: str
    connect: Connect
    batch_size: int = JDBC_BATCH_SIZE
    retries: int = JDBC_RETRIES
    retry_pause_s: float = JDBC_RETRY_PAUSE_S
    max_connections: int = 8
    commit_log: str | None = None

    def with_commit_log(self, folder: str) -> StatementTarget:
        """This target with its markers in `folder`, unless it has a place for them already."""
        return self if self.commit_log else replace(self, commit_log=folder)

    def write(self, df: DataFrame, batch_id: int, run_id: str = DEFAULT_RUN) -> dict[str, int]:
        """Write a batch, unless it is marked as written; (rows, batches, repeated) of it."""
        spark = df.sparkSession
        marks = CommitLog(self.commit_log) if self.commit_log else None
        if marks and marks.done(spark, batch_id, run_id):
            log.info("batch %d already written; skipped", batch_id)
            return {"rows": 0, "batches": 0, "repeated": 0}
        ship_package(spark)
        sql, connect, size = self.sql, self.connect, self.batch_size
        retries, pause_s = self.retries, self.retry_pause_s

        def run(batches):
            rows = _rows(batches)
            written = executed = repeated = 0
            part = list(islice(rows, size))
            if part:
                writer = _Writer(connect, sql, retries, pause_s)
                try:
                    while part:
                        writer.execute(part)
                        written, executed = written + len(part), executed + 1
                        part = list(islice(rows, size))
                    repeated = writer.repeated
                finally:
                    writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()) for n in (written, executed, repeated)],
                names=["rows", "batches", "repeated"])

        done = (df.repartition(self.max_connections)
                .mapInArrow(run, "rows long, batches long, repeated long")
                .agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "batches", "repeated")))
                .first().asDict())
        if marks:
            marks.mark(spark, batch_id, run_id)
        return done
