"""J1-J3 end to end: raw packets -> decode -> event time -> pipeline -> sinks.

The same plan runs on a stream (Kafka / file source) or on a bounded batch
read (a replay between two timestamps runs to completion and flushes every
window). Physical shape per job:

* J1 traffic: scan -> mapInArrow decode (packet part only) -> watermark ->
  filter/project -> partial count -> one Exchange on the group key -> final
  count -> sink. No Python after the decode.
* J2 node info: scan -> decode (node_info part only) -> project -> SQL sink.
  Narrow; no Exchange.
* J3 text: scan -> decode (packet part) -> filter/project -> fan-out in
  foreachBatch: table, audit table, webhook. Narrow; no Exchange.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packetflow.fixed import (
    DEFAULT_CHARSET,
    JOB_KIND_NODE_INFO,
    JOB_KIND_TEXT,
    JOB_KIND_TRAFFIC,
    SINK_INTERVAL,
    TEXT_MESSAGE_PORT,
)
from packetflow.operators.decode import decode_packets
from packetflow.operators.messages import audit_lines, notifications, text_messages
from packetflow.operators.nodes import node_info
from packetflow.operators.traffic import DEFAULT_WINDOW_MINUTES, new_job_id, packet_traffic
from packetflow.sinks.batch import DEFAULT_RUN, CommitLog, JdbcTarget, TableTarget, new_run_id, \
    stream_run_id, text_bind_order, traffic_bind_order
from packetflow.sinks.ledger import Ledger
from packetflow.sinks.sql import create_sink, insert_via_view, keeps_batches, overwrite_via_view
from packetflow.sinks.statements import StatementTarget
from packetflow.sinks.webhook import ORDER_COLUMNS, HttpSender, Sender, deliver_batch
from packetflow.streaming.flush import FLUSH_BATCH, close, has_state, is_closed, open_traffic, \
    refuse_closed
from packetflow.streaming.listener import AUDIT_SAMPLE, record_total
from packetflow.streaming.runner import run_to_end, start_stream
from packetflow.streaming.watermark import DEFAULT_DELAY, with_event_time

log = logging.getLogger(__name__)

Target = TableTarget | JdbcTarget | StatementTarget

# The reference's sink flush interval is the trigger of an unbounded stream into a database. A
# file table gets a folder for each batch, so its batches are larger unless the caller says so.
# Pass trigger="available-now" to drain what is there and stop.
DEFAULT_TRIGGER = "by-target"
FILE_TRIGGER = "1 minute"


def _trigger(trigger, target: Target | None):
    if trigger != DEFAULT_TRIGGER:
        return trigger
    return FILE_TRIGGER if isinstance(target, TableTarget) else SINK_INTERVAL


def _with_log(target: Target | None, folder: str) -> Target | None:
    """A database target without a commit log of its own keeps it with the checkpoint."""
    return target.with_commit_log(folder) if isinstance(target, (JdbcTarget, StatementTarget)) else target


# Packet fields J1 reads (kind and node pair); the rest is not decoded.
TRAFFIC_FIELDS = ("from", "to", "encrypted", "decoded", "portnum")


def decoded(raw: DataFrame, descriptor_set: bytes, message: str,
            parts: tuple[str, ...], delay: str | None = DEFAULT_DELAY,
            packet_fields: tuple[str, ...] | None = None, engine: str = "arrow",
            only_variant: str | None = None, only_port: str | None = None) -> DataFrame:
    """Decode once, then set the watermark (order matters, see streaming.watermark).

    `engine` picks the decoder (operators.decode.decode_packets). The jobs
    without a watermark decode only the rows that they use.
    """
    packets = decode_packets(raw, descriptor_set, message, parts, packet_fields, engine,
                             only_variant, only_port)
    return with_event_time(packets, delay)


# ------------------------------------------------------------------ J1

def traffic_plan(raw: DataFrame, descriptor_set: bytes, message: str,
                 window_minutes: int = DEFAULT_WINDOW_MINUTES, job_id: str | None = None,
                 delay: str | None = DEFAULT_DELAY, engine: str = "arrow") -> DataFrame:
    packets = decoded(raw, descriptor_set, message, ("packet",), delay, TRAFFIC_FIELDS, engine)
    return traffic_bind_order(packet_traffic(packets, window_minutes, job_id))


def run_traffic_job(raw: DataFrame, target: Target, checkpoint: str, descriptor_set: bytes,
                    message: str, window_minutes: int = DEFAULT_WINDOW_MINUTES,
                    job_id: str | None = None, trigger=DEFAULT_TRIGGER,
                    query_name: str = "packet-traffic", engine: str = "arrow",
                    delay: str | None = DEFAULT_DELAY,
                    run_id: str | None = None) -> StreamingQuery | None:
    """J1 (job kind "default"). Returns the streaming query, or None for a batch.

    A bounded run adds its rows under a new run id; with the `run_id` of an
    earlier one it replaces (or, over JDBC, skips) that run's. A stream keeps
    its run id with its checkpoint.
    """
    target = _with_log(target, f"{checkpoint}/table-commits")
    traffic = traffic_plan(raw, descriptor_set, message, window_minutes, job_id, delay, engine)
    if not traffic.isStreaming:
        target.write(traffic, 0, run_id or new_run_id())
        return None
    refuse_closed(raw.sparkSession, checkpoint)
    run = run_id or stream_run_id(raw.sparkSession, checkpoint)
    return start_stream(traffic, checkpoint, query_name,
                        each_batch=lambda df, batch_id: target.write(df, batch_id, run),
                        trigger=_trigger(trigger, target))


def flush_traffic(spark: SparkSession, target: Target, checkpoint: str, job_id: str,
                  run_id: str | None = None) -> None:
    """Write the windows that a J1 stream which has ended still holds, and close its checkpoint.

    They are one more batch of the stream's run: flushing again replaces (or,
    over a database, skips) it. The stream must not run meanwhile, and can't be
    started again after. `job_id` is the one its rows carry.
    """
    target = _with_log(target, f"{checkpoint}/table-commits")
    if has_state(spark, checkpoint):
        run = run_id or stream_run_id(spark, checkpoint)
        target.write(traffic_bind_order(open_traffic(spark, checkpoint, job_id)), FLUSH_BATCH, run)
    close(spark, checkpoint)


def drain_traffic(raw: DataFrame, target: Target, checkpoint: str, descriptor_set: bytes,
                  message: str, window_minutes: int = DEFAULT_WINDOW_MINUTES,
                  job_id: str | None = None, query_name: str = "packet-traffic",
                  engine: str = "arrow", delay: str | None = DEFAULT_DELAY,
                  timeout_s: float | None = None) -> None:
    """J1 over a bounded stream: read what is there, end, and flush all windows.

    As a bounded run of the reference does; a batch read (`run_traffic_job` on
    a batch frame) gives the same rows without a checkpoint to resume from.
    A run that is interrupted goes on where it was; one that has been flushed
    isn't repeated.
    """
    if is_closed(raw.sparkSession, checkpoint):
        return
    job_id = job_id or new_job_id()
    query = run_traffic_job(raw, target, checkpoint, descriptor_set, message, window_minutes,
                            job_id, "available-now", query_name, engine, delay)
    run_to_end(query, timeout_s)
    flush_traffic(raw.sparkSession, target, checkpoint, job_id)


# ------------------------------------------------------------------ J2

def node_info_plan(raw: DataFrame, descriptor_set: bytes, message: str,
                   zone: str | None = None, engine: str = "arrow") -> DataFrame:
    return node_info(decoded(raw, descriptor_set, message, ("node_info",), None,
                             engine=engine, only_variant="node_info"), zone)


def run_node_info_job(raw: DataFrame, checkpoint: str, descriptor_set: bytes, message: str,
                      sink_ddl: str | None, zone: str | None = None, trigger=DEFAULT_TRIGGER,
                      query_name: str = "node-info", engine: str = "arrow",
                      run_id: str | None = None) -> StreamingQuery | None:
    """J2 (job kind "node-info"): rows inserted with the user's sink DDL.

    Without DDL nothing runs, as in the reference. The DDL runs once, up
    front; each batch is exposed as view `NodeInfo` and inserted with
    `INSERT INTO node_info_sink SELECT * FROM NodeInfo`. A replayed batch, and
    a bounded run with the `run_id` of an earlier one, is skipped (commit
    markers next to the checkpoint); a crash between the insert and its marker
    repeats the rows. Where the user's table is partitioned by `run_id` and
    `batch_id`, each batch overwrites its own partition instead, and nothing
    can repeat.
    """
    rows = node_info_plan(raw, descriptor_set, message, zone, engine)
    if not create_sink(rows.sparkSession, sink_ddl):
        return None
    marks = CommitLog(f"{checkpoint}/sink-commits")
    run = run_id or (stream_run_id(rows.sparkSession, checkpoint) if rows.isStreaming else new_run_id())

    def each_batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        if keeps_batches(spark):
            overwrite_via_view(df, batch_id, run)
            return
        if marks.done(spark, batch_id, run):
            return
        insert_via_view(df)
        marks.mark(spark, batch_id, run)

    if not rows.isStreaming:
        each_batch(rows, 0)
        return None
    return start_stream(rows, checkpoint, query_name, each_batch=each_batch,
                        trigger=_trigger(trigger, None))


# ------------------------------------------------------------------ J3

def text_plan(raw: DataFrame, descriptor_set: bytes, message: str, charset: str = DEFAULT_CHARSET,
              zone: str | None = None, job_id: str | None = None,
              engine: str = "arrow", record_time: bool = False) -> DataFrame:
    packets = decoded(raw, descriptor_set, message, ("packet",), None, engine=engine,
                      only_variant="packet", only_port=TEXT_MESSAGE_PORT)
    return text_messages(packets, charset, zone, job_id, record_time)


def text_batch_writer(target: Target, checkpoint: str, sender: Sender | None = None,
                      audit_target: Target | None = None, webhook_tasks: int | None = None,
                      run_id: str = DEFAULT_RUN, ordered: bool = False):
    """One batch of text rows to the table, the audit table and the webhook.

    Each of the three is safe to repeat by itself: the tables know the batch,
    and the webhook's ledger knows each message. The batch's count and some of
    its audit lines are noted last (A2, `streaming.listener.audit_total`).
    `ordered` (K2) needs rows with their record time (`text_plan(record_time=True)`).
    """
    target = _with_log(target, f"{checkpoint}/table-commits")
    audit_target = _with_log(audit_target, f"{checkpoint}/audit-commits")
    sent, ledger = CommitLog(f"{checkpoint}/webhook-commits"), Ledger(f"{checkpoint}/webhook-ledger")

    def each_batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            target.write(text_bind_order(df), batch_id, run_id)
            if audit_target is not None:
                audit_target.write(audit_lines(df), batch_id, run_id)
            if sender is not None and not sent.done(df.sparkSession, batch_id, run_id):
                notes = notifications(df, ORDER_COLUMNS if ordered else ())
                n, failed = deliver_batch(notes, sender, webhook_tasks, ordered, ledger, batch_id, run_id)
                sent.mark(df.sparkSession, batch_id, run_id)
                ledger.forget(df.sparkSession, batch_id, run_id)
                if failed:
                    log.error("batch %d: %d of %d notifications failed", batch_id, failed, n)
            lines = [r.line for r in audit_lines(df.limit(AUDIT_SAMPLE)).collect()]
            record_total(df.sparkSession, checkpoint, batch_id, run_id, df.count(), lines)
        finally:
            df.unpersist()

    return each_batch


def run_text_job(raw: DataFrame, target: Target, checkpoint: str, descriptor_set: bytes,
                 message: str, charset: str = DEFAULT_CHARSET, zone: str | None = None,
                 job_id: str | None = None, sender: Sender | None = None,
                 audit_target: Target | None = None, trigger=DEFAULT_TRIGGER,
                 query_name: str = "text-app", engine: str = "arrow",
                 http_uri: str | None = None,
                 webhook_tasks: int | None = None,
                 run_id: str | None = None, ordered: bool = False) -> StreamingQuery | None:
    """J3 (job kind "text-app"): text rows to a table and a webhook.

    Run ids are those of `run_traffic_job`: a bounded run writes and notifies
    anew unless it names the `run_id` of an earlier one.

    `http_uri` (the reference's text.http.uri) builds the default HTTP sender;
    `sender` replaces it (tests use a fake). `webhook_tasks` spreads delivery.
    `ordered` sends the messages of one sender in the order of their record
    times (K2); a busy sender's messages then wait for each other in one task.

    A2: the number of text rows per batch is reported as observed metric
    `messages`, and a run's total is kept with the checkpoint; the audit lines
    themselves go to `audit_target` (a table), not into a list held by the driver.
    """
    if sender is None and http_uri:
        sender = HttpSender(http_uri)
    texts = text_plan(raw, descriptor_set, message, charset, zone, job_id, engine, ordered)
    run = run_id or (stream_run_id(raw.sparkSession, checkpoint) if texts.isStreaming else new_run_id())
    each_batch = text_batch_writer(target, checkpoint, sender, audit_target, webhook_tasks, run,
                                   ordered)
    if not texts.isStreaming:
        each_batch(texts, 0)
        return None
    texts = texts.observe("messages", F.count(F.lit(1)).alias("messages"))
    return start_stream(texts, checkpoint, query_name, each_batch=each_batch,
                        trigger=_trigger(trigger, target))


JOB_KINDS = {
    JOB_KIND_TRAFFIC: run_traffic_job,
    JOB_KIND_NODE_INFO: run_node_info_job,
    JOB_KIND_TEXT: run_text_job,
}
