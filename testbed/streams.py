"""Registered streaming queries: each runs a real Structured Streaming job.

A file-source stream reads a topic of the test tables (`packets.topic`,
available-now trigger), runs the job and writes its sink into a run folder
inside the shared checkpoint folder; the query returns the sink's contents as a
batch DataFrame.

All input files are read in one micro-batch, so the result does not depend
on file listing order: the watermark then stands at max(event time) - 5 s,
and exactly the windows that end at or before it are emitted. Multi-batch,
late-data and replay cases are covered by tests/test_streaming.py.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow.plans.jobs import drain_traffic, flush_traffic, run_node_info_job, run_text_job, \
    run_traffic_job, traffic_plan
from packetflow.session import run_folder
from packetflow.sinks.batch import TableTarget
from testbed import packets as X
from testbed.packets import BASE_EPOCH
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from testbed.encode import encode_packets
from packetflow.sources.files import parquet_packet_stream, parquet_packets
from packetflow.streaming.runner import run_to_end, start_stream

# Parameters of the registered streams (our choice).
STREAM_TIMEOUT_S = 1800
AVAILABLE_NOW = "available-now"
WEEK_S = 7 * 86400
NODE_INFO_COLUMNS = ("node_id BIGINT, user_id STRING, user_name STRING, "
                     "user_long_name STRING, user_role STRING, last_heard TIMESTAMP_NTZ, "
                     "hops_away INT, snr FLOAT")


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_packet_stream(spark, X.topic(spark, sf_dir, name))


def stream_traffic(spark: SparkSession, sf_dir: str, job_id: str,
                   window_minutes: int = 10) -> DataFrame:
    """W1-W6 + J1 on a stream, into the exactly-once parquet file sink."""
    folder = run_folder(spark, "stream_traffic")
    raw = _stream(spark, sf_dir, "events")
    traffic = traffic_plan(raw, fixture_descriptor_set(), ENVELOPE, window_minutes, job_id)
    run_to_end(start_stream(traffic, f"{folder}/checkpoint", "stream_traffic",
                            path=f"{folder}/out"), STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{folder}/out")


def _run_in_slices(spark: SparkSession, folder: str, packets: DataFrame, slice_col: Column,
                   job_id: str, window_minutes: int, name: str) -> DataFrame:
    """Stream `packets` one slice at a time, restarting the query from its checkpoint.

    Packets are staged once, partitioned by slice; before each run one slice
    is encoded into the stream's input folder (a partition-pruned read, no
    rescan of the source), and the run drains it (available-now).
    """
    packets.withColumn("slice", slice_col.cast("int")).write.partitionBy("slice") \
        .parquet(f"{folder}/staged")
    slices = sorted(r[0] for r in spark.read.parquet(f"{folder}/staged")
                    .select("slice").distinct().collect())
    for k in slices:
        part = spark.read.parquet(f"{folder}/staged").where(F.col("slice") == k).drop("slice")
        encode_packets(part, fixture_descriptor_set(), ENVELOPE) \
            .write.parquet(f"{folder}/input/{k:06d}")
        stream = parquet_packet_stream(spark, f"{folder}/input/*")
        traffic = traffic_plan(stream, fixture_descriptor_set(), ENVELOPE, window_minutes, job_id)
        run_to_end(start_stream(traffic, f"{folder}/checkpoint", name, path=f"{folder}/out"),
                   STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{folder}/out")


def _week() -> Column:
    return F.floor((F.unix_seconds("timestamp") - F.lit(BASE_EPOCH)) / F.lit(WEEK_S))


def stream_traffic_restarts(spark: SparkSession, sf_dir: str, job_id: str,
                           window_minutes: int = 10) -> DataFrame:
    """J1 on a stream that is stopped and restarted once per week of input.

    Each restart resumes from the checkpoint (offsets, window state and the
    watermark), as after losing the driver. Weeks are disjoint and in order,
    so no row arrives late and the result equals the one-batch run.
    """
    folder = run_folder(spark, "stream_traffic_restarts")
    return _run_in_slices(spark, folder, X.events_packets(spark, sf_dir), _week(), job_id,
                          window_minutes, "stream_traffic_restarts")


def stream_traffic_late(spark: SparkSession, sf_dir: str, job_id: str,
                        window_minutes: int = 10) -> DataFrame:
    """W4 at table scale: late packets are dropped once their window closed.

    Delivery is week by week as in `stream_traffic_restarts`, except that
    packets with neither payload nor encryption (kind "") arrive with the next
    week. Spark drops a late row whose window ended at or before the previous
    batch's watermark (max event time so far - 5 s) and counts it in
    `numRowsDroppedByWatermark`; a late row whose window is still open counts.
    """
    folder = run_folder(spark, "stream_traffic_late")
    packets = X.events_packets(spark, sf_dir)
    p = F.col("packet")
    late = (F.col("variant") == "packet") & ~p["encrypted"] & ~p["decoded"]
    return _run_in_slices(spark, folder, packets, F.when(late, _week() + 1).otherwise(_week()),
                          job_id, window_minutes, "stream_traffic_late")


def traffic_sink(spark: SparkSession, sf_dir: str, job_id: str) -> DataFrame:
    """J1 + N1/N3: traffic rows through the idempotent foreachBatch writer."""
    folder = run_folder(spark, "traffic_sink")
    raw = _stream(spark, sf_dir, "events")
    target = TableTarget(f"{folder}/traffic")
    query = run_traffic_job(raw, target, f"{folder}/checkpoint", fixture_descriptor_set(),
                            ENVELOPE, job_id=job_id, trigger=AVAILABLE_NOW,
                            query_name="traffic_sink")
    run_to_end(query, STREAM_TIMEOUT_S)
    return target.read(spark)


# Both halves start at a window's edge, so no window is cut in two.
TRAFFIC_SPLIT = "2024-01-12T00:00:00Z"
TEXT_SPLIT = "2024-01-01T00:40:00Z"


def _replay_halves(spark: SparkSession, sf_dir: str, name: str, split: str):
    """Two disjoint bounded replays of one topic."""
    yield parquet_packets(spark, X.topic(spark, sf_dir, name), end=split)
    yield parquet_packets(spark, X.topic(spark, sf_dir, name), start=split)


def stream_traffic_flushed(spark: SparkSession, sf_dir: str, job_id: str) -> DataFrame:
    """J1 + W5/W6: a bounded stream whose last windows are flushed when it has ended, twice."""
    folder = run_folder(spark, "stream_traffic_flushed")
    target = TableTarget(f"{folder}/traffic")
    drain_traffic(_stream(spark, sf_dir, "events"), target, f"{folder}/checkpoint",
                  fixture_descriptor_set(), ENVELOPE, job_id=job_id, timeout_s=STREAM_TIMEOUT_S)
    flush_traffic(spark, target, f"{folder}/checkpoint", job_id)
    return target.read(spark)


def traffic_replay_twice(spark: SparkSession, sf_dir: str, job_id: str) -> DataFrame:
    """J1 + N1 + W6: a second bounded replay adds to the first one's output."""
    folder = run_folder(spark, "traffic_replay_twice")
    target = TableTarget(f"{folder}/traffic")
    for raw in _replay_halves(spark, sf_dir, "events", TRAFFIC_SPLIT):
        run_traffic_job(raw, target, f"{folder}/checkpoint", fixture_descriptor_set(), ENVELOPE,
                        job_id=job_id)
    return target.read(spark)


def text_replay_twice(spark: SparkSession, sf_dir: str, job_id: str) -> DataFrame:
    """J3 + N2 + N6: as `traffic_replay_twice`, and the first half is replayed again by its run id."""
    folder = run_folder(spark, "text_replay_twice")
    target = TableTarget(f"{folder}/text")
    first, second = _replay_halves(spark, sf_dir, "conversations", TEXT_SPLIT)
    for raw, run in ((first, "first"), (second, None), (first, "first")):
        run_text_job(raw, target, f"{folder}/checkpoint", fixture_descriptor_set(), ENVELOPE,
                     zone="UTC", job_id=job_id, run_id=run)
    return target.read(spark)


def node_info_sink(spark: SparkSession, sf_dir: str, by_batch: bool = False) -> DataFrame:
    """J2 + Q1-Q4: user DDL creates the sink table; each batch is inserted by SQL.

    `by_batch`: the table keeps run and batch, and the topic is inserted three
    times as bounded runs, the last time by the run id of the second.
    """
    folder = run_folder(spark, "node_info_sink")
    raw = _stream(spark, sf_dir, "customer")
    # The sink table's name is a fixed value; in a database of this run's own it meets no other.
    database, before = f"packetflow_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
    spark.catalog.setCurrentDatabase(database)
    columns = NODE_INFO_COLUMNS + (", run_id STRING, batch_id BIGINT" if by_batch else "")
    partitions = "PARTITIONED BY (run_id, batch_id) " if by_batch else ""
    ddl = (f"CREATE TABLE node_info_sink ({columns}) USING parquet {partitions}"
           f"LOCATION '{folder}/table'")
    try:
        job = (f"{folder}/checkpoint", fixture_descriptor_set(), ENVELOPE)
        if by_batch:
            packets = X.raw_packets(spark, sf_dir, "customer")
            for k, run in enumerate(("first", "second", "second")):
                run_node_info_job(packets, *job, ddl if k == 0 else "SELECT 1", zone="UTC", run_id=run)
        else:
            query = run_node_info_job(raw, *job, ddl, zone="UTC", trigger=AVAILABLE_NOW,
                                      query_name="node_info_sink")
            run_to_end(query, STREAM_TIMEOUT_S)
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {database} CASCADE")        # the table's files are elsewhere and stay
    return spark.read.parquet(f"{folder}/table").drop("batch_id")


def _text_tables(spark: SparkSession, sf_dir: str, job_id: str, name: str,
                 zone: str = "UTC") -> tuple:
    folder = run_folder(spark, name)
    raw = _stream(spark, sf_dir, "conversations")
    target, audit = TableTarget(f"{folder}/text"), TableTarget(f"{folder}/audit")
    query = run_text_job(raw, target, f"{folder}/checkpoint", fixture_descriptor_set(), ENVELOPE,
                         zone=zone, job_id=job_id, audit_target=audit,
                         trigger=AVAILABLE_NOW, query_name=name)
    run_to_end(query, STREAM_TIMEOUT_S)
    return target.read(spark), audit.read(spark)


def text_sink(spark: SparkSession, sf_dir: str, job_id: str) -> DataFrame:
    """J3 + N2/N6: the table of text rows (time stored as UTC)."""
    return _text_tables(spark, sf_dir, job_id, "text_sink")[0]


def text_sink_zoned(spark: SparkSession, sf_dir: str, job_id: str, zone: str) -> DataFrame:
    """Local times of a zone with an offset, stored as if they were UTC."""
    return _text_tables(spark, sf_dir, job_id, "text_sink_zoned", zone)[0]


def audit_sink(spark: SparkSession, sf_dir: str, job_id: str) -> DataFrame:
    """J3 + A2/P7: the table of audit lines."""
    return _text_tables(spark, sf_dir, job_id, "audit_sink")[1]
