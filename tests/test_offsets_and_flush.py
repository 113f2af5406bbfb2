"""Replays bounded by offsets (S3/S4) and the flush of drained streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.plans.jobs import drain_traffic, flush_traffic, run_traffic_job, traffic_plan
from packetflow.session import CLUSTER_CONF
from packetflow.sinks.batch import TableTarget
from packetflow.sources.files import parquet_packet_stream, parquet_packets, replay_offsets, \
    replay_range
from packetflow.streaming.flush import open_traffic
from packetflow.streaming.runner import run_to_end
from testbed import packets as X
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DESC = fixture_descriptor_set()


def at(minute):
    return T0 + dt.timedelta(minutes=minute)


def iso(minute):
    return at(minute).isoformat()


def log_frame(spark, rows):
    """(partition, offset, minute) rows, each with its own value."""
    return spark.createDataFrame(
        [(bytearray(f"{p}-{o}".encode()), at(m), p, o) for p, o, m in rows], S.PACKETS_LOG)


def values(df):
    return sorted(bytes(r.value).decode() for r in df.collect())


# Partition 0 has a late record (minute 2 at offset 12) and an early one (minute 30 at offset 11).
LOG = [(0, 10, 5), (0, 11, 30), (0, 12, 2), (0, 13, 12), (0, 14, 31),
       (1, 0, 1), (1, 1, 3),                       # ends before the start
       (2, 7, 20), (2, 9, 21)]                     # never reaches the end; offset 8 is missing


def plain_replay(rows, start, end):
    out = []
    for part in {p for p, _, _ in rows}:
        mine = sorted((o, m) for p, o, m in rows if p == part)
        first = [o for o, m in mine if start is None or m >= start]
        stop = [o for o, m in mine if end is not None and m >= end]
        out += [f"{part}-{o}" for o, _ in mine
                if first and o >= first[0] and not (stop and o >= stop[0])]
    return sorted(out)


@pytest.mark.parametrize("start, end", [(10, 30), (4, 12), (None, 21), (2, None), (None, None),
                                        (40, None), (None, 0), (30, 10)])
def test_offset_bounds(spark, start, end):
    got = replay_offsets(log_frame(spark, LOG), start and iso(start), iso(end) if end is not None else None)
    assert values(got) == plain_replay(LOG, start or None, end)


def test_offsets_differ_from_times_where_records_are_late(spark):
    df = log_frame(spark, LOG)
    by_offset = values(replay_offsets(df, iso(10), iso(31)))
    by_time = values(replay_range(df, iso(10), iso(31)))
    assert set(by_offset) - set(by_time) == {"0-12"}      # late, but within the offsets
    assert values(replay_offsets(df, iso(10), iso(30))) == ["2-7", "2-9"]   # offset 11 ends it at once


def test_offsets_need_their_columns(spark):
    with pytest.raises(ValueError):
        replay_offsets(spark.createDataFrame([], S.PACKETS_RAW), iso(1))


def test_files_and_streams_by_offset(spark, folder):
    log_frame(spark, LOG).write.parquet(f"{folder}/log")
    want = plain_replay(LOG, 4, 31)
    assert values(parquet_packets(spark, f"{folder}/log", iso(4), iso(31), by_offset=True)) == want
    stream = parquet_packet_stream(spark, f"{folder}/log", iso(4), end=iso(31), by_offset=True)
    query = (stream.writeStream.format("parquet").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start())
    run_to_end(query, 120)
    assert values(spark.read.parquet(f"{folder}/out")) == want


def test_hot_partition_is_not_shuffled(spark):
    plan = replay_offsets(log_frame(spark, LOG), iso(4))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


# ------------------------------------------------------------------ flush

def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def batch_traffic(spark, job_id):
    return rows_of(traffic_plan(X.raw_packets(spark, SF_SMALL, "events"), DESC, ENVELOPE, 10, job_id))


def stream(spark):
    return parquet_packet_stream(spark, X.topic(spark, SF_SMALL, "events"))


def test_flush_adds_the_open_windows_once(spark, folder):
    target, ck = TableTarget(f"{folder}/t"), f"{folder}/ck"
    run_to_end(run_traffic_job(stream(spark), target, ck, DESC, ENVELOPE, job_id="j",
                               trigger="available-now"), 120)
    closed = rows_of(target.read(spark))
    still = rows_of(open_traffic(spark, ck, "j"))
    assert still and not set(still) & set(closed)
    assert sorted(closed + still) == batch_traffic(spark, "j")
    for _ in range(3):
        flush_traffic(spark, target, ck, "j")
        assert rows_of(target.read(spark)) == batch_traffic(spark, "j")
    with pytest.raises(RuntimeError):
        run_traffic_job(stream(spark), target, ck, DESC, ENVELOPE, job_id="j")


def test_drain_can_be_interrupted_and_repeated(spark, folder):
    target, ck = TableTarget(f"{folder}/t"), f"{folder}/ck"
    # Drained, but lost before the flush.
    run_to_end(run_traffic_job(stream(spark), target, ck, DESC, ENVELOPE, job_id="j",
                               trigger="available-now"), 120)
    for _ in range(2):
        drain_traffic(stream(spark), target, ck, DESC, ENVELOPE, job_id="j", timeout_s=120)
    assert rows_of(target.read(spark)) == batch_traffic(spark, "j")


def test_flush_of_an_empty_stream(spark, folder):
    spark.createDataFrame([], S.PACKETS_RAW).write.parquet(f"{folder}/none")
    target = TableTarget(f"{folder}/t")
    drain_traffic(parquet_packet_stream(spark, f"{folder}/none"), target, f"{folder}/ck", DESC,
                  ENVELOPE, job_id="j", timeout_s=120)


def test_rocksdb_with_changelogs_survives_restarts_and_is_flushed(spark, folder):
    """The cluster settings for state: a stream restarted for each slice, then flushed."""
    keys = [k for k in CLUSTER_CONF if "stateStore" in k]
    assert len(keys) == 2
    before = {k: spark.conf.get(k, None) for k in keys}
    packets = X.raw_packets(spark, SF_SMALL, "events")
    target, ck = TableTarget(f"{folder}/t"), f"{folder}/ck"
    try:
        for k in keys:
            spark.conf.set(k, CLUSTER_CONF[k])
        for lo, hi in (("2024-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"),
                       ("2024-01-20", "2025-01-01")):
            packets.where((F.col("timestamp") >= lo) & (F.col("timestamp") < hi)) \
                .coalesce(1).write.mode("append").parquet(f"{folder}/in")
            run_to_end(run_traffic_job(parquet_packet_stream(spark, f"{folder}/in"), target, ck, DESC,
                                       ENVELOPE, job_id="j", trigger="available-now"), 120)
        stores = {r.operatorName for r in spark.read.format("state-metadata").load(ck).collect()}
        assert stores == {"stateStoreSave"}
        flush_traffic(spark, target, ck, "j")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows_of(target.read(spark)) == batch_traffic(spark, "j")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{ck}/state/0/0")
    names = [s.getPath().getName() for s in path.getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    assert any(".changelog" in n for n in names)
