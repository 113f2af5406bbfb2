"""J1-J3 end to end from raw bytes: batch (bounded replay) and streaming."""

import json

import pytest

from packetflow.plans.jobs import (JOB_KINDS, node_info_plan, run_node_info_job, run_text_job,
                                   run_traffic_job)
from packetflow.sinks.batch import TableTarget
from packetflow.sinks.sql import console_changelog
from testbed import packets as X
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from testbed.encode import encode_packets
from packetflow.sources.files import parquet_packet_stream, parquet_packets
from packetflow.streaming.runner import observed, run_to_end
from tests.conftest import SF_SMALL
from tests.test_messages_and_sinks import FakeSender

DESC = fixture_descriptor_set()


@pytest.fixture(scope="module")
def topic(spark):
    """Raw packets of all three sources, as parquet files (a topic dump)."""
    from packetflow.session import run_folder

    path = f"{run_folder(spark, 'topic')}/packets"
    X.raw_packets(spark, SF_SMALL).repartition(3).write.parquet(path)
    return path


def test_null_value_fails_when_read(spark, folder):
    from packetflow import schema as S

    spark.createDataFrame([(None, None)], S.PACKETS_RAW).write.parquet(f"{folder}/bad")
    with pytest.raises(Exception, match="null value"):
        parquet_packets(spark, f"{folder}/bad").collect()


def test_copy_to_shared_moves_the_file(spark, tmp_path):
    import os

    from packetflow.session import checkpoint_root, copy_to_shared

    src = tmp_path / "x.zip"
    src.write_bytes(b"zip")
    dst = copy_to_shared(spark, str(src), "pyfiles/test/x.zip")
    assert dst.startswith(checkpoint_root(spark)) and not src.exists()
    assert open(dst.replace("file:", ""), "rb").read() == b"zip" and os.path.getsize(dst) == 3


def test_job_kinds():
    assert set(JOB_KINDS) == {"default", "node-info", "text-app"}


def test_unbounded_job_keeps_running_on_a_200ms_trigger(spark, folder, topic):
    q = run_traffic_job(parquet_packet_stream(spark, topic), TableTarget(f"{folder}/t"),
                        f"{folder}/ck", DESC, ENVELOPE, query_name="running_test")
    try:
        q.processAllAvailable()
        assert q.isActive and q.lastProgress is not None
    finally:
        q.stop()
    assert TableTarget(f"{folder}/t").read(spark).count() > 0


def test_bounded_replay_traffic_flushes_every_window(spark, folder, topic):
    raw = parquet_packets(spark, topic, start="2024-01-02T00:00:00Z", end="2024-01-03T00:00:00Z")
    target = TableTarget(f"{folder}/traffic")
    assert run_traffic_job(raw, target, f"{folder}/ck", DESC, ENVELOPE, 60, "j") is None
    got = target.read(spark)
    assert got.count() > 0
    bounds = got.selectExpr("min(window_start)", "max(window_end)").first()
    assert str(bounds[0]) == "2024-01-02 00:00:00" and str(bounds[1]) == "2024-01-03 00:00:00"


def test_text_stream_reports_messages_and_notifies(spark, folder, topic, tmp_path):
    sent = tmp_path / "sent.jsonl"
    target = TableTarget(f"{folder}/text")
    q = run_text_job(parquet_packet_stream(spark, topic, max_files_per_trigger=1), target,
                     f"{folder}/ck", DESC, ENVELOPE, zone="UTC", job_id="j",
                     sender=FakeSender(str(sent)), trigger="available-now",
                     query_name="text_test")
    run_to_end(q, 600)
    rows = target.read(spark).count()
    want = X.conversation_packets(spark, SF_SMALL).where("packet.portnum = 'TEXT_MESSAGE_APP'")
    want = want.count() + X.events_packets(spark, SF_SMALL).where(
        "packet.portnum = 'TEXT_MESSAGE_APP'").count()
    assert rows == want > 0
    assert sum(m["messages"] for m in observed(q, "messages")) == rows
    bodies = [json.loads(json.loads(line)) for line in sent.read_text().splitlines()]
    assert len(bodies) == rows and all(b["priority"] == 2 for b in bodies)


def test_listener_keeps_a_job_level_message_total(spark, folder, topic):
    import time

    from packetflow.streaming.listener import ObservedTotals

    totals = ObservedTotals()
    spark.streams.addListener(totals)
    try:
        target = TableTarget(f"{folder}/text")
        q = run_text_job(parquet_packet_stream(spark, topic, max_files_per_trigger=1), target,
                         f"{folder}/ck", DESC, ENVELOPE, zone="UTC", job_id="j",
                         trigger="available-now", query_name="text_listener_test")
        run_to_end(q, 600)
        rows = target.read(spark).count()
        deadline = time.time() + 30  # listener events arrive asynchronously
        while totals.total(q.id, "messages.messages") < rows and time.time() < deadline:
            time.sleep(0.2)
        assert totals.total(q.id, "messages.messages") == rows > 0
    finally:
        spark.streams.removeListener(totals)


def test_node_info_job_without_ddl_runs_nothing(spark, folder, topic):
    stream = parquet_packet_stream(spark, topic)
    assert run_node_info_job(stream, f"{folder}/ck", DESC, ENVELOPE, None) is None
    assert not spark.streams.active


def test_node_info_batch_and_console_changelog(spark, folder, topic, capfd):
    rows = node_info_plan(parquet_packets(spark, topic), DESC, ENVELOPE, zone="UTC")
    assert rows.count() == (X.customer_packets(spark, SF_SMALL).count()
                            + X.events_packets(spark, SF_SMALL).where("variant = 'node_info'").count())
    stream = node_info_plan(parquet_packet_stream(spark, topic), DESC, ENVELOPE, zone="UTC")
    run_to_end(console_changelog(stream, f"{folder}/ck", "changelog_test", "available-now"), 600)


def test_traffic_stream_matches_batch_on_closed_windows(spark, folder):
    packets = X.events_packets(spark, SF_SMALL)
    encode_packets(packets, DESC, ENVELOPE).write.parquet(f"{folder}/in")
    target = TableTarget(f"{folder}/out")
    q = run_traffic_job(parquet_packet_stream(spark, f"{folder}/in"), target, f"{folder}/ck",
                        DESC, ENVELOPE, 10, "j", trigger="available-now",
                        query_name="traffic_job_test")
    run_to_end(q, 600)
    batch = TableTarget(f"{folder}/batch")
    run_traffic_job(parquet_packets(spark, f"{folder}/in"), batch, f"{folder}/ck2", DESC,
                    ENVELOPE, 10, "j")
    wm = packets.selectExpr("max(timestamp) - INTERVAL 5 SECONDS").first()[0]
    want = batch.read(spark).where(f"window_end <= '{wm}'")
    got = target.read(spark)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_crash_after_sink_write_is_replayed_without_duplicates(spark, folder, topic, tmp_path):
    """The batch is written, then the driver dies before Spark commits it; on
    restart Spark replays the same batch id: no duplicate rows, no re-sent
    notifications."""
    import os

    from packetflow.plans.jobs import text_batch_writer, text_plan
    from packetflow.streaming.runner import start_stream

    sent = tmp_path / "sent.jsonl"
    crashed = tmp_path / "crashed"
    target = TableTarget(f"{folder}/text")
    write = text_batch_writer(target, f"{folder}/ck", FakeSender(str(sent)))

    def crash_once_after_writing(df, batch_id):
        write(df, batch_id)
        if not crashed.exists():
            crashed.touch()
            raise RuntimeError("driver lost after the sink write")

    def run():
        texts = text_plan(parquet_packet_stream(spark, topic), DESC, ENVELOPE, zone="UTC",
                          job_id="j")
        return run_to_end(start_stream(texts, f"{folder}/ck", "crash_test",
                                       each_batch=crash_once_after_writing), 600)

    with pytest.raises(Exception, match="driver lost"):
        run()
    assert os.path.exists(crashed)
    run()  # resumes from the checkpoint and replays the uncommitted batch
    want = text_plan(parquet_packets(spark, topic), DESC, ENVELOPE, zone="UTC", job_id="j")
    got = target.read(spark)
    assert got.count() == want.count() > 0
    assert len(sent.read_text().splitlines()) == want.count()


def test_replay_bounds_each_alone_and_on_a_stream(spark, folder, topic):
    import datetime as dt

    from pyspark.sql import functions as F

    from packetflow.sources.files import replay_range

    all_rows = parquet_packets(spark, topic)
    n = all_rows.count()
    cut = "2024-01-15T00:00:00+00:00"
    before = replay_range(all_rows, end=cut).count()
    after = replay_range(all_rows, start=cut).count()
    assert before + after == n and before > 0 and after > 0
    stream = parquet_packet_stream(spark, topic, start=cut)
    q = run_to_end(stream.writeStream.format("parquet").option("path", f"{folder}/s")
                   .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True)
                   .start(), 600)
    got = spark.read.parquet(f"{folder}/s")
    assert got.count() == after
    assert got.agg(F.min("timestamp")).first()[0] >= dt.datetime(2024, 1, 15)
    assert q.exception() is None
