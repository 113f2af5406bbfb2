"""Streaming J1: watermark, late data, emission once, replay, batch parity."""

from packetflow import schema as S
from packetflow.operators.traffic import packet_traffic
from packetflow.sinks.batch import TableTarget
from testbed import packets as X
from packetflow.streaming.runner import late_rows_dropped, run_to_end, start_stream
from packetflow.streaming.watermark import with_event_time
from tests.conftest import SF_SMALL
from tests.test_decode import packet
from tests.test_traffic import at


class Stream:
    """Packets arrive as files; each `push` runs the query to the end (available-now)."""

    def __init__(self, spark, folder, window_minutes=10):
        self.spark, self.folder, self.window = spark, folder, window_minutes
        self.progress = []
        self.dropped_per_run = []

    def push(self, rows):
        df = self.spark.createDataFrame(rows, S.PACKETS) if isinstance(rows, list) else rows
        df.coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(S.PACKETS).parquet(f"{self.folder}/in")
        traffic = packet_traffic(with_event_time(stream), self.window, "j")
        q = run_to_end(start_stream(traffic, f"{self.folder}/ck", "traffic_test",
                                    path=f"{self.folder}/out"), 600)
        self.progress.extend(q.recentProgress)
        self.dropped_per_run.append(late_rows_dropped(q))
        return self

    def windows(self):
        try:
            out = self.spark.read.schema(S.TRAFFIC).parquet(f"{self.folder}/out")
        except Exception:  # noqa: BLE001 - nothing emitted yet
            return []
        return sorted((r.window_start.strftime("%H:%M"), r.kind, r.packet_count)
                      for r in out.collect())

    def dropped(self):
        return sum(self.dropped_per_run)


def pkt(t, **kw):
    return (t, "packet", packet(1, 2, **kw), None)


def test_window_emitted_once_when_watermark_passes_end(spark, folder):
    s = Stream(spark, folder).push([pkt(at(1)), pkt(at(5))])
    assert s.windows() == []
    s.push([pkt(at(10, 4))])  # watermark 00:09:59 < end
    assert s.windows() == []
    s.push([pkt(at(10, 5))])  # watermark 00:10:00 = end
    assert s.windows() == [("00:00", "", 2)]


def test_late_under_bound_is_counted(spark, folder):
    s = Stream(spark, folder).push([pkt(at(9, 59)), pkt(at(10, 3))])
    s.push([pkt(at(9, 59, 500000))])  # behind max, not behind the watermark
    s.push([pkt(at(20, 30))])
    assert s.windows() == [("00:00", "", 2), ("00:10", "", 1)]
    assert s.dropped() == 0


def test_late_after_emission_is_dropped_and_counted(spark, folder):
    s = Stream(spark, folder).push([pkt(at(1))])
    s.push([pkt(at(15))])
    assert s.windows() == [("00:00", "", 1)]
    s.push([pkt(at(2))])
    s.push([pkt(at(30))])
    assert ("00:00", "", 1) in s.windows() and ("00:00", "", 2) not in s.windows()
    assert s.dropped() == 1


def test_filtered_out_packets_still_advance_the_watermark(spark, folder):
    s = Stream(spark, folder).push([pkt(at(1))])
    s.push([(at(15), "node_info", None, None)])
    assert s.windows() == [("00:00", "", 1)]


def test_multi_batch_stream_equals_batch_for_closed_windows(spark, folder):
    packets = X.events_packets(spark, SF_SMALL)
    bounds = list(packets.selectExpr(
        "percentile_approx(timestamp, array(0.33, 0.66))").first()[0])
    s = Stream(spark, folder)
    lo = None
    for hi in bounds + [None]:
        part = packets
        if lo is not None:
            part = part.where(part.timestamp >= lo)
        if hi is not None:
            part = part.where(part.timestamp < hi)
        s.push(part)
        lo = hi
    got = spark.read.parquet(f"{folder}/out")
    wm = packets.selectExpr("max(timestamp) - INTERVAL 5 SECONDS").first()[0]
    want = packet_traffic(packets, 10, "j").where(f"window_end <= '{wm}'")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_replayed_batch_id_does_not_duplicate(spark, folder):
    target = TableTarget(f"{folder}/t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    target.write(df, 7)
    target.write(df, 7)
    target.write(df.where("k = 1"), 8)
    assert target.read(spark).count() == 3


def test_ntz_event_time_is_read_as_timestamp_for_the_watermark(spark, folder):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 1), 1)], "ts timestamp_ntz, v int")
    df.write.parquet(f"{folder}/ntz")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/ntz")
    out = with_event_time(stream, column="ts")
    assert out.schema["ts"].dataType.simpleString() == "timestamp"
    assert "EventTimeWatermark" in out._jdf.queryExecution().logical().toString()
