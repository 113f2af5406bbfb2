"""Delivery that survives its tasks and drivers: ledger, bound statements, inserts, totals."""

import datetime as dt
import glob
import os
import pickle
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.plans.jobs import run_node_info_job, run_text_job, text_batch_writer
from packetflow.sinks.batch import CommitLog, TableTarget, traffic_bind_order
from packetflow.sinks.ledger import Ledger, not_sent
from packetflow.sinks.sql import keeps_batches
from packetflow.sinks.statements import StatementTarget
from packetflow.sinks.webhook import ORDER_COLUMNS, deliver_batch, send_notifications
from packetflow.streaming.listener import audit_total
from packetflow.streaming.runner import run_to_end
from packetflow.sources.files import parquet_packet_stream
from testbed import packets as X
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from tests.conftest import SF_SMALL

DESC = fixture_descriptor_set()
NOTES = "title string, message string, priority int"


def local(folder):
    return folder.removeprefix("file:")


class Recorder:
    """Writes each body down; kills its own process at the message that holds `fatal`."""

    def __init__(self, path, fatal=None, error=None):
        self.path, self.fatal, self.error = path, fatal, error

    def __call__(self, body):
        if self.fatal and self.fatal in body:
            if self.error:
                raise RuntimeError("the task fails")
            os._exit(1)
        with open(self.path, "a") as f:
            f.write(body.replace("\n", " ") + "\n")
        return 200


def sent_bodies(path):
    return Counter(open(path).read().splitlines()) if os.path.exists(path) else Counter()


def notes(spark, n=40, copies=3):
    rows = [(f"n{i:03d}", f"text {i}", 2) for i in range(n) for _ in range(copies if i % 4 == 0 else 1)]
    return spark.createDataFrame(rows, NOTES)


def bodies_of(df):
    from packetflow.operators.messages import notification_json
    return Counter(r.body.replace("\n", " ") for r in notification_json(df).collect())


@pytest.mark.parametrize("error", [True, False])
def test_what_was_recorded_is_sent_once(spark, folder, tmp_path, error):
    """One task dies half-way, by an error or with its process; the batch is sent again."""
    df, path = notes(spark).repartition(3, "title"), str(tmp_path / "sent")
    ledger = Ledger(f"{folder}/ledger", record_every=1)
    with pytest.raises(Exception):
        deliver_batch(df, Recorder(path, fatal="n020", error=error), ledger=ledger)
    first = sent_bodies(path)
    recorded = sum(len(open(f).read().splitlines())
                   for f in glob.glob(f"{local(folder)}/ledger/**/*.csv", recursive=True))
    assert 0 < recorded <= sum(first.values()) < sum(bodies_of(df).values())
    assert deliver_batch(df, Recorder(path), ledger=ledger) == (
        sum(bodies_of(df).values()) - recorded, 0)
    twice = sent_bodies(path) - bodies_of(df)
    assert not bodies_of(df) - sent_bodies(path)
    assert sum(twice.values()) == sum(first.values()) - recorded      # sent, but not yet recorded
    assert deliver_batch(df, Recorder(path), ledger=ledger) == (0, 0)


def test_records_are_kept_a_few_at_a_time_and_an_error_loses_none(spark, folder, tmp_path):
    df, path = notes(spark, 30, 1).coalesce(1).sortWithinPartitions("title"), str(tmp_path / "sent")
    ledger = Ledger(f"{folder}/ledger", record_every=7)
    with pytest.raises(Exception):
        deliver_batch(df, Recorder(path, fatal="n017", error=True), ledger=ledger)
    assert sum(sent_bodies(path).values()) == 17
    files = glob.glob(f"{local(folder)}/ledger/**/*.csv", recursive=True)
    assert sorted(len(open(f).readlines()) for f in files) == [3, 7, 7]
    assert deliver_batch(df, Recorder(path), ledger=ledger) == (13, 0)
    assert sent_bodies(path) == bodies_of(df)


def test_order_holds_in_a_replay(spark, folder, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(node, t0 + dt.timedelta(seconds=i), f"{node}:{i:02d}", "same", 2)
            for i in range(20) for node in (7, 8)]
    df = spark.createDataFrame(rows, f"from_node long, record_time timestamp, {NOTES}").repartition(4)
    path, ledger = str(tmp_path / "sent"), Ledger(f"{folder}/ledger", record_every=1)
    with pytest.raises(Exception):
        deliver_batch(df, Recorder(path, fatal="7:11", error=True), ordered=True, ledger=ledger)
    deliver_batch(df, Recorder(path), ordered=True, ledger=ledger)
    lines = [line for line in open(path)]
    for node in (7, 8):
        order = [line.split('"title" : "')[1][:4] for line in lines if f'"{node}:' in line]
        assert order == [f"{node}:{i:02d}" for i in range(20)]


def test_equal_messages_are_counted(spark):
    df = spark.createDataFrame([("a", "x")] * 1000 + [("b", "y")] * 2, "key string, body string")
    sent = spark.createDataFrame([("a", 200)] * 400 + [("b", 0)] * 5, "key string, status int")
    assert [(r.key, r.body, r["count"]) for r in
            not_sent(df, sent).groupBy("key", "body").count().collect()] == [("a", "x", 600)]
    assert not_sent(df, None) is df


def test_batch_writer_forgets_a_delivered_batch(spark, folder, tmp_path):
    texts = spark.createDataFrame(
        [(1, 2, dt.datetime(2024, 1, 1), 0, f"t{i}", "j") for i in range(9)], S.TEXT_MESSAGES).coalesce(1)
    path = str(tmp_path / "sent")
    write = text_batch_writer(TableTarget(f"{folder}/t"), folder, Recorder(path, "t5", True))
    with pytest.raises(Exception):
        write(texts, 4)
    write = text_batch_writer(TableTarget(f"{folder}/t"), folder, Recorder(path))
    write(texts, 4)
    assert set(sent_bodies(path).values()) == {1} and sum(sent_bodies(path).values()) == 9
    assert Ledger(f"{folder}/webhook-ledger").sent(spark, 4) is None
    write(texts, 4)
    assert sum(sent_bodies(path).values()) == 9
    assert TableTarget(f"{folder}/t").read(spark).count() == 9


# ------------------------------------------------------------- bound statements

class FakeConnection:
    """A database in a folder: each committed batch is a file; some batches fail."""

    def __init__(self, path, fail_on=None, times=1, lost=False):
        self.path, self.fail_on, self.times, self.lost = path, fail_on, times, lost
        self.open, self.pending = True, []

    def cursor(self):
        return self

    def executemany(self, sql, rows):
        assert self.open
        self.pending = [(sql, r) for r in rows]
        if self.fail_on is not None and any(self.fail_on in r for r in rows):
            tries = glob.glob(f"{self.path}/try-*")
            if len(tries) < self.times:
                open(f"{self.path}/try-{uuid.uuid4().hex}", "w").close()
                self.open = not self.lost
                raise OSError("deadlock")

    def commit(self):
        with open(f"{self.path}/batch-{uuid.uuid4().hex}", "wb") as f:
            pickle.dump(self.pending, f)

    def rollback(self):
        if not self.open:
            raise OSError("no connection")
        self.pending = []

    def close(self):
        pass


def batches(path):
    return [pickle.load(open(f, "rb")) for f in glob.glob(f"{path}/batch-*")]


SQL = "INSERT INTO t VALUES (?, ?)"


@pytest.mark.parametrize("lost", [False, True])
def test_only_the_failing_batch_is_repeated(spark, tmp_path, lost):
    path = str(tmp_path)
    target = StatementTarget(SQL, lambda: FakeConnection(path, 137, 3, lost), retry_pause_s=0.01,
                             max_connections=1)
    df = spark.createDataFrame([(i, f"v{i}") for i in range(250)], "k int, v string").coalesce(1)
    assert target.write(df, 0) == {"rows": 250, "batches": 3, "repeated": 3}
    done = batches(path)
    assert sorted(map(len, done)) == [50, 100, 100]
    assert sorted(r for b in done for _, r in b) == [(i, f"v{i}") for i in range(250)]
    assert {s for b in done for s, _ in b} == {SQL}


def test_a_batch_that_keeps_failing_fails_the_job(spark, tmp_path):
    path = str(tmp_path)
    target = StatementTarget(SQL, lambda: FakeConnection(path, 3, 99), retries=5, retry_pause_s=0.001,
                             max_connections=1)
    with pytest.raises(Exception, match="deadlock"):
        target.write(spark.createDataFrame([(i, "v") for i in range(5)], "k int, v string"), 0)
    assert len(glob.glob(f"{path}/try-*")) == 6 and not batches(path)


def test_bind_order_and_values(spark, tmp_path):
    path = str(tmp_path)
    t0 = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    row = {"job_id": "j", "kind": "", "window_end": t0, "window_start": t0, "packet_count": 4,
           "to_node": 4294967295, "from_node": None}
    df = spark.createDataFrame([row], S.TRAFFIC)
    StatementTarget("s", lambda: FakeConnection(path)).write(traffic_bind_order(df), 0)
    ((_, bound),), = batches(path)
    assert bound[:3] == (None, 4294967295, 4) and bound[5:] == ("", "j")
    assert bound[3].replace(tzinfo=dt.timezone.utc) == t0 and type(bound[1]) is int


def test_a_marked_batch_is_not_written_again(spark, folder, tmp_path):
    path = str(tmp_path)
    target = StatementTarget(SQL, lambda: FakeConnection(path)).with_commit_log(f"{folder}/marks")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert target.write(df, 7)["rows"] == 2
    assert target.write(df, 7)["rows"] == 0
    assert target.write(df, 7, "another run")["rows"] == 2
    assert target.write(df.limit(0), 8) == {"rows": 0, "batches": 0, "repeated": 0}
    assert sum(map(len, batches(path))) == 4


def test_text_job_through_bound_statements(spark, folder, tmp_path):
    path = str(tmp_path)
    raw = X.raw_packets(spark, SF_SMALL, "conversations")
    run_text_job(raw, StatementTarget("s", lambda: FakeConnection(path)), folder, DESC, ENVELOPE,
                 zone="UTC", job_id="j")
    want = X.conversation_packets(spark, SF_SMALL).where("packet.portnum = 'TEXT_MESSAGE_APP'").count()
    rows = [r for b in batches(path) for _, r in b]
    assert len(rows) == want and {len(r) for r in rows} == {6} and {r[5] for r in rows} == {"j"}


# ------------------------------------------------------- inserts into the user's table

def make_table(spark, folder, partitioned):
    columns = ("node_id BIGINT, user_id STRING, user_name STRING, user_long_name STRING, "
               "user_role STRING, last_heard TIMESTAMP_NTZ, hops_away INT, snr FLOAT")
    spark.sql("DROP TABLE IF EXISTS node_info_sink")
    more = ", run_id STRING, batch_id BIGINT" if partitioned else ""
    return (f"CREATE TABLE node_info_sink ({columns}{more}) USING parquet "
            + ("PARTITIONED BY (run_id, batch_id) " if partitioned else "") + f"LOCATION '{folder}/table'")


@pytest.mark.parametrize("partitioned", [True, False])
def test_a_crash_between_insert_and_marker(spark, folder, monkeypatch, partitioned):
    ddl = make_table(spark, folder, partitioned)
    raw = X.raw_packets(spark, SF_SMALL, "customer")
    args = (raw, f"{folder}/ck", DESC, ENVELOPE)
    n = raw.count()

    def lost(*_):
        raise RuntimeError("the driver is lost")

    try:
        with monkeypatch.context() as m:
            m.setattr(CommitLog, "mark", lost)
            if partitioned:
                run_node_info_job(*args, ddl, run_id="o'ne")       # needs no marker
            else:
                with pytest.raises(RuntimeError):
                    run_node_info_job(*args, ddl, run_id="o'ne")
        assert keeps_batches(spark) == partitioned
        run_node_info_job(*args, "SELECT 1", run_id="o'ne")
        assert spark.table("node_info_sink").count() == (n if partitioned else 2 * n)
        run_node_info_job(*args, "SELECT 1", run_id="two")
        assert spark.table("node_info_sink").count() == (2 * n if partitioned else 3 * n)
    finally:
        spark.sql("DROP TABLE IF EXISTS node_info_sink")


# ------------------------------------------------------------------ durable totals

def test_totals_outlive_the_driver(spark, folder):
    packets = X.raw_packets(spark, SF_SMALL, "conversations")
    target, audit = TableTarget(f"{folder}/t"), TableTarget(f"{folder}/audit")
    for part in range(3):
        packets.where(F.pmod(F.xxhash64("value"), F.lit(3)) == part).coalesce(1) \
            .write.mode("append").parquet(f"{folder}/in")
        query = run_text_job(parquet_packet_stream(spark, f"{folder}/in"), target, f"{folder}/ck",
                             DESC, ENVELOPE, zone="UTC", job_id="j", audit_target=audit,
                             trigger="available-now")
        run_to_end(query, 120)
        got = audit_total(spark, f"{folder}/ck")
        assert got["total"] == audit.read(spark).count() and got["batch"] == part
        lines = {r.line for r in audit.read(spark).collect()}
        assert 0 < len(got["lines"]) <= 20 and set(got["lines"]) <= lines


def test_a_replayed_batch_counts_once(spark, folder):
    texts = spark.createDataFrame(
        [(1, 2, dt.datetime(2024, 1, 1), 0, f"t{i} ąę", "j") for i in range(9)], S.TEXT_MESSAGES)
    write = text_batch_writer(TableTarget(f"{folder}/t"), folder, run_id="r")
    for batch_id, rows in ((0, texts), (1, texts.limit(4)), (1, texts.limit(4)), (2, texts.limit(0))):
        write(rows, batch_id)
    got = audit_total(spark, folder, "r")
    assert (got["batch"], got["count"], got["total"], got["lines"]) == (2, 0, 13, [])
    assert audit_total(spark, folder, "other") == {"batch": None, "count": 0, "total": 0, "lines": []}


def test_statuses_of_an_ordered_sender_without_a_ledger(spark):
    rows = [(1, dt.datetime(2024, 1, 1), "t", "m", 2)]
    df = spark.createDataFrame(rows, f"from_node long, record_time timestamp, {NOTES}")
    assert ORDER_COLUMNS == ("from_node", "record_time")
    got = send_notifications(df, lambda body: 204, ordered=True).collect()
    assert [r.status for r in got] == [204]
