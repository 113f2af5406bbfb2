"""J1 batch semantics and plan shape."""

import datetime as dt

from packetflow import schema as S
from packetflow.operators.traffic import packet_traffic
from packetflow.plans.jobs import traffic_plan
from testbed import packets as X
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from tests.conftest import SF_SMALL
from tests.test_decode import packet


def at(minute, second=0, micro=0):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute, seconds=second,
                                                        microseconds=micro)


def rows_at(*times):
    return [(t, "packet", packet(1, 2), None) for t in times]


def test_window_bounds_start_inclusive_end_exclusive(spark):
    df = spark.createDataFrame(rows_at(at(10), at(19, 59, 999000), at(20)), S.PACKETS)
    got = sorted((r.window_start, r.window_end, r.packet_count)
                 for r in packet_traffic(df, 10, "j").collect())
    assert got == [(at(10), at(20), 2), (at(20), at(30), 1)]


def test_counts_per_key_and_kind(spark):
    rows = [(at(1), "packet", packet(-1, 2, encrypted=True), None),
            (at(2), "packet", packet(-1, 2, encrypted=True), None),
            (at(3), "packet", packet(-1, 2), None),
            (at(4), "node_info", None, None)]
    got = sorted((r.from_node, r.to_node, r.kind, r.packet_count, r.job_id)
                 for r in packet_traffic(spark.createDataFrame(rows, S.PACKETS), 10, "j").collect())
    assert got == [(4294967295, 2, "", 1, "j"), (4294967295, 2, "ENCRYPTED", 2, "j")]


def test_job_id_default_is_32_hex(spark):
    df = spark.createDataFrame(rows_at(at(1)), S.PACKETS)
    jid = packet_traffic(df).first().job_id
    assert len(jid) == 32 and int(jid, 16) >= 0


def test_output_schema(spark):
    df = packet_traffic(X.events_packets(spark, SF_SMALL))
    assert [(f.name, f.dataType) for f in df.schema] == \
        [(f.name, f.dataType) for f in S.TRAFFIC]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_one_exchange_partial_aggregate_python_only_in_decode(spark):
    raw = X.raw_packets(spark, SF_SMALL)
    plan = plan_text(traffic_plan(raw, fixture_descriptor_set(), ENVELOPE))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
    # decode (the topic is encoded beforehand); nothing in Python after it
    assert plan.count("MapInArrow") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(packet_traffic(X.events_packets(spark, SF_SMALL, payload=False)))
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert schema == ("ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,"
                      "event_type:string>")
