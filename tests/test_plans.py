"""Physical-plan properties that matter at scale."""

import datetime as dt

from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.operators.traffic import packet_traffic
from packetflow.plans.jobs import node_info_plan, text_plan, traffic_plan
from testbed import packets as X
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from packetflow.sources.files import parquet_packets
from tests.conftest import SF_SMALL
from tests.test_traffic import plan_text

DESC = fixture_descriptor_set()


def staged(spark, folder):
    path = f"{folder}/raw"
    X.raw_packets(spark, SF_SMALL).write.parquet(path)
    return path


def test_node_info_and_text_jobs_do_not_shuffle(spark, folder):
    raw = parquet_packets(spark, staged(spark, folder))
    for plan in (plan_text(node_info_plan(raw, DESC, ENVELOPE)),
                 plan_text(text_plan(raw, DESC, ENVELOPE))):
        assert "Exchange" not in plan
        assert plan.count("MapInArrow") == 1


def test_replay_bounds_reach_the_scan(spark, folder):
    raw = parquet_packets(spark, staged(spark, folder), start="2024-01-02T00:00:00+00:00",
                          end="2024-01-03T00:00:00+00:00")
    plan = plan_text(traffic_plan(raw, DESC, ENVELOPE))
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThan(timestamp" in pushed
    read = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert read == "ReadSchema: struct<value:binary,timestamp:timestamp>"


def test_hot_key_is_pre_aggregated_and_counted_whole(spark):
    # A third of all packets share one (from, to, kind) key in one window.
    t0 = dt.datetime(2024, 1, 1)
    base = spark.range(30000).select(
        (F.lit(t0).cast("timestamp") + F.make_dt_interval(secs=F.col("id") % 600))
        .alias("timestamp"),
        F.lit("packet").alias("variant"),
        F.struct(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") % 97).cast("int"))
                 .alias("from"),
                 F.lit(1).alias("to"), F.lit(0).alias("channel"), F.lit(0).alias("rx_time"),
                 F.lit(False).alias("encrypted"), F.lit(False).alias("decoded"),
                 F.lit("UNKNOWN_APP").alias("portnum"), F.lit(b"").cast("binary").alias("payload"))
        .alias("packet"),
        F.lit(None).cast(S.NODE_INFO_MSG).alias("node_info")).repartition(8)
    traffic = packet_traffic(base, 10, "j")
    plan = plan_text(traffic)
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")  # below it
    hot = traffic.where("from_node = 7").select("packet_count").collect()
    want = sum(1 for i in range(30000) if i % 3 == 0 or i % 97 == 7)
    assert [r[0] for r in hot] == [want]
    assert traffic.agg(F.sum("packet_count")).first()[0] == 30000
