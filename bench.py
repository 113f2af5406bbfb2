"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (not timed): raw protobuf packets derived from events, customer and
conversations are encoded once and written as a parquet "topic" with
BENCH_CPUS files, the way a Kafka topic has partitions; a second topic holds
BENCH_COPIES copies of it (shifted by whole days) to measure throughput
rather than per-job overhead. The `*_raw` queries
then run the reference's three jobs from those bytes; the others run the
same pipelines from the decoded columns, and the registered queries that
derive and encode their input on the fly.

Each query runs once to warm up, then BENCH_RUNS times (default 3); the
median is reported. A query is forced with a `noop` write, so every row is
computed and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from testbed import queries as Q  # noqa: E402
from packetflow.operators.decode import decode_packets  # noqa: E402
from packetflow.plans.jobs import node_info_plan, text_plan, traffic_plan  # noqa: E402
from packetflow.session import local_session, run_folder  # noqa: E402
from testbed import packets as X  # noqa: E402
from testbed.descriptors import ENVELOPE, fixture_descriptor_set  # noqa: E402
from packetflow.sources.files import parquet_packet_stream, parquet_packets  # noqa: E402
from packetflow.streaming.runner import run_to_end, start_stream  # noqa: E402

DESC = fixture_descriptor_set()
TOPIC = {}


def stage_topic(spark, sf_dir: str, files: int, copies: int) -> None:
    path = f"{run_folder(spark, 'bench-topic')}/packets"
    X.raw_packets(spark, sf_dir).repartition(files).write.parquet(path)
    TOPIC["path"] = path
    # A larger topic for throughput: the same packets, shifted by whole days.
    one = spark.read.parquet(path)
    big = one
    for k in range(1, copies):
        big = big.unionByName(one.withColumn("timestamp", F.col("timestamp")
                                             + F.make_dt_interval(days=F.lit(31 * k))))
    big_path = f"{run_folder(spark, 'bench-topic-big')}/packets"
    big.write.parquet(big_path)
    TOPIC["big"] = big_path


def traffic_raw_big(spark, sf_dir):
    raw = parquet_packets(spark, TOPIC["big"])
    return traffic_plan(raw, DESC, ENVELOPE, 10, Q.job_id("traffic_raw_big"))


def decode_raw_big(spark, sf_dir):
    return decode_packets(parquet_packets(spark, TOPIC["big"]), DESC, ENVELOPE)


def _raw(spark):
    return parquet_packets(spark, TOPIC["path"])


def decode_raw(spark, sf_dir):
    return decode_packets(_raw(spark), DESC, ENVELOPE)


def traffic_raw(spark, sf_dir):
    return traffic_plan(_raw(spark), DESC, ENVELOPE, 10, Q.job_id("traffic_raw"))


def node_info_raw(spark, sf_dir):
    return node_info_plan(_raw(spark), DESC, ENVELOPE, zone="UTC")


def text_raw(spark, sf_dir):
    return text_plan(_raw(spark), DESC, ENVELOPE, zone="UTC", job_id=Q.job_id("text_raw"))


def stream_traffic_raw(spark, sf_dir):
    """J1 as a stream over the topic folder, available-now, into a parquet sink."""
    folder = run_folder(spark, "bench-stream")
    traffic = traffic_plan(parquet_packet_stream(spark, TOPIC["path"]), DESC, ENVELOPE, 10,
                           Q.job_id("stream_traffic_raw"))
    run_to_end(start_stream(traffic, f"{folder}/ck", "bench_stream", path=f"{folder}/out"), 1800)
    return spark.read.parquet(f"{folder}/out")


HEADLINE = {
    # the reference's three jobs, from raw protobuf bytes
    "traffic_raw": traffic_raw,
    "node_info_raw": node_info_raw,
    "text_raw": text_raw,
    "decode_raw": decode_raw,
    "stream_traffic_raw": stream_traffic_raw,
    # the same over a topic BENCH_COPIES times larger (throughput, not overhead)
    "traffic_raw_big": traffic_raw_big,
    "decode_raw_big": decode_raw_big,
    # registered queries (input derived from the tables on the fly)
    "traffic_window": Q.q_traffic_window,
    "traffic_window_1d": Q.q_traffic_window_1d,
    "node_info": Q.q_node_info,
    "text_messages": Q.q_text_messages,
    "notifications": Q.q_notifications,
    "decoded_packets": Q.q_decoded_packets,
    "stream_traffic": Q.q_stream_traffic,
}


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    copies = int(os.environ.get("BENCH_COPIES", "10"))
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app="packetflow-bench",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pf-bench-")})
    stage_topic(spark, sf_dir, cpus, copies)
    results, errors = {}, {}
    for name, fn in HEADLINE.items():
        if only and name not in only:
            continue
        try:
            run_once(spark, fn, sf_dir)  # warm-up
            results[name] = round(statistics.median(run_once(spark, fn, sf_dir)
                                                    for _ in range(runs)), 3)
        except Exception as exc:  # noqa: BLE001 - report and go on with the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    packets = spark.read.parquet(TOPIC["path"]).count()
    big = spark.read.parquet(TOPIC["big"]).count()
    spark.stop()
    total = round(sum(results.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "traffic_window_events_per_sec": round(events / results["traffic_window"])
        if results.get("traffic_window") else None,
        "traffic_raw_packets_per_sec": round(packets / results["traffic_raw"])
        if results.get("traffic_raw") else None,
        "big_topic_packets": big,
        "traffic_raw_big_packets_per_sec": round(big / results["traffic_raw_big"])
        if results.get("traffic_raw_big") else None,
        "decode_raw_big_packets_per_sec": round(big / results["decode_raw_big"])
        if results.get("decode_raw_big") else None,
        "errors": errors,
    }))


if __name__ == "__main__":
    main()
