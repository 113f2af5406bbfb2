"""Run the three jobs locally, as streams, on packets derived from the test tables.

    python examples/local_demo.py [/root/testdata/sf0.01]

Stages an encoded packet "topic" (parquet files with Kafka's two columns) in
a fresh folder under the checkpoint folder, then runs, each to the end of its
input (available-now): J1 traffic into a table, J2 node info through a SQL
DDL + INSERT sink, J3 text into a table + audit table with a webhook sender
that only logs. On a cluster, read the topic with `kafka_packets` instead and
keep the default trigger.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from packetflow import (  # noqa: E402
    TableTarget,
    parquet_packet_stream,
    run_node_info_job,
    run_text_job,
    run_traffic_job,
)
from packetflow.session import local_session, run_folder  # noqa: E402
from testbed.descriptors import ENVELOPE, fixture_descriptor_set  # noqa: E402
from testbed.packets import raw_packets  # noqa: E402
from packetflow.streaming.runner import run_to_end  # noqa: E402


def log_sender(body: str) -> int:
    """Stands in for the webhook: nothing leaves the machine."""
    return 200


def main(sf_dir: str) -> None:
    spark = local_session(8)
    folder = run_folder(spark, "demo")
    raw_packets(spark, sf_dir).write.parquet(f"{folder}/topic")
    desc = fixture_descriptor_set()

    def topic():
        return parquet_packet_stream(spark, f"{folder}/topic")

    traffic = TableTarget(f"{folder}/traffic")
    run_to_end(run_traffic_job(topic(), traffic, f"{folder}/ck-traffic", desc, ENVELOPE,
                               trigger="available-now"))

    database = f"demo_{uuid.uuid4().hex}"       # of this run's own, so no other table is met
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
    spark.catalog.setCurrentDatabase(database)
    ddl = ("CREATE TABLE node_info_sink (node_id BIGINT, user_id STRING, user_name STRING, "
           "user_long_name STRING, user_role STRING, last_heard TIMESTAMP_NTZ, "
           f"hops_away INT, snr FLOAT) USING parquet LOCATION '{folder}/node_info'")
    run_to_end(run_node_info_job(topic(), f"{folder}/ck-nodes", desc, ENVELOPE, ddl,
                                 trigger="available-now"))

    texts, audit = TableTarget(f"{folder}/text"), TableTarget(f"{folder}/audit")
    run_to_end(run_text_job(topic(), texts, f"{folder}/ck-text", desc, ENVELOPE,
                            sender=log_sender, audit_target=audit, trigger="available-now"))

    print(f"traffic rows:   {traffic.read(spark).count()}")
    print(f"node_info rows: {spark.table('node_info_sink').count()}")
    print(f"text rows:      {texts.read(spark).count()}")
    audit.read(spark).show(3, truncate=80)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
