"""packetflow: radio-mesh packet analytics on Spark DataFrames.

Pipelines are functions DataFrame -> DataFrame that run the same way on batch
and streaming frames; only `streaming` and `sinks` know about `writeStream`.
"""

from packetflow.operators.decode import decode_packets
from packetflow.operators.messages import audit_lines, notification_json, notifications, \
    text_messages
from packetflow.operators.nodes import node_info
from packetflow.operators.traffic import node_context, packet_traffic, payload_kind
from packetflow.plans.jobs import (
    JOB_KINDS,
    node_info_plan,
    run_node_info_job,
    run_text_job,
    run_traffic_job,
    text_plan,
    traffic_plan,
)
from packetflow.sinks.batch import JdbcTarget, TableTarget
from packetflow.sinks.webhook import HttpSender
from packetflow.sources.files import parquet_packet_stream, parquet_packets, replay_range
from packetflow.sources.kafka import kafka_options, kafka_packets
from packetflow.streaming.watermark import with_event_time

__version__ = "0.1.0"

__all__ = [
    "JOB_KINDS", "HttpSender", "JdbcTarget", "TableTarget", "audit_lines", "decode_packets",
    "kafka_options", "kafka_packets", "node_context", "node_info", "node_info_plan",
    "notification_json", "notifications", "packet_traffic", "parquet_packet_stream",
    "parquet_packets", "payload_kind", "replay_range", "run_node_info_job", "run_text_job",
    "run_traffic_job", "text_messages", "text_plan", "traffic_plan", "with_event_time",
]
