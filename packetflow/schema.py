"""Column layout of every stage (see FIXTURES.md §2)."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw radio packets, in the Kafka source's own column names.
PACKETS_RAW = T.StructType([
    T.StructField("value", T.BinaryType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# The same with their place in the topic's log, for replays bounded by offsets.
PACKETS_LOG = T.StructType([
    *PACKETS_RAW.fields,
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
])

# The fields of a decoded radio packet the pipelines read. `encrypted` and
# `decoded` are the presence tags of the packet's one-of; every other field
# carries its protobuf default when absent.
PACKET = T.StructType([
    T.StructField("from", T.IntegerType(), True),
    T.StructField("to", T.IntegerType(), True),
    T.StructField("channel", T.IntegerType(), True),
    T.StructField("rx_time", T.IntegerType(), True),
    T.StructField("encrypted", T.BooleanType(), True),
    T.StructField("decoded", T.BooleanType(), True),
    T.StructField("portnum", T.StringType(), True),
    T.StructField("payload", T.BinaryType(), True),
])

NODE_INFO_MSG = T.StructType([
    T.StructField("num", T.IntegerType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("short_name", T.StringType(), True),
    T.StructField("long_name", T.StringType(), True),
    T.StructField("role", T.StringType(), True),
    T.StructField("last_heard", T.IntegerType(), True),
    T.StructField("hops_away", T.IntegerType(), True),
    T.StructField("snr", T.FloatType(), True),
])

# Decoded envelope: `variant` names the envelope's one-of member ("packet",
# "node_info", ... or "" when unset); only that member's struct is filled.
PACKETS = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("variant", T.StringType(), True),
    T.StructField("packet", PACKET, True),
    T.StructField("node_info", NODE_INFO_MSG, True),
])

TRAFFIC = T.StructType([
    T.StructField("from_node", T.LongType(), True),
    T.StructField("to_node", T.LongType(), True),
    T.StructField("packet_count", T.IntegerType(), True),
    T.StructField("window_start", T.TimestampType(), True),
    T.StructField("window_end", T.TimestampType(), True),
    T.StructField("kind", T.StringType(), True),
    T.StructField("job_id", T.StringType(), True),
])

# Declared table schema of the node-info job.
NODE_INFO = T.StructType([
    T.StructField("node_id", T.LongType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("user_name", T.StringType(), True),
    T.StructField("user_long_name", T.StringType(), True),
    T.StructField("user_role", T.StringType(), True),
    T.StructField("last_heard", T.TimestampNTZType(), True),
    T.StructField("hops_away", T.IntegerType(), True),
    T.StructField("snr", T.FloatType(), True),
])

TEXT_MESSAGES = T.StructType([
    T.StructField("from_node", T.LongType(), True),
    T.StructField("to_node", T.LongType(), True),
    T.StructField("time", T.TimestampNTZType(), True),
    T.StructField("channel", T.IntegerType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("job_id", T.StringType(), True),
])

NOTIFICATIONS = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("priority", T.IntegerType(), True),
])
