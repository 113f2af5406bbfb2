"""Radio packets derived from the driver's test tables (FIXTURES.md §3).

`/root/testdata` holds no packets, so each source is a fixed expression over
one table, easy to repeat in SQL. Each is a plain projection of a parquet
scan: Catalyst prunes the scan to the columns used, and the work grows with
the table. Output layout: schema.PACKETS (the decoded form). `topic` is the
folder of one of them as protobuf bytes (schema.PACKETS_RAW), encoded once for
an application and read by all its queries, as a producer's topic would be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.session import run_folder
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from testbed.encode import encode_packets

# Fixture constants (FIXTURES.md §3).
BASE_EPOCH = 1704067200  # 2024-01-01T00:00:00Z
ZERO_PORT = "UNKNOWN_APP"
ZERO_ROLE = "CLIENT"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _packet(frm, to, channel, rx_time, encrypted, decoded, portnum, payload) -> Column:
    return F.struct(
        frm.cast("int").alias("from"), to.cast("int").alias("to"),
        channel.cast("int").alias("channel"), rx_time.cast("int").alias("rx_time"),
        encrypted.alias("encrypted"), decoded.alias("decoded"),
        portnum.alias("portnum"), payload.cast("binary").alias("payload"))


def _null(struct_type) -> Column:
    return F.lit(None).cast(struct_type)


def _node(num, user_id, short_name, long_name, role, last_heard, hops, snr) -> Column:
    return F.struct(
        num.cast("int").alias("num"), user_id.alias("user_id"),
        short_name.alias("short_name"), long_name.alias("long_name"), role.alias("role"),
        last_heard.cast("int").alias("last_heard"), hops.cast("int").alias("hops_away"),
        snr.cast("float").alias("snr"))


def events_packets(spark: SparkSession, sf_dir: str, payload: bool = True,
                   extra: tuple[Column, ...] = ()) -> DataFrame:
    """Traffic: one packet per event; signups are node-info envelopes.

    The event's `props` are the payload of decoded packets. Plans that start
    from typed packets and use no payload leave it out, and so don't read it.
    """
    e = _table(spark, sf_dir, "events")
    etype = F.col("event_type")
    decoded = etype.isin("click", "purchase")
    portnum = (F.when(etype == "click", F.lit("TEXT_MESSAGE_APP"))
               .when(etype == "purchase", F.lit("PORT_A"))
               .otherwise(F.lit(ZERO_PORT)))
    ts = F.col("ts").cast("timestamp")
    packet = _packet(
        F.col("user_id") % 8 - 4,
        F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id") % 3),
        F.lit(0), F.unix_seconds(ts), etype == "error", decoded, portnum,
        F.when(decoded, F.encode(F.col("props"), "UTF-8")) if payload else F.lit(b""))
    # A signup envelope carries a node without user: protobuf defaults.
    node = _node(F.col("user_id"), F.lit(""), F.lit(""), F.lit(""), F.lit(ZERO_ROLE),
                 F.lit(0), F.lit(0), F.lit(0.0))
    is_node = etype == "signup"
    return e.select(
        ts.alias("timestamp"),
        F.when(is_node, F.lit("node_info")).otherwise(F.lit("packet")).alias("variant"),
        F.when(~is_node, packet).otherwise(_null(S.PACKET)).alias("packet"),
        F.when(is_node, node).otherwise(_null(S.NODE_INFO_MSG)).alias("node_info"), *extra)


def customer_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node info: one node-info envelope per customer."""
    c = _table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    node = _node(
        key - 500, F.col("c_name"), F.substring(F.col("c_name"), -4, 4), F.col("c_name"),
        F.col("c_mktsegment"),
        F.when(key % 10 == 0, F.lit(0)).otherwise(F.lit(BASE_EPOCH) + key * 60),
        F.col("c_nationkey") % 8, F.col("c_acctbal") / 100)
    return c.select(
        F.timestamp_seconds(F.lit(BASE_EPOCH) + key * 60).alias("timestamp"),
        F.lit("node_info").alias("variant"),
        _null(S.PACKET).alias("packet"),
        node.alias("node_info"))


def conversation_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text: one packet per conversation turn; user turns are text messages."""
    t = _table(spark, sf_dir, "conversations")
    role = F.col("role")
    decoded = role.isin("user", "system")
    portnum = (F.when(role == "user", F.lit("TEXT_MESSAGE_APP"))
               .when(role == "system", F.lit("PORT_A"))
               .otherwise(F.lit(ZERO_PORT)))
    rx = F.lit(BASE_EPOCH) + F.col("conv_id") * 60 + F.col("turn")
    packet = _packet(
        F.col("conv_id") - 50, F.lit(-1), F.col("turn"), rx, role == "assistant", decoded,
        portnum, F.when(decoded, F.encode(F.col("text"), "UTF-8")).otherwise(F.lit(b"")))
    return t.select(
        F.timestamp_seconds(rx).alias("timestamp"),
        F.lit("packet").alias("variant"),
        packet.alias("packet"),
        _null(S.NODE_INFO_MSG).alias("node_info"))


def all_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three sources as one topic, the way the reference reads them."""
    return (events_packets(spark, sf_dir)
            .unionByName(customer_packets(spark, sf_dir))
            .unionByName(conversation_packets(spark, sf_dir)))


TOPICS = {"events": events_packets, "customer": customer_packets,
          "conversations": conversation_packets, "all": all_packets}

_STAGED: dict[tuple[str, str, str], str] = {}


def topic(spark: SparkSession, sf_dir: str, name: str = "all") -> str:
    """The folder of a topic of the test tables, in the shared checkpoint folder."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _STAGED:
        folder = run_folder(spark, f"topic-{name}")
        encode_packets(TOPICS[name](spark, sf_dir), fixture_descriptor_set(), ENVELOPE).write.parquet(folder)
        _STAGED[key] = folder
    return _STAGED[key]


def raw_packets(spark: SparkSession, sf_dir: str, name: str = "all") -> DataFrame:
    """The topic's packets (value, timestamp)."""
    return spark.read.schema(S.PACKETS_RAW).parquet(topic(spark, sf_dir, name))


def offset_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with partition and offset, as a log has them.

    A partition takes every fourth user; its offsets follow the event ids,
    but errors reach the log some 300 events late, so that record times don't
    rise with the offsets.
    """
    late = F.when(F.col("event_type") == "error", F.lit(601)).otherwise(F.lit(0))
    return events_packets(spark, sf_dir, payload=False, extra=(
        (F.col("user_id") % 4).cast("int").alias("partition"),
        (F.col("event_id") * 2 + late).cast("long").alias("offset")))
