"""D1 in the JVM: Spark's `from_protobuf`, when the spark-protobuf jar is present.

Keeps decoding inside whole-stage code generation (no Python worker). The
jar is not in this build environment, so this path is opt-in
(`decode_packets(..., engine="jvm")`); `to_packets` maps the struct that
`from_protobuf` returns onto the same `packets` layout as the Arrow decoder:

* absent proto3 scalars come back null there and are set to their defaults;
* a one-of member that is set comes back as a (possibly all-null) struct or
  value, an unset one as null: that gives `variant`, `encrypted`, `decoded`;
* an unknown enum number comes back as `UNKNOWN_ENUM_VALUE_…` and reads as
  `UNRECOGNIZED`, as the reference's generated classes name it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.fixed import UINT32_MASK, UNRECOGNIZED
from packetflow.operators.protobuf import enum_names, message_class, oneof_of

# Spark's prefix for the names of unknown enum numbers.
UNKNOWN_ENUM_PREFIX = "UNKNOWN_ENUM_VALUE_"
# The expression class that only the spark-protobuf jar provides (Spark's own
# jars carry a stub of the functions object that fails when called).
_JVM_EXPRESSION = "org.apache.spark.sql.protobuf.ProtobufDataToCatalyst"


def jvm_protobuf_available(spark: SparkSession) -> bool:
    from py4j.java_gateway import JavaClass

    obj = spark.sparkContext._jvm
    for part in _JVM_EXPRESSION.split("."):
        obj = getattr(obj, part)
    return isinstance(obj, JavaClass)


def _int32(c: Column) -> Column:
    # int or (with upcast.unsigned.ints) long -> the low 32 bits as signed int.
    low = F.coalesce(c, F.lit(0)).cast("bigint").bitwiseAND(F.lit(UINT32_MASK))
    return F.when(low >= F.lit(2 ** 31), low - F.lit(2 ** 32)).otherwise(low).cast("int")


def _enum(c: Column, zero_name: str) -> Column:
    name = F.coalesce(c, F.lit(zero_name))
    return F.when(name.startswith(UNKNOWN_ENUM_PREFIX), F.lit(UNRECOGNIZED)).otherwise(name)


def to_packets(env: Column, members: list[str], zero_port: str, zero_role: str,
               parts: tuple[str, ...]) -> list[Column]:
    """Columns variant, packet, node_info from a `from_protobuf` envelope struct."""
    variant = F.lit("")
    for name in reversed(members):
        variant = F.when(env[name].isNotNull(), F.lit(name)).otherwise(variant)
    out = [variant.alias("variant")]

    p = env["packet"]
    dec = p["decoded"]
    packet = F.struct(
        _int32(p["from"]).alias("from"), _int32(p["to"]).alias("to"),
        _int32(p["channel"]).alias("channel"), _int32(p["rx_time"]).alias("rx_time"),
        p["encrypted"].isNotNull().alias("encrypted"), dec.isNotNull().alias("decoded"),
        _enum(dec["portnum"], zero_port).alias("portnum"),
        F.coalesce(dec["payload"], F.lit(b"").cast("binary")).alias("payload"))
    out.append((F.when(p.isNotNull(), packet) if "packet" in parts
                else F.lit(None).cast(S.PACKET)).alias("packet"))

    n = env["node_info"]
    u = n["user"]
    node = F.struct(
        _int32(n["num"]).alias("num"),
        F.coalesce(u["id"], F.lit("")).alias("user_id"),
        F.coalesce(u["short_name"], F.lit("")).alias("short_name"),
        F.coalesce(u["long_name"], F.lit("")).alias("long_name"),
        _enum(u["role"], zero_role).alias("role"),
        _int32(n["last_heard"]).alias("last_heard"),
        _int32(n["hops_away"]).alias("hops_away"),
        F.coalesce(n["snr"], F.lit(0.0)).cast("float").alias("snr"))
    out.append((F.when(n.isNotNull(), node) if "node_info" in parts
                else F.lit(None).cast(S.NODE_INFO_MSG)).alias("node_info"))
    return out


def envelope_facts(descriptor_set: bytes, message: str) -> tuple[list[str], str, str]:
    """One-of member names and the zero enum names, read on the driver."""
    d = message_class(descriptor_set, message).DESCRIPTOR
    members = [f.name for f in d.oneofs_by_name[oneof_of(d, "packet")].fields]
    pkt = d.fields_by_name["packet"].message_type
    zero_port = enum_names(pkt.fields_by_name["decoded"].message_type, "portnum").get(0, UNRECOGNIZED)
    user = d.fields_by_name["node_info"].message_type.fields_by_name["user"].message_type
    zero_role = enum_names(user, "role").get(0, UNRECOGNIZED)
    return members, zero_port, zero_role


def decode_packets_jvm(raw: DataFrame, descriptor_set: bytes, message: str,
                       parts: tuple[str, ...]) -> DataFrame:
    from pyspark.sql.protobuf.functions import from_protobuf

    members, zero_port, zero_role = envelope_facts(descriptor_set, message)
    value = F.when(F.col("value").isNull(),
                   F.raise_error(F.lit("radio packet with a null value"))).otherwise(F.col("value"))
    env = from_protobuf(value, message, options={"mode": "FAILFAST"},
                        binaryDescriptorSet=descriptor_set)
    parsed = raw.select("timestamp", env.alias("env"))
    return parsed.select("timestamp", *to_packets(F.col("env"), members, zero_port, zero_role,
                                                  parts))
