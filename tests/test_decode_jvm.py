"""The JVM decode path's mapping, on structs shaped like `from_protobuf` output.

The spark-protobuf jar is absent here, so `from_protobuf` itself cannot run;
the struct below has its layout (absent scalars null, set one-of members
non-null) for the same messages as tests/test_decode.py.
"""

import datetime as dt

from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.operators.decode import decode_packets
from packetflow.operators.decode_jvm import envelope_facts, jvm_protobuf_available, to_packets
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from testbed.encode import encode_packets
from tests.test_decode import ROWS

T0 = dt.datetime(2024, 1, 1)
ENV = ("id:int, packet:struct<from:int, to:int, channel:int, "
       "decoded:struct<portnum:string, payload:binary>, encrypted:binary, rx_time:int>, "
       "node_info:struct<num:int, user:struct<id:string, long_name:string, short_name:string, "
       "role:string>, snr:float, last_heard:int, hops_away:int>, note:string")

# The messages of tests.test_decode.ROWS as from_protobuf would return them.
PARSED = [
    (None, (-1, -2147483648, None, None, bytearray(b""), None), None, None),
    (None, (5, 7, 3, ("TEXT_MESSAGE_APP", bytearray(b"hi")), None, 1704067200), None, None),
    (None, (1, 2, None, None, None, None), None, None),
    (None, None, (-5, ("!id", "Alpha", "ab", "BUILDING"), 1.5, 1704067200, 3), None),
    (None, None, (9, None, None, None, None), None),
]


def test_mapping_matches_the_arrow_decoder(spark):
    members, zero_port, zero_role = envelope_facts(fixture_descriptor_set(), ENVELOPE)
    assert members == ["packet", "node_info", "note"]
    parsed = spark.createDataFrame([(T0, p) for p in PARSED], f"timestamp timestamp, env struct<{ENV}>")
    got = parsed.select("timestamp", *to_packets(F.col("env"), members, zero_port, zero_role,
                                                 ("packet", "node_info")))
    desc = fixture_descriptor_set()
    want = decode_packets(encode_packets(spark.createDataFrame(ROWS, S.PACKETS), desc, ENVELOPE),
                          desc, ENVELOPE)
    assert [r.asDict(recursive=True) for r in got.collect()] == \
        [r.asDict(recursive=True) for r in want.collect()]


def test_unknown_enum_and_unsigned_upcast(spark):
    members, zero_port, zero_role = envelope_facts(fixture_descriptor_set(), ENVELOPE)
    df = spark.createDataFrame(
        [(T0, 4294967295, "UNKNOWN_ENUM_VALUE_PortNum_99")],
        "timestamp timestamp, f long, port string")
    env = F.struct(F.lit(None).cast("int").alias("id"),
                   F.struct(F.col("f").alias("from"), F.lit(None).cast("long").alias("to"),
                            F.lit(None).cast("long").alias("channel"),
                            F.struct(F.col("port").alias("portnum"),
                                     F.lit(None).cast("binary").alias("payload")).alias("decoded"),
                            F.lit(None).cast("binary").alias("encrypted"),
                            F.lit(None).cast("long").alias("rx_time")).alias("packet"),
                   F.lit(None).cast("struct<num:int,user:struct<id:string,long_name:string,"
                                    "short_name:string,role:string>,snr:float,last_heard:int,"
                                    "hops_away:int>").alias("node_info"),
                   F.lit(None).cast("string").alias("note"))
    row = df.select(*to_packets(env, members, zero_port, zero_role, ("packet",))).first()
    assert row.variant == "packet"
    assert row.packet["from"] == -1 and row.packet.portnum == "UNRECOGNIZED"
    assert row.node_info is None


def test_jar_absent_here_so_auto_uses_arrow(spark):
    assert not jvm_protobuf_available(spark)
    desc = fixture_descriptor_set()
    raw = encode_packets(spark.createDataFrame(ROWS, S.PACKETS), desc, ENVELOPE)
    plan = decode_packets(raw, desc, ENVELOPE, engine="auto")._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("MapInArrow") == 2


def test_jvm_engine_without_the_jar_fails_loudly(spark):
    import pytest

    desc = fixture_descriptor_set()
    raw = encode_packets(spark.createDataFrame(ROWS, S.PACKETS), desc, ENVELOPE)
    with pytest.raises(Exception, match="(?i)protobuf"):
        decode_packets(raw, desc, ENVELOPE, engine="jvm").collect()
