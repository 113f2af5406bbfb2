"""Descriptor-driven decode, by field name, with protobuf defaults."""

import datetime as dt

import pytest
from google.protobuf import descriptor_pb2

from packetflow import schema as S
from packetflow.operators.decode import decode_packets
from packetflow.operators.protobuf import message_class
from packetflow.operators.traffic import node_context
from testbed.descriptors import ENVELOPE, fixture_descriptor_set
from testbed.encode import encode_packets

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def packet(frm, to, encrypted=False, decoded=False, portnum="UNKNOWN_APP", payload=b"",
           channel=0, rx_time=0):
    return {"from": frm, "to": to, "channel": channel, "rx_time": rx_time,
            "encrypted": encrypted, "decoded": decoded, "portnum": portnum,
            "payload": bytearray(payload)}


def node(num, user_id="", short="", long="", role="CLIENT", last_heard=0, hops=0, snr=0.0):
    return {"num": num, "user_id": user_id, "short_name": short, "long_name": long,
            "role": role, "last_heard": last_heard, "hops_away": hops, "snr": snr}


def frame(spark, rows):
    return spark.createDataFrame(rows, S.PACKETS)


def shifted_descriptor() -> tuple[bytes, str]:
    """The fixture schema with every field number moved and renamed package."""
    fds = descriptor_pb2.FileDescriptorSet.FromString(fixture_descriptor_set())
    f = fds.file[0]
    f.package = "other.pkg"
    f.name = "other.proto"
    for msg in f.message_type:
        for fld in msg.field:
            fld.number += 100
            if fld.type_name:
                fld.type_name = fld.type_name.replace(".packetflow.fixture.", ".other.pkg.")
    return fds.SerializeToString(), "other.pkg.Envelope"


ROWS = [
    (T0, "packet", packet(-1, -2147483648, encrypted=True), None),
    (T0, "packet", packet(5, 7, decoded=True, portnum="TEXT_MESSAGE_APP", payload=b"hi",
                          channel=3, rx_time=1704067200), None),
    (T0, "packet", packet(1, 2), None),  # neither encrypted nor decoded
    (T0, "node_info", None, node(-5, "!id", "ab", "Alpha", "BUILDING", 1704067200, 3, 1.5)),
    (T0, "node_info", None, node(9)),  # no user: defaults
]


@pytest.mark.parametrize("shifted", [False, True])
def test_round_trip_by_field_name(spark, shifted):
    desc, msg = shifted_descriptor() if shifted else (fixture_descriptor_set(), ENVELOPE)
    src = frame(spark, ROWS)
    got = decode_packets(encode_packets(src, desc, msg), desc, msg).collect()
    want = src.collect()
    assert [r.asDict(recursive=True) for r in got] == [r.asDict(recursive=True) for r in want]


def test_kind_of_packet_without_payload_is_empty_not_null(spark):
    src = frame(spark, ROWS)
    raw = encode_packets(src, fixture_descriptor_set(), ENVELOPE)
    ctx = node_context(decode_packets(raw, fixture_descriptor_set(), ENVELOPE))
    got = [(r.from_node, r.to_node, r.kind) for r in ctx.collect()]
    assert got == [(4294967295, 2147483648, "ENCRYPTED"), (5, 7, "TEXT_MESSAGE_APP"), (1, 2, "")]


def test_parts_prune_unused_member(spark):
    raw = encode_packets(frame(spark, ROWS), fixture_descriptor_set(), ENVELOPE)
    got = decode_packets(raw, fixture_descriptor_set(), ENVELOPE, parts=("packet",)).collect()
    assert all(r.node_info is None for r in got)
    assert [r.variant for r in got] == ["packet"] * 3 + ["node_info"] * 2


def test_unknown_enum_number_reads_unrecognized(spark):
    cls = message_class(fixture_descriptor_set(), ENVELOPE)
    m = cls()
    m.packet.decoded.portnum = 99
    raw = spark.createDataFrame([(bytearray(m.SerializeToString()), T0)], S.PACKETS_RAW)
    got = decode_packets(raw, fixture_descriptor_set(), ENVELOPE).first()
    assert got.packet.portnum == "UNRECOGNIZED" and got.packet.decoded


def test_empty_envelope_has_empty_variant(spark):
    raw = spark.createDataFrame([(bytearray(b""), T0)], S.PACKETS_RAW)
    got = decode_packets(raw, fixture_descriptor_set(), ENVELOPE).first()
    assert got.variant == "" and got.packet is None and got.node_info is None


def test_truncated_protobuf_fails_the_job(spark):
    cls = message_class(fixture_descriptor_set(), ENVELOPE)
    m = cls()
    m.node_info.user.long_name = "a long enough name"
    cut = m.SerializeToString()[:-3]
    raw = spark.createDataFrame([(bytearray(cut), T0)], S.PACKETS_RAW)
    with pytest.raises(Exception):
        decode_packets(raw, fixture_descriptor_set(), ENVELOPE).collect()


def test_null_value_fails_the_job(spark):
    raw = spark.createDataFrame([(None, T0)], S.PACKETS_RAW)
    with pytest.raises(Exception):
        decode_packets(raw, fixture_descriptor_set(), ENVELOPE).collect()


@pytest.mark.parametrize("only, rows", [
    (dict(only_variant="packet"), ROWS[:3]),
    (dict(only_variant="node_info"), ROWS[3:]),
    (dict(only_variant="packet", only_port="TEXT_MESSAGE_APP"), ROWS[1:2]),
    (dict(only_variant="packet", only_port="PORT_NOBODY_USES"), []),
])
def test_rows_that_a_job_would_drop_are_left_out(spark, only, rows):
    desc = fixture_descriptor_set()
    raw = encode_packets(frame(spark, ROWS), desc, ENVELOPE)
    got = decode_packets(raw, desc, ENVELOPE, **only).collect()
    want = [r for r in decode_packets(raw, desc, ENVELOPE).collect()
            if (r.variant, r.packet and r.packet["from"], r.node_info and r.node_info.num) in
            {(v, p and p["from"], n and n["num"]) for _, v, p, n in rows}]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == len(rows)


def test_left_out_rows_must_be_of_a_decoded_part(spark):
    raw = spark.createDataFrame([], S.PACKETS_RAW)
    with pytest.raises(ValueError):
        decode_packets(raw, b"", ENVELOPE, parts=("packet",), only_variant="node_info")
    with pytest.raises(ValueError):
        decode_packets(raw, b"", ENVELOPE, only_port="TEXT_MESSAGE_APP")
