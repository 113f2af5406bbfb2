"""The columnar wire reader against the protobuf runtime, message by message."""

import datetime as dt

import numpy as np
import pyarrow as pa
import pytest
from google.protobuf import descriptor_pb2
from google.protobuf.message import DecodeError
from hypothesis import given, settings
from hypothesis import strategies as st

from packetflow.operators import decode as D
from packetflow.operators import wire
from packetflow.operators.protobuf import message_class
from testbed.descriptors import ENVELOPE, fixture_descriptor_set

FDP = descriptor_pb2.FieldDescriptorProto


def other_descriptor() -> tuple[bytes, str]:
    """The fixture schema with other wire types, repeated fields, a closed enum and a recursive message."""
    fds = descriptor_pb2.FileDescriptorSet.FromString(fixture_descriptor_set())
    f = fds.file[0]
    f.package, f.name, f.syntax = "other.wire", "wire.proto", "proto2"
    kinds = {"from": FDP.TYPE_SINT32, "to": FDP.TYPE_INT64, "channel": FDP.TYPE_SFIXED64,
             "rx_time": FDP.TYPE_UINT64, "snr": FDP.TYPE_DOUBLE, "num": FDP.TYPE_SINT64}
    for m in f.message_type:
        for fld in m.field:
            fld.type = kinds.get(fld.name, fld.type)
            if fld.type_name:
                fld.type_name = fld.type_name.replace(".packetflow.fixture.", ".other.wire.")
        if m.name == "RadioPacket":
            m.field.add(name="hops", number=30, type=FDP.TYPE_UINT32, label=FDP.LABEL_REPEATED)
            m.field.add(name="inner", number=31, type=FDP.TYPE_MESSAGE, label=FDP.LABEL_OPTIONAL,
                        type_name=".other.wire.RadioPacket")
            m.field.add(name="neighbours", number=4000, type=FDP.TYPE_MESSAGE,
                        label=FDP.LABEL_REPEATED, type_name=".other.wire.User")
    return fds.SerializeToString(), "other.wire.Envelope"


SCHEMAS = [(fixture_descriptor_set(), ENVELOPE), other_descriptor()]
CLASSES = [message_class(*s) for s in SCHEMAS]


def batch_of(values):
    t0 = dt.datetime(2024, 1, 1)
    stamps = pa.array([t0 + dt.timedelta(seconds=i) for i in range(len(values))], pa.timestamp("us"))
    return pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), stamps], names=["value", "timestamp"])


def outcome(decode, values):
    try:
        return decode(batch_of(values)).to_pylist()
    except (DecodeError, UnicodeDecodeError, pa.ArrowInvalid):     # proto2 text is checked when it is read
        return "malformed"


def both(values, cls, **kw):
    lay = D._Layout(cls, kw.pop("parts", D.PARTS), kw.pop("packet_fields", None), **kw)
    rows = outcome(lambda b: D._decode_rows(b, cls.FromString, lay)[1], values)
    columns = outcome(lambda b: D._decode_columns(b, cls, lay), values)
    return rows, columns


def same(rows, columns):
    # NaN differs from itself, and so does a float of another width.
    assert repr(rows) == repr(columns)


u32 = st.integers(0, 2 ** 32 - 1)
text = st.text(max_size=12)


@st.composite
def message(draw, which=0):
    cls = CLASSES[which]
    m = cls()
    if draw(st.booleans()):
        m.id = draw(u32)
    kind = draw(st.sampled_from(["packet", "node", "note", "none"]))
    if kind == "packet":
        p = m.packet
        p.SetInParent()
        small = st.integers(-2 ** 31, 2 ** 31 - 1) if which else u32
        for name in ("from", "to", "channel", "rx_time"):
            if draw(st.booleans()):
                setattr(p, name, draw(u32 if name == "rx_time" else small))
        body = draw(st.sampled_from(["decoded", "encrypted", "none"]))
        if body == "decoded":
            p.decoded.SetInParent()
            p.decoded.portnum = draw(st.sampled_from([0, 1, 64] + ([] if which else [7, -3])))
            p.decoded.payload = draw(st.binary(max_size=40))
        elif body == "encrypted":
            p.encrypted = draw(st.binary(max_size=9))
        if which and draw(st.booleans()):
            p.hops.extend(draw(st.lists(u32, max_size=3)))
            p.inner.inner.to = 5
            p.neighbours.add().id = draw(text)
    elif kind == "node":
        n = m.node_info
        n.num = draw(u32)
        n.last_heard, n.hops_away = draw(u32), draw(u32)
        n.snr = draw(st.floats(width=32, allow_nan=False))
        if draw(st.booleans()):
            n.user.id, n.user.long_name, n.user.short_name = draw(text), draw(text), draw(text)
            n.user.role = draw(st.integers(0, 5))
    elif kind == "note":
        m.note = draw(text)
    return m.SerializeToString()


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


@st.composite
def unknown(draw):
    tag = draw(st.integers(100, 600)) << 3
    kind = draw(st.sampled_from([0, 1, 2, 5, 3]))
    body = {0: varint(draw(st.integers(0, 2 ** 64 - 1))), 1: b"12345678", 5: b"1234",
            2: varint(3) + b"abc", 3: varint(8) + b"\x05" + varint(tag | 4)}[kind]
    return varint(tag | kind) + body


@st.composite
def mangled(draw, which=0):
    parts = draw(st.lists(st.one_of(message(which), unknown()), min_size=1, max_size=3))
    raw = b"".join(parts)
    change = draw(st.sampled_from(["none", "none", "cut", "byte", "inside"]))
    if raw and change == "cut":
        raw = raw[:draw(st.integers(0, len(raw)))]
    elif raw and change in ("byte", "inside"):
        at = draw(st.integers(0, len(raw) - 1))
        put = draw(st.binary(min_size=1, max_size=3))
        raw = raw[:at] + put + raw[at + (change == "byte"):]
    return raw


@settings(max_examples=400, deadline=None)
@given(st.lists(message(), max_size=8), st.lists(message(1), max_size=8))
def test_messages_equal_the_runtime(first, second):
    for cls, values in zip(CLASSES, (first, second)):
        rows, columns = both(values, cls)
        assert rows != "malformed"
        same(rows, columns)


@settings(max_examples=600, deadline=None)
@given(mangled(), mangled(1))
def test_unknown_repeated_and_broken_bytes_equal_the_runtime(first, second):
    for cls, raw in zip(CLASSES, (first, second)):
        same(*both([raw], cls))


@settings(max_examples=200, deadline=None)
@given(st.lists(mangled(), max_size=6), st.sampled_from([
    dict(parts=("packet",), packet_fields=("from", "to", "encrypted", "decoded", "portnum")),
    dict(parts=("node_info",)), dict(only_variant="node_info"), dict(only_variant="packet"),
    dict(only_variant="packet", only_port="TEXT_MESSAGE_APP"), dict(only_variant="packet", only_port="X")]))
def test_left_out_parts_and_rows_equal_the_runtime(values, kw):
    rows, columns = both(values, CLASSES[0], **kw)
    same(rows, columns)


def found_in(values):
    batch = batch_of(values)
    ends = np.frombuffer(batch.column(0).buffers()[1], np.int32).astype(np.int64)[:len(values) + 1]
    data = wire.padded(np.frombuffer(batch.column(0).buffers()[2], np.uint8)[:ends[-1]])
    cls = CLASSES[0]
    return wire.read(data, ends[:-1], ends[1:], cls.DESCRIPTOR,
                     D._wanted(D._Layout(cls, D.PARTS, None)))


def test_ordinary_messages_need_no_runtime():
    cls = CLASSES[0]
    values = []
    for i in range(200):
        m = cls()
        if i % 3:
            setattr(m.packet, "from", i * 10 ** 7)
            m.packet.decoded.payload = b"x" * i
        else:
            m.node_info.user.long_name = "Łódź " * (i % 5)
        values.append(m.SerializeToString() + (varint(200 << 3) + varint(i) if i % 2 else b""))
    assert not found_in(values).odd.any()


@pytest.mark.parametrize("raw", [
    b"\x08", b"\x08\x80", b"\x0a\x05ab", b"\x3a\x02\x5d\x01", b"\x00\x01", b"\x0f",
    b"\x08" + b"\xff" * 10 + b"\x01", b"\x4a\x02\xff\xfe", varint((1 << 29) << 3) + b"\x01"])
def test_broken_bytes_fail(raw):
    rows, columns = both([CLASSES[0]().SerializeToString(), raw], CLASSES[0])
    assert rows == columns == "malformed"


def test_slices_and_empty_batches():
    cls = CLASSES[0]
    lay = D._Layout(cls, D.PARTS, None)
    values = [cls(id=i, note=str(i)).SerializeToString() for i in range(20)]
    part = D._decode_columns(batch_of(values).slice(7, 5), cls, lay)
    assert part.to_pylist() == D._decode_columns(batch_of(values), cls, lay).to_pylist()[7:12]
    assert D._decode_columns(batch_of([]), cls, lay).num_rows == 0
    assert D._decode_columns(batch_of([b""] * 3), cls, lay).column(1).to_pylist() == [""] * 3
    with pytest.raises(ValueError):
        D._decode_columns(batch_of([b"", None]), cls, lay)
