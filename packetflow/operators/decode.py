"""Decode raw radio envelopes once, into typed struct columns.

Spark's `from_protobuf` needs the spark-protobuf jar, which is not always on
the classpath; this decoder reads the wire format inside `mapInArrow`, a whole
Arrow batch at a time (operators.wire), so work is split by Spark partitions
and no Python object is made for a packet. Messages that the columnar reader
points out (malformed, merged, groups, ...) go through the protobuf runtime. It
depends only on field *names* of a user-supplied descriptor set:

  envelope one-of members `packet`, `node_info`;
  packet: `from`, `to`, `channel`, `rx_time`, one-of `decoded` / `encrypted`;
  decoded: `portnum` (enum), `payload`;
  node_info: `num`, `user` {`id`, `short_name`, `long_name`, `role` (enum)},
  `last_heard`, `hops_away`, `snr`.

Absent fields read as protobuf defaults (never null); only the one-of tags
carry presence. Malformed bytes or a null value fail the job, as in the
reference. `parts` prunes what is decoded: a part not asked for comes out null.
`only_variant` and `only_port` leave out rows that a job's own filter would
drop next, so that they are not carried back to the JVM.

The watermark must be set *after* this step (`mapInArrow` drops it).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.fixed import UINT32_MASK, UNRECOGNIZED
from packetflow.operators.protobuf import enum_names, message_class, oneof_of
from packetflow.operators.wire import Found, padded, read
from packetflow.session import ship_package

PARTS = ("packet", "node_info")


def _arrow_type(spark_type) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(spark_type)


def _int32(values: list) -> pa.Array:
    # Wire ints may be unsigned (fixed32/uint32): keep the low 32 bits, signed,
    # as a Java int would.
    arr = np.asarray(values, dtype=np.int64)
    return pa.array((arr & UINT32_MASK).astype(np.uint32).view(np.int32))


def _struct(arrays: list, spark_struct, null_mask: list) -> pa.Array:
    fields = [pa.field(f.name, a.type) for f, a in zip(spark_struct.fields, arrays)]
    return pa.StructArray.from_arrays(arrays, fields=fields,
                                      mask=pa.array(null_mask, type=pa.bool_()))


# Packet fields a caller may leave out (they then come out null).
OPTIONAL_PACKET_FIELDS = ("channel", "rx_time", "payload")


class _Layout:
    """Field lookups resolved once per worker from the descriptor."""

    def __init__(self, cls, parts, packet_fields, only_variant=None, only_port=None):
        d = cls.DESCRIPTOR
        members = [p for p in PARTS if p in d.fields_by_name]
        if not members:
            raise ValueError(f"{d.full_name} has neither a packet nor a node_info field")
        self.variant_oneof = oneof_of(d, members[0])
        self.want_packet = "packet" in parts and "packet" in d.fields_by_name
        self.want_node = "node_info" in parts and "node_info" in d.fields_by_name
        self.only_variant, self.only_port = only_variant, only_port
        self.want = {f: packet_fields is None or f in packet_fields
                     for f in OPTIONAL_PACKET_FIELDS}
        if self.want_packet:
            pd_ = d.fields_by_name["packet"].message_type
            self.packet_oneof = oneof_of(pd_, "decoded")
            self.ports = enum_names(pd_.fields_by_name["decoded"].message_type, "portnum")
            self.zero_port = self.ports.get(0, UNRECOGNIZED)
        if self.want_node:
            nd = d.fields_by_name["node_info"].message_type
            self.roles = enum_names(nd.fields_by_name["user"].message_type, "role")


def _decode_rows(batch: pa.RecordBatch, parse, lay: _Layout) -> tuple[list[int], pa.RecordBatch]:
    """Decode with the protobuf runtime, message by message: (places of the rows kept, their columns)."""
    values = batch.column(batch.schema.get_field_index("value")).to_pylist()
    stamps = batch.column(batch.schema.get_field_index("timestamp"))
    variants, kept = [], []
    only_variant, only_port = lay.only_variant, lay.only_port
    p_from, p_to, p_chan, p_rx, p_enc, p_dec, p_port, p_pay, p_null = ([] for _ in range(9))
    n_num, n_id, n_short, n_long, n_role, n_heard, n_hops, n_snr, n_null = ([] for _ in range(9))
    want_packet, want_node = lay.want_packet, lay.want_node
    want_chan, want_rx, want_pay = (lay.want[f] for f in OPTIONAL_PACKET_FIELDS)
    ports = getattr(lay, "ports", {})
    zero_port = getattr(lay, "zero_port", None)
    body_oneof = getattr(lay, "packet_oneof", None)
    roles = getattr(lay, "roles", {})
    variant_oneof = lay.variant_oneof
    for at, raw in enumerate(values):
        if raw is None:
            raise ValueError("radio packet with a null value")
        m = parse(raw)
        v = m.WhichOneof(variant_oneof) or ""
        if only_variant is not None:
            if v != only_variant:
                continue
            if only_port is not None and not (
                    m.packet.WhichOneof(body_oneof) == "decoded"
                    and ports.get(m.packet.decoded.portnum, UNRECOGNIZED) == only_port):
                continue
        kept.append(at)
        variants.append(v)
        if want_packet:
            if v == "packet":
                p = m.packet
                body = p.WhichOneof(body_oneof)
                p_from.append(getattr(p, "from"))
                p_to.append(p.to)
                if want_chan:
                    p_chan.append(p.channel)
                if want_rx:
                    p_rx.append(p.rx_time)
                p_enc.append(body == "encrypted")
                if body == "decoded":
                    dec = p.decoded
                    p_dec.append(True)
                    p_port.append(ports.get(dec.portnum, UNRECOGNIZED))
                    if want_pay:
                        p_pay.append(dec.payload)
                else:
                    # Not decoded: the sub-message reads as its defaults.
                    p_dec.append(False)
                    p_port.append(zero_port)
                    if want_pay:
                        p_pay.append(b"")
                p_null.append(False)
            else:
                p_from.append(0); p_to.append(0); p_enc.append(False); p_dec.append(False)
                p_port.append(None); p_null.append(True)
                if want_chan:
                    p_chan.append(0)
                if want_rx:
                    p_rx.append(0)
                if want_pay:
                    p_pay.append(None)
        if want_node:
            if v == "node_info":
                ni = m.node_info
                u = ni.user
                n_num.append(ni.num)
                n_id.append(u.id)
                n_short.append(u.short_name)
                n_long.append(u.long_name)
                n_role.append(roles.get(u.role, UNRECOGNIZED))
                n_heard.append(ni.last_heard)
                n_hops.append(ni.hops_away)
                n_snr.append(ni.snr)
                n_null.append(False)
            else:
                n_num.append(0); n_id.append(None); n_short.append(None); n_long.append(None)
                n_role.append(None); n_heard.append(0); n_hops.append(0); n_snr.append(0.0)
                n_null.append(True)

    n = len(variants)
    stamps = stamps.take(pa.array(kept, pa.int64()))
    if want_packet:
        packet = _struct([
            _int32(p_from), _int32(p_to),
            _int32(p_chan) if want_chan else pa.nulls(n, pa.int32()),
            _int32(p_rx) if want_rx else pa.nulls(n, pa.int32()),
            pa.array(p_enc, pa.bool_()), pa.array(p_dec, pa.bool_()),
            pa.array(p_port, pa.string()),
            pa.array(p_pay, pa.binary()) if want_pay else pa.nulls(n, pa.binary()),
        ], S.PACKET, p_null)
    else:
        packet = pa.nulls(n, type=_arrow_type(S.PACKET))
    if want_node:
        node = _struct([_int32(n_num), pa.array(n_id, pa.string()),
                        pa.array(n_short, pa.string()), pa.array(n_long, pa.string()),
                        pa.array(n_role, pa.string()), _int32(n_heard), _int32(n_hops),
                        pa.array(n_snr, pa.float32())],
                       S.NODE_INFO_MSG, n_null)
    else:
        node = pa.nulls(n, type=_arrow_type(S.NODE_INFO_MSG))
    return kept, pa.RecordBatch.from_arrays([stamps, pa.array(variants, pa.string()), packet, node],
                                            names=NAMES)


def _wanted(lay: _Layout) -> dict:
    """The fields that are read, for operators.wire."""
    wanted: dict = {}
    if lay.want_packet:
        body = {"portnum": None} | ({"payload": None} if lay.want["payload"] else {})
        rest = [f for f in ("channel", "rx_time") if lay.want[f]]
        wanted["packet"] = {"from": None, "to": None, "decoded": body} | dict.fromkeys(rest)
    if lay.want_node:
        wanted["node_info"] = {"num": None, "last_heard": None, "hops_away": None, "snr": None,
                               "user": dict.fromkeys(("id", "short_name", "long_name", "role"))}
    return wanted


def _spread(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """`values` at `rows` of n places, zero elsewhere."""
    out = np.zeros(n, values.dtype)
    out[rows] = values
    return out


def _named(numbers: np.ndarray, names: dict[int, str]) -> pa.Array:
    known, at = np.unique(numbers, return_inverse=True)
    return pa.array([names.get(k, UNRECOGNIZED) for k in known.tolist()], pa.string()).take(pa.array(at))


def _texts(found: Found | None, rows: np.ndarray, name: str, n: int, kind: pa.DataType) -> pa.Array:
    """A text or bytes field at `rows` of n places, empty elsewhere."""
    parts = [pa.array([b"" if kind == pa.binary() else ""], kind)]
    if found is not None:
        parts.append(found.bytes(name, kind))
    at = np.zeros(n, np.int64)
    at[rows] = np.arange(1, len(rows) + 1)
    return pa.concat_arrays(parts).take(pa.array(at))


NONE = np.zeros(0, np.int64)


def _packet_columns(top: Found, lay: _Layout, n: int) -> tuple[pa.Array, np.ndarray]:
    """The packet structs, and which packets are decoded on the port that is asked for."""
    rows, p = top.message("packet") or (NONE, None)
    has = _spread(rows, np.ones(len(rows), bool), n)
    if p is None:
        return pa.nulls(n, _arrow_type(S.PACKET)), has
    body = p.which(lay.packet_oneof)
    is_decoded = body == p.layout.by_name["decoded"]
    inner, d = p.message("decoded") or (NONE, None)
    port = _spread(inner, d.int32("portnum"), len(rows)) if d else np.zeros(len(rows), np.int32)
    names = _named(port, lay.ports)
    at = _spread(rows, np.arange(len(rows)), n)

    def ints(name):
        return pa.array(_spread(rows, p.int32(name), n)) if lay.want.get(name, True) else pa.nulls(n, pa.int32())

    def flags(mask):
        return pa.array(_spread(rows, mask, n))

    encrypted = p.layout.by_name.get("encrypted", -2)
    packet = pa.StructArray.from_arrays([
        ints("from"), ints("to"), ints("channel"), ints("rx_time"), flags(body == encrypted),
        flags(is_decoded), names.take(pa.array(at)),
        _texts(d, rows[inner], "payload", n, pa.binary()) if lay.want["payload"]
        else pa.nulls(n, pa.binary())],
        fields=list(_arrow_type(S.PACKET)), mask=pa.array(~has))
    asked = is_decoded
    if lay.only_port is not None:
        asked = asked & np.isin(port, [k for k, name in lay.ports.items() if name == lay.only_port])
    return packet, _spread(rows, asked, n)


def _node_columns(top: Found, lay: _Layout, n: int) -> pa.Array:
    rows, ni = top.message("node_info") or (NONE, None)
    if ni is None:
        return pa.nulls(n, _arrow_type(S.NODE_INFO_MSG))
    inner, u = ni.message("user") or (NONE, None)
    users = rows[inner]
    role = _spread(users, u.int32("role") if u else np.zeros(0, np.int32), n)

    def ints(name):
        return pa.array(_spread(rows, ni.int32(name), n))

    def texts(name):
        return _texts(u, users, name, n, pa.string())

    return pa.StructArray.from_arrays(
        [ints("num"), texts("id"), texts("short_name"), texts("long_name"), _named(role, lay.roles),
         ints("last_heard"), ints("hops_away"), pa.array(_spread(rows, ni.float32("snr"), n))],
        fields=list(_arrow_type(S.NODE_INFO_MSG)),
        mask=pa.array(~_spread(rows, np.ones(len(rows), bool), n)))


NAMES = ["timestamp", "variant", "packet", "node_info"]


def _decode_columns(batch: pa.RecordBatch, cls, lay: _Layout) -> pa.RecordBatch:
    """Decode a batch in columns; the messages that this can't settle go through the runtime."""
    values = batch.column(batch.schema.get_field_index("value"))
    stamps = batch.column(batch.schema.get_field_index("timestamp"))
    if values.null_count:
        raise ValueError("radio packet with a null value")
    n = len(values)
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + n + 1].astype(np.int64)
    first, last = (int(ends[0]), int(ends[-1])) if n else (0, 0)
    data = padded(np.frombuffer(values.buffers()[2], np.uint8)[first:last] if last > first
                  else np.zeros(0, np.uint8))
    top = read(data, ends[:-1] - first, ends[1:] - first, cls.DESCRIPTOR, _wanted(lay))
    member = top.which(lay.variant_oneof)
    names = [s.name for s in top.layout.slots]
    keep = ~top.odd
    if lay.only_variant is not None:
        keep &= member == names.index(lay.only_variant)
    packet, asked = _packet_columns(top, lay, n) if lay.want_packet else (
        pa.nulls(n, _arrow_type(S.PACKET)), None)
    node = _node_columns(top, lay, n) if lay.want_node else pa.nulls(n, _arrow_type(S.NODE_INFO_MSG))
    if lay.only_port is not None:
        keep &= asked
    variants = pa.array(["", *names]).take(pa.array(member.astype(np.int64) + 1))
    out = pa.RecordBatch.from_arrays([stamps, variants, packet, node], names=NAMES)
    odd = np.flatnonzero(top.odd)
    if keep.all():
        return out
    places = np.flatnonzero(keep)
    out = out.take(pa.array(places))
    if not len(odd):
        return out
    at, rest = _decode_rows(batch.take(pa.array(odd)), cls.FromString, lay)
    places = np.concatenate((places, odd[at]))
    return pa.concat_batches([out, rest]).take(pa.array(np.argsort(places, kind="stable")))


def decode_packets(raw: DataFrame, descriptor_set: bytes, message: str,
                   parts: tuple[str, ...] = PARTS,
                   packet_fields: tuple[str, ...] | None = None,
                   engine: str = "arrow", only_variant: str | None = None,
                   only_port: str | None = None) -> DataFrame:
    """`value BINARY, timestamp TIMESTAMP` -> the `packets` layout (schema.PACKETS).

    A narrow, per-partition step: no shuffle, no driver round-trip.
    `packet_fields` (None = all) may leave out any of OPTIONAL_PACKET_FIELDS,
    which then come out null: `mapInArrow` is opaque to Catalyst's column
    pruning, so callers say what they read.

    `only_variant` (a part that is decoded) keeps the envelopes of that variant
    alone, and `only_port`, with variant "packet", those decoded on that port.
    Don't give them where a watermark follows: left-out packets can't advance it.

    `engine`: "arrow" (protobuf runtime in Python workers), "jvm" (Spark's
    `from_protobuf`; needs the spark-protobuf jar, see operators.decode_jvm),
    or "auto" (jvm when the jar is on the classpath).
    """
    unknown = set(parts) - set(PARTS)
    if unknown:
        raise ValueError(f"unknown parts: {sorted(unknown)}")
    if only_variant is not None and only_variant not in parts:
        raise ValueError(f"only_variant {only_variant!r} is not among the parts {parts}")
    if only_port is not None and only_variant != "packet":
        raise ValueError("only_port needs only_variant='packet'")
    if engine not in ("arrow", "jvm", "auto"):
        raise ValueError(f"unknown engine: {engine}")
    if engine != "arrow":
        from packetflow.operators.decode_jvm import decode_packets_jvm, jvm_protobuf_available

        if engine == "jvm" or jvm_protobuf_available(raw.sparkSession):
            rows = decode_packets_jvm(raw, descriptor_set, message, tuple(parts))
            if only_variant is not None:
                rows = rows.where(F.col("variant") == only_variant)
            if only_port is not None:
                rows = rows.where(F.col("packet.decoded") & (F.col("packet.portnum") == only_port))
            return rows
    if packet_fields is not None:
        extra = set(packet_fields) - set(S.PACKET.fieldNames())
        if extra:
            raise ValueError(f"unknown packet fields: {sorted(extra)}")
        packet_fields = tuple(packet_fields)
    parts = tuple(parts)
    ship_package(raw.sparkSession)

    def run(batches):
        cls = message_class(descriptor_set, message)
        lay = _Layout(cls, parts, packet_fields, only_variant, only_port)
        for batch in batches:
            yield _decode_columns(batch, cls, lay)

    return raw.select("value", "timestamp").mapInArrow(run, S.PACKETS)
