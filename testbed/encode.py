"""Encode decoded packets to protobuf bytes: the test topics' producer.

The inverse of operators.decode, by field name, inside `mapInArrow`.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from packetflow import schema as S
from packetflow.fixed import UINT32_MASK as MASK
from packetflow.operators.protobuf import enum_numbers, message_class
from packetflow.session import ship_package

# Python workers get these functions with the task; this package isn't installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _children(batch: pa.RecordBatch, name: str, fields) -> dict[str, list]:
    col = batch.column(batch.schema.get_field_index(name))
    return {f.name: col.field(i).to_pylist() for i, f in enumerate(fields)}


def _encode_batch(batch: pa.RecordBatch, cls, ports: dict, roles: dict) -> list[bytes]:
    variants = batch.column(batch.schema.get_field_index("variant")).to_pylist()
    p = _children(batch, "packet", S.PACKET.fields)
    n = _children(batch, "node_info", S.NODE_INFO_MSG.fields)
    p_valid = batch.column(batch.schema.get_field_index("packet")).is_valid().to_pylist()
    n_valid = batch.column(batch.schema.get_field_index("node_info")).is_valid().to_pylist()
    out = []
    for i, variant in enumerate(variants):
        m = cls()
        if variant == "packet" and p_valid[i]:
            pk = m.packet
            pk.SetInParent()
            setattr(pk, "from", p["from"][i] & MASK)
            pk.to = p["to"][i] & MASK
            pk.channel = p["channel"][i] & MASK
            pk.rx_time = p["rx_time"][i] & MASK
            if p["encrypted"][i]:
                pk.encrypted = b""
            elif p["decoded"][i]:
                dec = pk.decoded
                dec.SetInParent()
                dec.portnum = ports[p["portnum"][i]]
                dec.payload = p["payload"][i] or b""
        elif variant == "node_info" and n_valid[i]:
            ni = m.node_info
            ni.SetInParent()
            ni.num = n["num"][i] & MASK
            role = roles[n["role"][i]]
            if n["user_id"][i] or n["short_name"][i] or n["long_name"][i] or role:
                u = ni.user
                u.id = n["user_id"][i]
                u.short_name = n["short_name"][i]
                u.long_name = n["long_name"][i]
                u.role = role
            ni.last_heard = n["last_heard"][i] & MASK
            ni.hops_away = n["hops_away"][i] & MASK
            ni.snr = n["snr"][i]
        out.append(m.SerializeToString())
    return out


def encode_packets(packets: DataFrame, descriptor_set: bytes, message: str) -> DataFrame:
    """schema.PACKETS -> schema.PACKETS_RAW."""
    ship_package(packets.sparkSession)

    def run(batches):
        cls = message_class(descriptor_set, message)
        d = cls.DESCRIPTOR
        ports = enum_numbers(
            d.fields_by_name["packet"].message_type.fields_by_name["decoded"].message_type,
            "portnum")
        roles = enum_numbers(
            d.fields_by_name["node_info"].message_type.fields_by_name["user"].message_type,
            "role")
        for batch in batches:
            values = _encode_batch(batch, cls, ports, roles)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.binary()),
                 batch.column(batch.schema.get_field_index("timestamp"))],
                names=["value", "timestamp"])

    return (packets.select("timestamp", "variant", "packet", "node_info")
            .mapInArrow(run, S.PACKETS_RAW))
