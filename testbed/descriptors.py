"""A protobuf schema for test packets.

The real radio schema is an outside artifact; the decoder only depends on
field *names*, so fixtures use a small schema of their own with field
numbers of our choosing. Users pass their own serialized FileDescriptorSet.
"""

from __future__ import annotations

from functools import lru_cache

from google.protobuf import descriptor_pb2

FDP = descriptor_pb2.FieldDescriptorProto

# Enum names the fixtures use (zero value first); FIXTURES.md, not the reference.
PORT_NUMS = [("UNKNOWN_APP", 0), ("TEXT_MESSAGE_APP", 1), ("PORT_A", 64)]
ROLES = [("CLIENT", 0), ("AUTOMOBILE", 1), ("BUILDING", 2), ("FURNITURE", 3),
         ("HOUSEHOLD", 4), ("MACHINERY", 5)]
PACKAGE = "packetflow.fixture"
ENVELOPE = f"{PACKAGE}.Envelope"


def _field(msg, name, number, ftype, type_name=None, oneof=None):
    f = msg.field.add(name=name, number=number, type=ftype, label=FDP.LABEL_OPTIONAL)
    if type_name:
        f.type_name = f".{PACKAGE}.{type_name}"
    if oneof is not None:
        f.oneof_index = oneof
    return f


def _enum(file, name, values):
    e = file.enum_type.add(name=name)
    for value_name, number in values:
        e.value.add(name=value_name, number=number)


@lru_cache(maxsize=1)
def fixture_descriptor_set() -> bytes:
    """Serialized FileDescriptorSet with message `packetflow.fixture.Envelope`."""
    f = descriptor_pb2.FileDescriptorProto(name="packetflow_fixture.proto",
                                           package=PACKAGE, syntax="proto3")
    _enum(f, "PortNum", PORT_NUMS)
    _enum(f, "Role", ROLES)

    data = f.message_type.add(name="Data")
    _field(data, "portnum", 3, FDP.TYPE_ENUM, "PortNum")
    _field(data, "payload", 5, FDP.TYPE_BYTES)

    pkt = f.message_type.add(name="RadioPacket")
    pkt.oneof_decl.add(name="body")
    _field(pkt, "from", 11, FDP.TYPE_FIXED32)
    _field(pkt, "to", 12, FDP.TYPE_FIXED32)
    _field(pkt, "channel", 13, FDP.TYPE_UINT32)
    _field(pkt, "decoded", 20, FDP.TYPE_MESSAGE, "Data", oneof=0)
    _field(pkt, "encrypted", 21, FDP.TYPE_BYTES, oneof=0)
    _field(pkt, "rx_time", 14, FDP.TYPE_FIXED32)

    user = f.message_type.add(name="User")
    _field(user, "id", 1, FDP.TYPE_STRING)
    _field(user, "long_name", 2, FDP.TYPE_STRING)
    _field(user, "short_name", 3, FDP.TYPE_STRING)
    _field(user, "role", 9, FDP.TYPE_ENUM, "Role")

    node = f.message_type.add(name="NodeInfo")
    _field(node, "num", 1, FDP.TYPE_UINT32)
    _field(node, "user", 2, FDP.TYPE_MESSAGE, "User")
    _field(node, "snr", 6, FDP.TYPE_FLOAT)
    _field(node, "last_heard", 7, FDP.TYPE_FIXED32)
    _field(node, "hops_away", 8, FDP.TYPE_UINT32)

    env = f.message_type.add(name="Envelope")
    env.oneof_decl.add(name="variant")
    _field(env, "id", 1, FDP.TYPE_UINT32)
    _field(env, "packet", 7, FDP.TYPE_MESSAGE, "RadioPacket", oneof=0)
    _field(env, "node_info", 8, FDP.TYPE_MESSAGE, "NodeInfo", oneof=0)
    _field(env, "note", 9, FDP.TYPE_STRING, oneof=0)

    return descriptor_pb2.FileDescriptorSet(file=[f]).SerializeToString()
