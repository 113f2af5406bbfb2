"""Property tests: decode inverts encode; windows follow epoch arithmetic."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from packetflow import schema as S
from packetflow.operators.decode import decode_packets
from packetflow.operators.traffic import packet_traffic
from testbed.descriptors import ENVELOPE, PORT_NUMS, ROLES, fixture_descriptor_set
from testbed.encode import encode_packets
from tests.test_decode import node, packet

INT32 = st.integers(min_value=-(2 ** 31), max_value=2 ** 31 - 1)
T0 = dt.datetime(2024, 1, 1)
SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture,
                                       HealthCheck.too_slow])


@st.composite
def packet_rows(draw):
    kind = draw(st.sampled_from(["encrypted", "decoded", "none"]))
    port = draw(st.sampled_from([p for p, _ in PORT_NUMS])) if kind == "decoded" else "UNKNOWN_APP"
    payload = draw(st.binary(max_size=64)) if kind == "decoded" else b""
    return (T0, "packet", packet(draw(INT32), draw(INT32), encrypted=kind == "encrypted",
                                 decoded=kind == "decoded", portnum=port, payload=payload,
                                 channel=draw(INT32), rx_time=draw(INT32)), None)


@st.composite
def node_rows(draw):
    text = st.text(max_size=12)
    snr = draw(st.floats(width=32, allow_nan=False, allow_infinity=False))
    return (T0, "node_info", None,
            node(draw(INT32), draw(text), draw(text), draw(text),
                 draw(st.sampled_from([r for r, _ in ROLES])), draw(INT32), draw(INT32), snr))


@SLOW
@given(st.lists(st.one_of(packet_rows(), node_rows()), min_size=1, max_size=40))
def test_decode_inverts_encode(spark, rows):
    desc = fixture_descriptor_set()
    src = spark.createDataFrame(rows, S.PACKETS)
    got = decode_packets(encode_packets(src, desc, ENVELOPE), desc, ENVELOPE).collect()
    assert [r.asDict(recursive=True) for r in got] == \
        [r.asDict(recursive=True) for r in src.collect()]


@SLOW
@given(st.lists(st.integers(min_value=0, max_value=10 ** 12), min_size=1, max_size=50),
       st.sampled_from([1, 10, 60, 1440]))
def test_window_start_is_floor_of_epoch(spark, micros, minutes):
    epoch = dt.datetime(1970, 1, 1)
    base = 1_700_000_000_000_000
    times = [epoch + dt.timedelta(microseconds=base + m) for m in micros]
    df = spark.createDataFrame([(t, "packet", packet(1, 2), None) for t in times], S.PACKETS)
    got = {(r.window_start, r.packet_count) for r in packet_traffic(df, minutes, "j").collect()}
    size = minutes * 60 * 1_000_000
    want = {}
    for m in micros:
        start = epoch + dt.timedelta(microseconds=(base + m) // size * size)
        want[start] = want.get(start, 0) + 1
    assert got == set(want.items())
