"""The protobuf wire format, read in columns: all messages of a batch advance field by field.

A batch's messages lie in one buffer. Each round reads one field of every
message that has any left: tag, then varint, fixed width or length, with numpy
over the whole batch, so that no Python object is made for a message. Field
numbers and types come from the descriptor; fields it doesn't have are skipped.

Messages that need more than that are only pointed out (`Found.odd`), for the
caller to give to the protobuf runtime: malformed bytes, groups, known fields
in another wire type, repeated fields, a sub-message that comes twice (to be
merged), a one-of whose member changes, text that isn't UTF-8. Every
sub-message the descriptor knows is read to its end, wanted or not, so
malformed bytes don't go unnoticed anywhere.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from google.protobuf.descriptor import Descriptor, FieldDescriptor

VARINT, FIXED64, LENGTH, FIXED32 = 0, 1, 2, 5
MAX_NUMBER = (1 << 29) - 1
MAX_DEPTH = 50                 # of sub-messages; deeper ones are left to the runtime
PADDING = 16

_D = FieldDescriptor
_WIRE = {
    **dict.fromkeys((_D.TYPE_INT32, _D.TYPE_INT64, _D.TYPE_UINT32, _D.TYPE_UINT64, _D.TYPE_BOOL,
                     _D.TYPE_ENUM, _D.TYPE_SINT32, _D.TYPE_SINT64), VARINT),
    **dict.fromkeys((_D.TYPE_FIXED64, _D.TYPE_SFIXED64, _D.TYPE_DOUBLE), FIXED64),
    **dict.fromkeys((_D.TYPE_FIXED32, _D.TYPE_SFIXED32, _D.TYPE_FLOAT), FIXED32),
    **dict.fromkeys((_D.TYPE_STRING, _D.TYPE_BYTES, _D.TYPE_MESSAGE), LENGTH),
}

# Names of the fields to keep; those of a sub-message with what to keep of it.
Wanted = Mapping[str, "Wanted | None"]


@dataclass
class _Slot:
    """A field of the descriptor."""

    name: str
    type: int
    wire: int | None               # None: left to the runtime
    oneof: int                     # -1: in none
    enum: frozenset[int] | None    # the numbers of a closed enum
    message: Descriptor | None


class Layout:
    """The fields of a message type, by number."""

    _known: dict[int, tuple[Descriptor, Layout]] = {}

    def __init__(self, d: Descriptor):
        fields = sorted(d.fields, key=lambda f: f.number)
        oneofs = {o.name: i for i, o in enumerate(d.oneofs)}
        self.numbers = np.array([f.number for f in fields] + [2 ** 64 - 1], np.uint64)
        self.slots = [_slot(f, oneofs) for f in fields]
        self.by_name = {s.name: i for i, s in enumerate(self.slots)}
        self.oneofs = oneofs

    @classmethod
    def of(cls, d: Descriptor) -> Layout:
        found = cls._known.get(id(d))
        if found is None:
            found = cls._known[id(d)] = d, cls(d)
        return found[1]


def _slot(f: FieldDescriptor, oneofs: dict[str, int]) -> _Slot:
    closed = f.enum_type is not None and getattr(f.enum_type, "is_closed", True)
    return _Slot(f.name, f.type, None if f.is_repeated else _WIRE.get(f.type),
                 oneofs[f.containing_oneof.name] if f.containing_oneof else -1,
                 frozenset(f.enum_type.values_by_number) if closed else None,
                 f.message_type if f.type == _D.TYPE_MESSAGE else None)


@dataclass
class Found:
    """What was read of some messages of one type, a place each in every array."""

    layout: Layout
    data: np.ndarray
    odd: np.ndarray
    member: np.ndarray                                          # slot of each one-of, or -1
    seen: dict[int, np.ndarray] = field(default_factory=dict)
    value: dict[int, np.ndarray] = field(default_factory=dict)
    span: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    sub: dict[int, tuple[np.ndarray, Found]] = field(default_factory=dict)

    def int32(self, name: str) -> np.ndarray:
        """Low 32 bits of a whole number, signed; 0 where absent."""
        i = self.layout.by_name[name]
        raw = self.value[i]
        if self.layout.slots[i].type in (_D.TYPE_SINT32, _D.TYPE_SINT64):
            raw = (raw >> np.uint64(1)) ^ (~(raw & np.uint64(1)) + np.uint64(1))
        return raw.astype(np.uint32).view(np.int32)

    def float32(self, name: str) -> np.ndarray:
        """A float or double field; 0 where absent."""
        i = self.layout.by_name[name]
        if self.layout.slots[i].type == _D.TYPE_DOUBLE:
            return self.value[i].view(np.float64).astype(np.float32)
        return self.value[i].astype(np.uint32).view(np.float32)

    def bytes(self, name: str, kind: pa.DataType) -> pa.Array:
        """A field of text or bytes; empty where absent."""
        return _gathered(self.data, *self.span[self.layout.by_name[name]], kind)

    def message(self, name: str) -> tuple[np.ndarray, Found] | None:
        """The places that have this sub-message, and what was read of it; None if none has."""
        return self.sub.get(self.layout.by_name[name])

    def which(self, oneof: str) -> np.ndarray:
        """The place in the layout of the member that is set, or -1."""
        return self.member[self.layout.oneofs[oneof]]


def _varints(data: np.ndarray, at: np.ndarray, stop: np.ndarray, longest: int = 10):
    """(value, place after it, whether it is whole and fits) of the varint at each place."""
    byte = data[at]
    value = (byte & 0x7F).astype(np.uint64)
    after = at + 1
    more = np.flatnonzero(byte & 0x80)
    for i in range(1, longest):
        if not len(more):
            break
        byte = data[after[more]]
        value[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(7 * i)
        after[more] += 1
        if i == 9:
            after[more[byte > 1]] = stop[more[byte > 1]] + 1          # over 64 bits
        more = more[(byte & 0x80 > 0) & (after[more] <= stop[more])]
    after[more] = stop[more] + 1                                      # longer than it may be
    return value, after, after <= stop


def _gathered(data: np.ndarray, start: np.ndarray, stop: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The bytes from each start to its stop, as an array of text or bytes."""
    size = stop - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    places = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(kind, len(size), [
        None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[places])])


def _fixed(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    return data[at[:, None] + np.arange(width)].view(f"<u{width}").ravel()


def padded(data: np.ndarray) -> np.ndarray:
    """`data` with room for reads past its end."""
    return np.concatenate((data, np.zeros(PADDING, np.uint8)))


def read(data: np.ndarray, start: np.ndarray, stop: np.ndarray, d: Descriptor,
         wanted: Wanted | None, depth: int = 0) -> Found:
    """Read the messages of type `d` at data[start:stop]; `data` is padded.

    Without `wanted` they are only checked.
    """
    layout, n = Layout.of(d), len(start)
    found = Found(layout, data, np.zeros(n, bool), np.full((len(layout.oneofs), n), -1, np.int16))
    odd, keep = found.odd, wanted if wanted is not None else {}
    for name in keep:
        i = layout.by_name[name]
        found.seen[i] = np.zeros(n, bool)
        if layout.slots[i].wire == LENGTH:
            found.span[i] = np.zeros(n, np.int64), np.zeros(n, np.int64)
        else:
            found.value[i] = np.zeros(n, np.uint64)
    subs: dict[int, list] = {}
    texts: list = []
    if depth > MAX_DEPTH:
        odd[:] = True
    rows = np.flatnonzero((start < stop) & ~odd)
    at = start[rows]
    while len(rows):
        end = stop[rows]
        tag, at, ok = _varints(data, at, end, 5)
        wire, number = (tag & np.uint64(7)).astype(np.int8), tag >> np.uint64(3)
        ok &= (number > 0) & (number <= MAX_NUMBER)
        value, low = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.int64)
        for kind in np.unique(wire[ok]):
            i = np.flatnonzero(ok & (wire == kind))
            if kind == VARINT:
                value[i], at[i], ok[i] = _varints(data, at[i], end[i])
            elif kind == LENGTH:
                size, after, good = _varints(data, at[i], end[i], 5)
                good &= size <= np.maximum(end[i] - after, 0).astype(np.uint64)
                low[i], ok[i] = after, good
                at[i] = after + np.where(good, size, 0).astype(np.int64)
            elif kind in (FIXED32, FIXED64):
                width = 4 if kind == FIXED32 else 8
                ok[i] = at[i] + width <= end[i]
                i = i[ok[i]]
                value[i] = _fixed(data, at[i], width)
                at[i] += width
            else:
                ok[i] = False
        odd[rows[~ok]] = True
        slot = np.searchsorted(layout.numbers, number)
        known = ok & (layout.numbers[slot] == number)
        for s in np.unique(slot[known]).tolist():
            i = np.flatnonzero(known & (slot == s))
            _store(found, s, rows[i], wire[i], value[i], low[i], at[i], wanted is not None, subs, texts)
        left = (at < end) & ~odd[rows]
        rows, at = rows[left], at[left]
    for s, parts in subs.items():
        r, low, high = (np.concatenate(x) for x in zip(*parts))
        fine = ~odd[r]
        r, low, high = r[fine], low[fine], high[fine]
        inner = read(data, low, high, layout.slots[s].message, keep.get(layout.slots[s].name), depth + 1)
        odd[r[inner.odd]] = True
        if layout.slots[s].name in keep and len(r):
            found.sub[s] = r, inner
    if texts:
        _check_texts(found, texts)
    return found


def _store(found: Found, s: int, rows, wire, value, low, high, wanted: bool, subs: dict, texts: list):
    """Put away one field of some messages; a later one replaces an earlier."""
    slot, odd = found.layout.slots[s], found.odd
    if slot.wire is None:
        odd[rows] = True
        return
    odd[rows[wire != slot.wire]] = True
    if slot.enum is not None:
        numbers = value.astype(np.uint32).view(np.int32)
        odd[rows[~np.isin(numbers, list(slot.enum))]] = True
    if wanted and slot.oneof >= 0:
        before = found.member[slot.oneof][rows]
        odd[rows[(before >= 0) & (before != s)]] = True
        found.member[slot.oneof][rows] = s
    if slot.type == _D.TYPE_STRING:
        texts.append((rows, low, high))
    if slot.message is not None:
        subs.setdefault(s, []).append((rows, low, high))
    if s in found.seen:
        if slot.message is not None:
            odd[rows[found.seen[s][rows]]] = True
        found.seen[s][rows] = True
        if s in found.span:
            found.span[s][0][rows], found.span[s][1][rows] = low, high
        else:
            found.value[s][rows] = value


def _check_texts(found: Found, texts: list) -> None:
    """Point out the messages with text that isn't UTF-8."""
    rows, low, high = (np.concatenate(x) for x in zip(*texts))
    rows, low, high = (x[~found.odd[rows]] for x in (rows, low, high))
    if not len(rows):
        return
    try:
        _gathered(found.data, low, high, pa.binary()).cast(pa.string())
        return
    except pa.ArrowInvalid:
        pass
    for i in range(len(rows)):
        try:
            found.data[low[i]:high[i]].tobytes().decode("utf-8")
        except UnicodeDecodeError:
            found.odd[rows[i]] = True
