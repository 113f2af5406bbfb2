"""Protobuf message classes from a serialized FileDescriptorSet.

Runs inside Python workers: the class is built once per worker and cached.
"""

from __future__ import annotations

import hashlib

from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

_CLASSES: dict[tuple[str, str], type] = {}


def message_class(descriptor_set: bytes, message: str):
    key = (hashlib.sha1(descriptor_set).hexdigest(), message)
    cls = _CLASSES.get(key)
    if cls is None:
        files = descriptor_pb2.FileDescriptorSet.FromString(descriptor_set)
        pool = descriptor_pool.DescriptorPool()
        pending = list(files.file)
        added: set[str] = set()
        # Add files after their imports, whatever order the set lists them in.
        while pending:
            progress = False
            for f in list(pending):
                if all(d in added for d in f.dependency):
                    pool.Add(f)
                    added.add(f.name)
                    pending.remove(f)
                    progress = True
            if not progress:
                raise ValueError("descriptor set misses imports: "
                                 + ", ".join(d for f in pending for d in f.dependency
                                             if d not in added))
        cls = message_factory.GetMessageClass(pool.FindMessageTypeByName(message))
        _CLASSES[key] = cls
    return cls


def oneof_of(descriptor, member: str) -> str:
    """Name of the one-of group that holds field `member`."""
    field = descriptor.fields_by_name[member]
    if field.containing_oneof is None:
        raise ValueError(f"{descriptor.full_name}.{member} is not in a one-of")
    return field.containing_oneof.name


def enum_names(descriptor, field: str) -> dict[int, str]:
    enum = descriptor.fields_by_name[field].enum_type
    return {v.number: v.name for v in enum.values}


def enum_numbers(descriptor, field: str) -> dict[str, int]:
    enum = descriptor.fields_by_name[field].enum_type
    return {v.name: v.number for v in enum.values}
