"""Radio packets from a Kafka topic.

Only the record value and record time are kept (key and headers are
ignored), under the Kafka source's own names `value` and `timestamp`.
Without `end` the source is a stream; with `end` it is a bounded batch read
that runs to completion, so every window is flushed at the end (W6).

The Kafka connector jar must be on the classpath (`spark-sql-kafka-0-10`).
"""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession

from packetflow.functions.columns import iso_offset_to_epoch_millis
from packetflow.sources.files import require_value

log = logging.getLogger(__name__)

from packetflow.fixed import GROUP_ID_KEY as GROUP_ID

# Properties that Spark's Kafka source sets itself and refuses from the caller.
REFUSED = frozenset({"auto.offset.reset", "enable.auto.commit", "key.deserializer",
                     "value.deserializer", "key.serializer", "value.serializer",
                     "interceptor.classes"})

_KEY = re.compile(r"(?:\\.|[^\\=:\s])*")
_SEPARATOR = re.compile(r"[ \t\f]*[=:]?[ \t\f]*")
_ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|.)", re.DOTALL)
_CONTROLS = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}


def _logical_lines(text: str):
    """Lines without comments and blanks, those that end in an odd number of backslashes joined."""
    held = ""
    for raw in re.split(r"\r\n|\r|\n", text or ""):
        line = raw.lstrip(" \t\f")
        if not held and (not line or line[0] in "#!"):
            continue
        held += line
        if (len(held) - len(held.rstrip("\\"))) % 2:
            held = held[:-1]
            continue
        yield held
        held = ""
    if held:
        yield held


def _unescaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if len(m[1]) == 5
                       else _CONTROLS.get(m[1], m[1]), text)


def parse_properties(text: str) -> dict[str, str]:
    """The Java properties format: `k=v`, `k: v` or `k v`, comments, continued lines, escapes."""
    props: dict[str, str] = {}
    for line in _logical_lines(text):
        key = _KEY.match(line)
        value = line[_SEPARATOR.match(line, key.end()).end():]
        props[_unescaped(key[0])] = _unescaped(value)
    return props


def client_properties(properties: str | dict, job_kind: str | None = None) -> dict[str, str]:
    """Client properties; a set `group.id` gets `-<job_kind>` appended."""
    props = dict(parse_properties(properties) if isinstance(properties, str) else properties)
    if job_kind and props.get(GROUP_ID) is not None:
        props[GROUP_ID] = f"{props[GROUP_ID]}-{job_kind}"
        log.info("consumer group of this job: %s", props[GROUP_ID])
    return props


def kafka_options(topic: str, properties: str | dict, job_kind: str | None = None,
                  start: str | None = None, end: str | None = None,
                  max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of Spark's Kafka source for the reference's source settings.

    `start` / `end` are ISO-8601 date-times with offset (S3/S4). Without a
    start the whole topic is read (Spark streams default to the latest).
    `max_offsets_per_trigger` bounds a micro-batch; `min_partitions` splits
    large topic partitions over more tasks (decode parallelism).
    """
    opts = {"subscribe": topic}
    for key, value in client_properties(properties, job_kind).items():
        if key in REFUSED:
            log.warning("client property %s is left out: Spark's Kafka source sets it itself", key)
        else:
            opts[f"kafka.{key}"] = value
    if start is not None:
        opts["startingTimestamp"] = str(iso_offset_to_epoch_millis(start))
        # Partitions without a record at/after the start begin at their end.
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        opts["startingOffsets"] = "earliest"
    if end is not None:
        opts["endingTimestamp"] = str(iso_offset_to_epoch_millis(end))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def kafka_packets(spark: SparkSession, topic: str, properties: str | dict,
                  job_kind: str | None = None, start: str | None = None,
                  end: str | None = None, **scale) -> DataFrame:
    """`value BINARY, timestamp TIMESTAMP` from one topic."""
    opts = kafka_options(topic, properties, job_kind, start, end, **scale)
    reader = spark.read if end is not None else spark.readStream
    df = reader.format("kafka").options(**opts).load()
    return require_value(df.select("value", "timestamp"))
