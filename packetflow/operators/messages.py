"""Text messages: decoded text rows, notification payloads and audit lines.

F3 filter, P4 text row, P5 drop-on-error, P6 notification, P7 audit line.
All narrow projections. The reference keys this stream by sender only to run
a per-record function with no state; a column needs no shuffle here.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetflow import schema as S
from packetflow.fixed import (
    AUDIT_FORMAT,
    DEFAULT_CHARSET,
    MESSAGE_FORMAT,
    PRIORITY,
    TITLE_FORMAT,
)
from packetflow.functions.columns import (
    bytes_to_text,
    epoch_seconds_to_local,
    is_known_charset,
    iso_local_text,
    jvm_charsets,
    unsigned32,
)
from packetflow.operators.filters import keep_text_messages
from packetflow.operators.traffic import new_job_id

log = logging.getLogger(__name__)


def text_messages(packets: DataFrame, charset: str = DEFAULT_CHARSET, zone: str | None = None,
                  job_id: str | None = None, record_time: bool = False) -> DataFrame:
    """J3 core: one row per text-message packet, in schema.TEXT_MESSAGES.

    `record_time` adds that column after the others, for delivery in order.

    `time` is the packet's receive time as a local date-time in `zone`
    (default: session zone). Undecodable bytes become U+FFFD. An unknown
    charset makes every row fail to build: like the reference, the rows are
    dropped with a warning rather than failing the job (P5).
    """
    job_id = job_id or new_job_id()
    texts = keep_text_messages(packets)
    spark = packets.sparkSession
    if not is_known_charset(charset, spark):
        log.warning("no text rows: the charset %r is not known", charset)
        texts = texts.where(F.lit(False))
        charset = "utf-8"
    p = F.col("packet")
    with jvm_charsets(spark):
        rows = texts.select(
            unsigned32(p["from"]).alias("from_node"),
            unsigned32(p["to"]).alias("to_node"),
            epoch_seconds_to_local(p["rx_time"], zone).alias("time"),
            p["channel"].alias("channel"),
            bytes_to_text(p["payload"], charset, jvm=True).alias("text"),
            F.lit(job_id).alias("job_id"),
            *([F.col("timestamp").alias("record_time")] if record_time else []))
    if record_time:
        return rows.to(T.StructType([*S.TEXT_MESSAGES.fields,
                                     T.StructField("record_time", T.TimestampType(), True)]))
    return rows.to(S.TEXT_MESSAGES)


def notifications(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Title, message and priority of the notification for each text row, after `keep`."""
    return messages.select(
        *keep,
        F.format_string(TITLE_FORMAT, "from_node", "channel").alias("title"),
        F.format_string(MESSAGE_FORMAT, iso_local_text("time"), F.col("text")).alias("message"),
        F.lit(PRIORITY).cast("int").alias("priority"))


def notification_json(notes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The pretty-printed JSON body sent to the webhook, one per row, after `keep`."""
    return notes.select(
        *keep,
        F.to_json(F.struct("title", "message", "priority"), {"pretty": "true"}).alias("body"))


def audit_lines(messages: DataFrame) -> DataFrame:
    """The reference's audit line per text row ("form" is literal)."""
    return messages.select(
        F.format_string(AUDIT_FORMAT, iso_local_text("time"), F.col("from_node"),
                        F.col("channel"), F.col("text")).alias("line"))
