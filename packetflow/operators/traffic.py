"""Packet traffic: packets per (sender, receiver, payload kind) per window.

P1 payload kind, P2 node context, W3 tumbling window, A1 count, P8 output row.
Same function for batch and streaming frames. The count is an algebraic
aggregate, so Spark runs it as partial + final HashAggregate: each task
pre-aggregates before the one shuffle on the group key, and a hot
(sender, receiver, kind) key costs one row per task, not its packet count.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.fixed import DEFAULT_WINDOW_MINUTES, ENCRYPTED_KIND as ENCRYPTED
from packetflow.functions.columns import count_as_int, unsigned32
from packetflow.operators.filters import keep_packets


def new_job_id() -> str:
    """A 32-hex id stamped on every output row of one run."""
    return uuid.uuid4().hex


def payload_kind(packet: str = "packet") -> Column:
    """P1: "ENCRYPTED", else the decoded port name, else "" (never null)."""
    p = F.col(packet)
    return (F.when(p["encrypted"], F.lit(ENCRYPTED))
            .when(p["decoded"], p["portnum"])
            .otherwise(F.lit("")))


def node_context(packets: DataFrame) -> DataFrame:
    """F1 + P2: (timestamp, from_node, to_node, kind) per radio packet."""
    p = F.col("packet")
    return keep_packets(packets).select(
        "timestamp",
        unsigned32(p["from"]).alias("from_node"),
        unsigned32(p["to"]).alias("to_node"),
        payload_kind().alias("kind"))


def packet_traffic(packets: DataFrame, window_minutes: int = DEFAULT_WINDOW_MINUTES,
                   job_id: str | None = None) -> DataFrame:
    """J1 core: count packets per (from, to, kind) in tumbling event-time windows.

    Windows are epoch-aligned, [start, end). On a stream, set the watermark on
    `timestamp` before calling (see streaming.watermark) and write in append
    mode: each window is emitted once, when the watermark passes its end.
    """
    if window_minutes <= 0:
        raise ValueError("window_minutes must be positive")
    job_id = job_id or new_job_id()
    ctx = node_context(packets)
    window = F.window("timestamp", f"{int(window_minutes)} minutes")
    counted = (ctx.groupBy(window.alias("window"), "from_node", "to_node", "kind")
               .agg(count_as_int(F.count(F.lit(1))).alias("packet_count")))
    return counted.select(
        "from_node", "to_node", "packet_count",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "kind",
        F.lit(job_id).alias("job_id"))
