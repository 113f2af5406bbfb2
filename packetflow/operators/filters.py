"""Keep one envelope variant / text-message packets.

On a streaming frame a predicate that does not mention the event-time column
is pushed below the watermark by Catalyst, and filtered-out packets then no
longer advance it (the reference assigns the watermark at the source, before
any filter). `event_time_safe` wraps the predicate in an expression that reads
the event time, so it stays above the watermark and every packet still moves
event time forward.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetflow.fixed import TEXT_MESSAGE_PORT as TEXT_PORT

_NEVER_BEFORE = -(2 ** 62)  # micros; every real event time is after this


def event_time_safe(predicate: Column, event_time: str = "timestamp") -> Column:
    """`predicate`, in a form that keeps a streaming filter above the watermark."""
    return (F.when(F.unix_micros(F.col(event_time)) > F.lit(_NEVER_BEFORE), predicate)
            .otherwise(F.lit(False)))


def _keep(df: DataFrame, predicate: Column) -> DataFrame:
    if df.isStreaming:
        predicate = event_time_safe(predicate)
    return df.where(predicate)


def is_variant(variant: str) -> Column:
    return F.col("variant") == F.lit(variant)


def is_text_message() -> Column:
    # An encrypted packet has no decoded port, so it never matches.
    p = F.col("packet")
    return (is_variant("packet") & p["decoded"]) & (p["portnum"] == F.lit(TEXT_PORT))


def keep_packets(df: DataFrame) -> DataFrame:
    """envelopes that carry a radio packet."""
    return _keep(df, is_variant("packet"))


def keep_node_info(df: DataFrame) -> DataFrame:
    """envelopes that carry node information."""
    return _keep(df, is_variant("node_info"))


def keep_text_messages(df: DataFrame) -> DataFrame:
    """decoded packets on the text-message port."""
    return _keep(df, is_text_message())
