"""Node info: node-info envelopes flattened to the declared 8-column table.

F2 filter, P3 flatten, Q1 declared schema. A narrow projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.functions.columns import epoch_seconds_to_local, unsigned32, zero_to_null
from packetflow.operators.filters import keep_node_info


def node_info(packets: DataFrame, zone: str | None = None) -> DataFrame:
    """J2 core: one row per node-info envelope, in schema.NODE_INFO.

    Missing user fields read as "" (never null); `last_heard` 0 becomes null,
    any other value the local date-time in `zone` (default: session zone).
    """
    n = F.col("node_info")
    rows = keep_node_info(packets).select(
        unsigned32(n["num"]).alias("node_id"),
        F.coalesce(n["user_id"], F.lit("")).alias("user_id"),
        F.coalesce(n["short_name"], F.lit("")).alias("user_name"),
        F.coalesce(n["long_name"], F.lit("")).alias("user_long_name"),
        F.coalesce(n["role"], F.lit("")).alias("user_role"),
        zero_to_null(n["last_heard"], epoch_seconds_to_local(n["last_heard"], zone))
        .alias("last_heard"),
        n["hops_away"].alias("hops_away"),
        n["snr"].alias("snr"))
    return declared(rows, S.NODE_INFO)


def declared(df: DataFrame, schema) -> DataFrame:
    """Q1: enforce a declared table schema (names, order, types)."""
    return df.to(schema)
