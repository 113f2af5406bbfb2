"""Packets from files with the Kafka source's columns (`value`, `timestamp`).

The reference reads only Kafka; a parquet copy with the same two columns
serves tests, replays and streams through the file source. Bounds are either
plain filters on `timestamp`, which Catalyst pushes into the parquet scan, or,
for a copy that also has `partition` and `offset`, ranges of offsets, as a
bounded Kafka read has them (`replay_offsets`). The two differ where record
times don't rise with the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetflow import schema as S
from packetflow.functions.columns import epoch_millis_literal, iso_offset_to_epoch_millis


def _bounds(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("timestamp") >= _instant(start))
    if end is not None:
        df = df.where(F.col("timestamp") < _instant(end))
    return df


def replay_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """S3/S4 for non-Kafka sources: keep `start <= timestamp < end`.

    Bounds are ISO-8601 date-times with an offset, like the reference's
    `source.from_timestamp` / `source.to_timestamp` options.
    """
    return _bounds(df, start, end)


def _instant(text: str) -> Column:
    return epoch_millis_literal(iso_offset_to_epoch_millis(text))


def offset_bounds(packets: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """(partition, first, stop): the offsets of a replay from `start` to `end`, a row a partition.

    `first` is the least offset whose record time is at or after `start`, and
    `stop`, which is not read any more, the least one at or after `end`. A
    partition without a record from `start` on has a null `first` and yields
    nothing; without one from `end` on it is read to its end, with a null `stop`.
    """
    def least_from(text):
        return F.min(F.when(F.col("timestamp") >= _instant(text), F.col("offset")))

    return packets.groupBy("partition").agg(
        (least_from(start) if start is not None else F.min("offset")).alias("first"),
        (least_from(end) if end is not None else F.lit(None).cast("long")).alias("stop"))


def within_offsets(packets: DataFrame, bounds: DataFrame) -> DataFrame:
    """The packets (a batch or a stream) within `offset_bounds`.

    The bounds have a row for each partition of the topic, which are some
    thousands at most, so they are broadcast and the packets aren't shuffled.
    """
    b = F.broadcast(bounds.select(F.col("partition").alias("_of"), "first", "stop"))
    inside = (F.col("offset") >= F.col("first")) & (
        F.col("stop").isNull() | (F.col("offset") < F.col("stop")))
    return packets.join(b, F.col("partition").eqNullSafe(F.col("_of")) & inside).select(*packets.columns)


def replay_offsets(packets: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Of each partition, from the first record at or after `start` up to, and without,
    the first one at or after `end`; records in between count whatever their time.

    `packets` is a batch with `partition`, `offset` and `timestamp`.
    """
    missing = {"partition", "offset"} - set(packets.columns)
    if missing:
        raise ValueError(f"a replay by offsets needs the columns {sorted(missing)}")
    if start is None and end is None:
        return packets
    return within_offsets(packets, offset_bounds(packets, start, end))


def require_value(df: DataFrame) -> DataFrame:
    """A record without a value fails the job (checked when rows are read)."""
    return df.select(
        F.when(F.col("value").isNull(),
               F.raise_error(F.lit("radio packet with a null value"))).otherwise(F.col("value"))
        .alias("value"),
        "timestamp")


def parquet_packets(spark: SparkSession, path: str, start: str | None = None,
                    end: str | None = None, by_offset: bool = False) -> DataFrame:
    """Batch read of raw packets; a bounded replay (runs to completion, W6).

    `by_offset` bounds it as Kafka does; the files then have PACKETS_LOG's columns.
    """
    if by_offset:
        return require_value(replay_offsets(spark.read.schema(S.PACKETS_LOG).parquet(path), start, end))
    return require_value(_bounds(spark.read.schema(S.PACKETS_RAW).parquet(path), start, end))


def parquet_packet_stream(spark: SparkSession, path: str, start: str | None = None,
                          max_files_per_trigger: int | None = None, end: str | None = None,
                          by_offset: bool = False) -> DataFrame:
    """Streaming read of raw packets from a folder of parquet files.

    With `by_offset` the bounds are found in the files that are there now;
    a partition that comes later isn't read.
    """
    schema = S.PACKETS_LOG if by_offset else S.PACKETS_RAW
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    packets = reader.parquet(path)
    if not by_offset:
        return require_value(_bounds(packets, start, end))
    if start is None and end is None:
        return require_value(packets)
    return require_value(within_offsets(packets, offset_bounds(
        spark.read.schema(schema).parquet(path), start, end)))
