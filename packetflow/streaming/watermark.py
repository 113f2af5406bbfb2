"""Event time and the bounded-out-of-orderness watermark.

Event time is the record's `timestamp` (the Kafka record time), not the
packet's own receive time. Order matters on a stream:

    decode (mapInArrow)  ->  with_event_time  ->  filters / windows

`mapInArrow` placed after `withWatermark` drops the watermark, and a filter
that does not read the event time is pushed below it (operators.filters
keeps variant filters above it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetflow.fixed import OUT_OF_ORDERNESS as DEFAULT_DELAY


def with_event_time(df: DataFrame, delay: str | None = DEFAULT_DELAY,
                    column: str = "timestamp") -> DataFrame:
    """Use `column` as event time, with a watermark `delay` behind the maximum.

    `withWatermark` rejects TIMESTAMP_NTZ, so such a column is read as a
    TIMESTAMP in the session zone first. `delay=None` skips the watermark
    (batch frames do not need one).
    """
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    if delay is None or not df.isStreaming:
        return df
    return df.withWatermark(column, delay)
