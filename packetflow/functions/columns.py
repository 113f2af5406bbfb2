"""Scalar column functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import logging
from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from packetflow.fixed import DEFAULT_CHARSET, UINT32_MASK

log = logging.getLogger(__name__)

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
# Charset names that need no setting of the session.
UTF8_NAMES = {"utf-8", "utf8"}
LATIN1_NAMES = {"iso-8859-1", "iso8859-1", "latin1", "latin-1"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch_ntz() -> Column:
    return F.expr(EPOCH_NTZ)


def unsigned32(c) -> Column:
    """A signed 32-bit node number read as unsigned, widened to BIGINT."""
    return _col(c).cast("bigint").bitwiseAND(F.lit(UINT32_MASK))


def _zone(zone: str | None) -> Column:
    # None means the session zone, the counterpart of the JVM default zone.
    return F.current_timezone() if zone is None else F.lit(zone)


def epoch_seconds_to_local(seconds, zone: str | None = None) -> Column:
    """Epoch seconds -> wall-clock date-time (TIMESTAMP_NTZ) in `zone`.

    The zone is applied, then dropped, as with a local date-time.
    """
    utc_wall = F.timestamp_add("SECOND", _col(seconds).cast("bigint"), _epoch_ntz())
    if zone is not None and zone.upper() in ("UTC", "Z", "+00:00", "GMT"):
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), _zone(zone), utc_wall)


def zero_to_null(c, value: Column) -> Column:
    """`value`, or null where the raw field `c` is zero."""
    return F.when(_col(c) != 0, value)


def local_as_utc_instant(c) -> Column:
    """A wall-clock TIMESTAMP_NTZ read as if it were UTC -> TIMESTAMP.

    Independent of the session zone.
    """
    micros = F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(c))
    return F.timestamp_micros(micros)


def count_as_int(c: Column) -> Column:
    """Narrow a count to INT; under ANSI mode an overflow raises."""
    return c.cast("int")


def iso_local_text(c) -> Column:
    """ISO-8601 text of a local date-time, seconds left out when zero.

    Sub-second digits are left out too: every time here comes from whole
    epoch seconds.
    """
    t = _col(c)
    return (F.when(F.second(t) == 0, F.date_format(t, "yyyy-MM-dd'T'HH:mm"))
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")))


def iso_offset_to_epoch_millis(text: str) -> int:
    """X11: ISO-8601 date-time *with offset* -> epoch milliseconds.

    A constant for the driver to turn into a literal; an offset is required.
    """
    parsed = datetime.fromisoformat(text.replace("Z", "+00:00"))
    if parsed.tzinfo is None:
        raise ValueError(f"date-time without an offset: {text!r}")
    return int(parsed.timestamp() * 1000)


def epoch_millis_literal(millis: int) -> Column:
    return F.timestamp_millis(F.lit(int(millis)))


def is_known_charset(charset: str, spark: SparkSession | None = None) -> bool:
    """Whether the JVM has a charset of this name."""
    spark = spark or SparkSession.active()
    try:
        return bool(spark.sparkContext._jvm.java.nio.charset.Charset.isSupported(charset))
    except IllegalArgumentException:      # not a legal name
        return False


# With these, Spark's decode takes any charset of the JVM and replaces malformed input.
_JVM_DECODE = {"spark.sql.legacy.javaCharsets": "true",
               "spark.sql.legacy.codingErrorAction": "true"}


@contextmanager
def jvm_charsets(spark: SparkSession):
    """Frames built inside use the JVM's charsets; the session's settings are put back after.

    Spark fixes both settings in the expression when a frame is built, so they
    hold wherever that frame runs later.
    """
    before = {k: spark.conf.get(k, None) for k in _JVM_DECODE}
    try:
        for k, v in _JVM_DECODE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def bytes_to_text(c, charset: str = DEFAULT_CHARSET, jvm: bool = False) -> Column:
    """Payload bytes -> text in a named charset of the JVM.

    Malformed input becomes U+FFFD, never an error, if the frame is built
    inside `jvm_charsets` (UTF-8 and ISO-8859-1 need no setting). With `jvm`,
    which needs it for UTF-8 too, as many of them as the JVM puts: one for an
    encoded surrogate, where Spark's own repair of UTF-8 puts three. Raises
    LookupError for an unknown charset (see `operators.messages`).
    """
    name = charset.lower()
    if name in UTF8_NAMES and not jvm:
        return F.make_valid_utf8(_col(c).cast("string"))
    if name in LATIN1_NAMES:
        return F.decode(_col(c), "ISO-8859-1")
    if not is_known_charset(charset):
        raise LookupError(f"unknown charset: {charset}")
    return F.decode(_col(c), charset)
