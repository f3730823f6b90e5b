"""Timestamp expressions.

Wall-clock columns are ``timestamp_ntz`` and never go through ``timestamp``, so
no result depends on the session's time zone. Epoch numbers read a wall clock as
UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of artifact names and of recorded training times.
SUFFIX_FORMAT = "ddMMyyyyHHmmss"
SUFFIX_LENGTH = 14
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{6})?$"

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def iso_text(ts: Column, fraction: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six digits of the second if asked for."""
    text = ts.cast("timestamp_ntz").cast("string")
    seconds = F.substring(text, 1, 19)
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(seconds, F.lit("."), micros) if fraction else seconds


def time_suffix(ts: Column) -> Column:
    """The wall clock as ``SUFFIX_FORMAT``."""
    parts = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$"
    return F.regexp_replace(iso_text(ts), parts, "$3$2$1$4$5$6")


def parse_suffix(name: Column) -> Column:
    """Time encoded in the last 14 characters of an artifact name, else null."""
    parts = r"^(\d{2})(\d{2})(\d{4})(\d{2})(\d{2})(\d{2})$"
    suffix = F.right(name, F.lit(SUFFIX_LENGTH))
    iso = F.regexp_replace(suffix, parts, "$3-$2-$1 $4:$5:$6")
    return F.when(suffix.rlike(parts), iso.try_cast("timestamp_ntz"))


def parse_iso(text: Column) -> Column:
    """ISO text to timestamp; the fraction is optional, malformed text gives null."""
    return F.when(text.rlike(ISO_PATTERN), text.try_cast("timestamp_ntz"))


def epoch_micros(ts: Column) -> Column:
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86_400
    seconds = seconds + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def epoch_ms(ts: Column) -> Column:
    return F.floor(epoch_micros(ts) / 1000).cast("long")


def from_epoch_micros(micros: Column) -> Column:
    seconds = (micros / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=seconds)


def from_epoch_ms(ms: Column) -> Column:
    return from_epoch_micros(ms * 1000)


def duration_micros(start: Column, end: Column) -> Column:
    return epoch_micros(end) - epoch_micros(start)


def sub_second_nanos(micros: Column) -> Column:
    """Sub-second part of a duration, in ns: the older, partial measure of
    processing time, kept beside the true duration."""
    return F.pmod(micros, F.lit(1_000_000)) * 1000
