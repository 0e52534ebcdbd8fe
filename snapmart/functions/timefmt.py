"""Time formats of the landing zone and time conversions of the models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats (must match the landing layout exactly):
#   extracted_at_utc  2026-04-01T09:00:00Z
#   extract_date      2026-04-01
#   file stamp        20260401T090000Z
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_DATE = "yyyy-MM-dd"
FILE_STAMP = "yyyyMMdd'T'HHmmss'Z'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_utc(ts) -> Column:
    return F.date_format(_c(ts), ISO_UTC)


def iso_date(ts) -> Column:
    return F.date_format(_c(ts), ISO_DATE)


def file_stamp(ts) -> Column:
    return F.date_format(_c(ts), FILE_STAMP)


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_to_ntz(seconds) -> Column:
    """Integer epoch seconds → ``timestamp_ntz`` (UTC wall time), whatever the session zone."""
    return F.timestamp_add("SECOND", _c(seconds), F.expr(_EPOCH))


def ntz_to_epoch(ts) -> Column:
    """``timestamp_ntz`` read as UTC wall time → integer epoch seconds (zone independent)."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), _c(ts))


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds (double, microsecond precision), zone independent."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def day_start_ntz(ts) -> Column:
    """``date_trunc('day', ts)`` kept as ``timestamp_ntz`` (Spark's returns LTZ)."""
    return F.date_trunc("day", _c(ts)).cast("timestamp_ntz")
