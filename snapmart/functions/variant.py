"""Typed access into VARIANT payloads (the ``v:a:b::type`` casts of the models).

``strict=True`` (default) raises on a value that cannot be converted, like the
warehouse cast; ``strict=False`` yields NULL instead.  A missing key and a JSON
null both give SQL NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def vpath(v, path: str, type_: str = "variant", strict: bool = True) -> Column:
    col = F.col(v) if isinstance(v, str) else v
    fn = F.variant_get if strict else F.try_variant_get
    return fn(col, path, type_)


def as_number(v, path: str, strict: bool = True) -> Column:
    """``::number``: go through decimal(38,0) so 2.5 rounds to 3 as in the warehouse."""
    return vpath(v, path, "decimal(38,0)", strict).cast("bigint")


def as_string(v, path: str, strict: bool = True) -> Column:
    return vpath(v, path, "string", strict)


def as_double(v, path: str, strict: bool = True) -> Column:
    return vpath(v, path, "double", strict)


def as_bool(v, path: str, strict: bool = True) -> Column:
    return vpath(v, path, "boolean", strict)


def as_date(v, path: str, strict: bool = True) -> Column:
    return vpath(v, path, "date", strict)


def as_ts_ntz(v, path: str, strict: bool = True) -> Column:
    """Timestamp string without zone → ``timestamp_ntz``."""
    s = vpath(v, path, "string", strict)
    return F.to_timestamp_ntz(s) if strict else F.try_to_timestamp(s).cast("timestamp_ntz")
