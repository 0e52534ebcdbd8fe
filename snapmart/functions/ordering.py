"""NULL ordering of the source warehouse (trap T1).

The warehouse puts NULLs first under DESC and last under ASC; Spark's defaults are
the reverse.  Every sort in this package spells the NULL position out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def desc_nulls_first(c) -> Column:
    return _col(c).desc_nulls_first()


def asc_nulls_last(c) -> Column:
    return _col(c).asc_nulls_last()
