from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name) -> Column:
    """``lower(trim(name))`` — trim removes spaces only, as in the warehouse."""
    c = F.col(name) if isinstance(name, str) else name
    return F.lower(F.trim(c))


def sorted_distinct_join(values, sep: str = ", ") -> Column:
    """``listagg(distinct x, sep) within group (order by x)`` as an aggregate.

    ``collect_set`` merges map-side, so each partial holds at most the distinct
    values of a group, never its rows; an all-NULL group gives ``''`` (trap T4).
    """
    c = F.col(values) if isinstance(values, str) else values
    return F.array_join(F.array_sort(F.collect_set(c)), sep)
