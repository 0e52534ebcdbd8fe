"""A2–A8 — the grouped rollups of the marts.

All are single hash aggregates with a map-side partial step.  Distinct counts
are taken as ``size(collect_set(x))`` beside the list built from the same set,
so no second distinct aggregate (and no Expand) is planned (trap T3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.text import name_key, sorted_distinct_join

# Columns of the store rollup keyed by normalized name (output name ← input).
STORE_ROLLUP_COLUMNS = [
    ("steam_app_id", "steam_app_id"),
    ("steam_category_name", "category_name"),
    ("is_discounted_on_steam", "is_discounted"),
    ("steam_discount_percent", "discount_percent"),
    ("steam_final_price_usd", "final_price_usd"),
    ("steam_windows_available", "windows_available"),
    ("steam_mac_available", "mac_available"),
    ("steam_linux_available", "linux_available"),
]


def name_rollup(offers: DataFrame, by: list[str] | None = None, name_col: str = "game_name",
                key_alias: str = "game_name_key") -> DataFrame:
    """A2: per normalized name, the max of each column independently (trap T5)."""
    by = by or []
    return (offers.where(F.col(name_col).isNotNull())
            .groupBy(*by, name_key(name_col).alias(key_alias))
            .agg(*[F.max(src).alias(out) for out, src in STORE_ROLLUP_COLUMNS]))


def listagg_rollup(df: DataFrame, keys: list[str], value: str, alias: str, sep: str = ", ") -> DataFrame:
    """A3: distinct values per group, sorted and joined."""
    return df.groupBy(*keys).agg(sorted_distinct_join(value, sep).alias(alias))


def count_and_list(df: DataFrame, keys: list[str], value: str, count_alias: str, list_alias: str,
                   sep: str = ", ") -> DataFrame:
    """A4+A5: distinct count and distinct sorted list from one set per group."""
    s = F.array_sort(F.collect_set(value))
    return (df.groupBy(*keys).agg(s.alias("_set"))
            .select(*keys, F.size("_set").cast("bigint").alias(count_alias),
                    F.array_join("_set", sep).alias(list_alias)))
