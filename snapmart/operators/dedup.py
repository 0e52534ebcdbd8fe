"""W1–W3/W5 — keep the first row per key (``qualify row_number() … = 1``).

The ``row_number`` filter is planned as a ``WindowGroupLimit`` before the
exchange, so a key holding a huge share of the rows is cut to one row per map
task before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    part = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def keep_top(df: DataFrame, keys: list, order: list[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per key (head-N per group), optionally keeping the rank."""
    part = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*part).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)
