"""J2–J4/J6 — enrichment joins and the already-loaded anti-match.

No join here carries a broadcast hint: the right sides are rollups whose size
grows with the data, so the choice is left to AQE, which broadcasts only when
the measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls
back to a shuffle join (with skew splitting) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.text import name_key


def left_join_on_name(left: DataFrame, right: DataFrame, name_col: str, key_col: str,
                      extra_keys: list[str] | None = None) -> DataFrame:
    """``lower(trim(left.name)) = right.key``; the right side is unique per key.

    A NULL name matches nothing, so all such rows would crowd one join key for no
    result: they get a key per row content instead, under a flag no right row has.
    """
    extra_keys = extra_keys or []
    lk, nn = "_name_key", "_named"
    key = name_key(name_col)
    spread = F.hex(F.xxhash64(*[F.col(c) for c in left.columns if c not in extra_keys]))
    l2 = left.withColumn(lk, F.coalesce(key, spread)).withColumn(nn, key.isNotNull())
    r2 = right.withColumnRenamed(key_col, lk).withColumn(nn, F.lit(True))
    return l2.join(r2, on=[*extra_keys, lk, nn], how="left").drop(lk, nn)


def enrich(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """1:0..1 left join on ids."""
    return left.join(right, on=keys, how="left")


LOADED = "loaded"


def not_yet_loaded(candidates: DataFrame, audit: DataFrame,
                   keys: tuple[str, ...] = ("source", "s3_key", "target_table")) -> DataFrame:
    """Candidates with no ``loaded`` audit row on all keys (set-wise)."""
    done = audit.where(F.col("status") == LOADED).select(*keys)
    return candidates.join(done, on=list(keys), how="left_anti")
