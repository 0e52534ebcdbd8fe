"""U1–U3/J5 — lateral flatten of a VARIANT array.

Inner semantics: an empty array, an empty object, a scalar, JSON null and a
missing path all yield no row.  Implemented as a lateral join with the
``variant_explode`` table function, which Catalyst turns into a ``Generate``
inside the same stage (no join, no shuffle).  Output columns are named
explicitly, so two flattens in a row never produce an ambiguous ``key``/``value``
(trap T18).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, variant_col: str, path: str | None, alias: str,
            keep: list[str] | None = None, outer: bool = False) -> DataFrame:
    """Explode ``variant_col[path]`` into rows ``keep… , {alias}_pos, {alias}``."""
    spark = df.sparkSession
    src = F.col(variant_col).outer()
    if path:
        src = F.variant_get(src, path, "variant")
    tvf = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    gen = tvf(src).alias(f"_{alias}_gen")
    cols = keep if keep is not None else df.columns
    joined = df.alias("_outer").lateralJoin(gen)
    return joined.select(
        *[F.col(f"_outer.{c}").alias(c) for c in cols],
        F.col(f"_{alias}_gen.pos").alias(f"{alias}_pos"),
        F.col(f"_{alias}_gen.value").alias(alias),
    )
