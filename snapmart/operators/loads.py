"""M3–M7 — idempotent loading, forced reloads and the audit trail.

The plan is set-wise: all candidate files of a run are matched against the
audit log in one join, instead of one lookup per file.  Only ``loaded`` rows
count as loaded; a forced run is recorded as ``reloaded`` (trap T7/M4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the raw zone.
SOURCE_TABLES = {"rawg": "RAWG_GAMES_RAW", "steam": "STEAM_GAMES_RAW"}
STATUS_LOADED = "loaded"
STATUS_RELOADED = "reloaded"
STATUS_SKIPPED = "skipped_existing"


def target_table(source) -> Column:
    """Raw table of a source; an unknown source raises (trap T15)."""
    s = F.col(source) if isinstance(source, str) else source
    expr = F.when(s == "rawg", F.lit(SOURCE_TABLES["rawg"])).when(s == "steam", F.lit(SOURCE_TABLES["steam"]))
    return expr.otherwise(F.raise_error(F.concat(F.lit("no raw table is defined for source "), F.coalesce(s, F.lit("NULL")))))


def rows_per_file(raw_rows: DataFrame, file_col: str = "s3_key", by: list[str] | None = None,
                  doc_col: str = "payload") -> DataFrame:
    """M6: rows copied per file (one row per JSON document).

    Counts the document column itself: a JSON ``singleVariantColumn`` scan from
    which the variant is pruned away fails in Spark 4.1, and a non-NULL document
    is exactly what a copy loads.
    """
    by = by or ["source"]
    return raw_rows.groupBy(*by, file_col).agg(F.count(doc_col).alias("rows_loaded"))


def plan_status(candidates: DataFrame, audit: DataFrame, force: bool = False) -> DataFrame:
    """M3/M5: ``target_table`` and ``status`` of every candidate (source, s3_key, …), from the audit log alone."""
    keys = ["source", "s3_key", "target_table"]
    cand = candidates.withColumn("target_table", target_table("source"))
    if force:
        return cand.withColumn("status", F.lit(STATUS_RELOADED))
    done = audit.where(F.col("status") == STATUS_LOADED).select(*keys).distinct().withColumn("_was_loaded", F.lit(True))
    return (cand.join(done, on=keys, how="left")
            .withColumn("status", F.when(F.col("_was_loaded"), F.lit(STATUS_SKIPPED)).otherwise(F.lit(STATUS_LOADED)))
            .drop("_was_loaded"))


def plan_loads(candidates: DataFrame, audit: DataFrame, force: bool = False, loaded_at=None) -> DataFrame:
    """M3+M4+M5: one audit row per candidate file.

    ``candidates``: (source, s3_key, rows_loaded).  Returns the audit rows
    (source, s3_key, target_table, rows_loaded, status, loaded_at).
    """
    j = plan_status(candidates, audit, force)
    rows = F.when(F.col("status") == STATUS_SKIPPED, F.lit(0)).otherwise(F.col("rows_loaded"))
    ts = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    if isinstance(ts, str):
        ts = F.lit(ts).cast("timestamp_ntz")
    return j.select("source", "s3_key", "target_table", rows.cast("bigint").alias("rows_loaded"), "status",
                    ts.alias("loaded_at"))
