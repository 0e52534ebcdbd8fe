"""Q1–Q4 — the column tests of the staging and mart models, and freshness.

The test list is the reference's schema tests, stated here as fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from snapmart.operators import quality

# Fixed test spec: model → columns.
NOT_NULL = {
    "stg_rawg_games": ["rawg_game_id", "game_name"],
    "stg_rawg_game_platforms": ["rawg_game_id", "platform_name"],
    "stg_rawg_game_genres": ["rawg_game_id", "genre_name"],
    "stg_steam_featured_games": ["category_name"],
    "stg_raw_load_audit": ["source", "s3_key", "status"],
    "mart_games": ["rawg_game_id", "game_name"],
    "mart_platform_coverage": ["platform_name"],
    "mart_top_rated_games": ["rawg_game_id"],
    "mart_pipeline_load_summary": ["load_date", "source"],
}
UNIQUE = {
    "mart_games": ["rawg_game_id"],
    "mart_platform_coverage": ["platform_name"],
    "mart_top_rated_games": ["rawg_game_id"],
}
FRESHNESS = {"warn_after_days": 2, "error_after_days": 7}


GAME_STAGING = ("stg_rawg_games", "stg_rawg_game_genres", "stg_rawg_game_platforms")


def game_staging_not_null(raw_rawg: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Q1 of the three game staging models (latest snapshot) from one flatten.

    The entries are exploded once into games, genres and platforms and
    deduplicated with the models' own keys (``marts.game_entities``), so the
    NULL counts equal those over each model — one scan instead of three
    (of ``entities``, where a run has them already).
    """
    from pyspark.sql import functions as F

    from snapmart.plans.marts import game_entities

    e = game_entities(raw_rawg, per_snapshot=False, with_fields=False) if entities is None else entities
    kind, gid, name = F.col("kind"), F.col("rawg_game_id"), F.col("name")
    counts = e.agg(*[F.count_if((kind == k) & c.isNull()).cast("bigint").alias(f"{m}|{col}")
                     for k, m, col, c in [(0, "stg_rawg_games", "rawg_game_id", gid),
                                          (0, "stg_rawg_games", "game_name", name),
                                          (1, "stg_rawg_game_genres", "rawg_game_id", gid),
                                          (1, "stg_rawg_game_genres", "genre_name", name),
                                          (2, "stg_rawg_game_platforms", "rawg_game_id", gid),
                                          (2, "stg_rawg_game_platforms", "platform_name", name)]])
    long = counts.unpivot([], counts.columns, "_mc", "failures")
    parts = F.split("_mc", "[|]")
    return long.select(parts[0].alias("model"), parts[1].alias("column_name"), F.lit("not_null").alias("test"),
                       "failures", F.when(F.col("failures") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"))


def not_null_checks(models: dict[str, DataFrame], raw_rawg: DataFrame | None = None, counted: dict | None = None) -> DataFrame:
    """All not_null tests; with ``raw_rawg`` the game staging ones share one flatten, ``counted`` as in ``all_checks``."""
    return _column_checks(models, raw_rawg, counted or {}, {})


def unique_checks(models: dict[str, DataFrame]) -> DataFrame:
    return quality.report(*[quality.unique(models[m], m, c) for m, cols in UNIQUE.items() for c in cols])


def all_checks(models: dict[str, DataFrame], raw_rawg: DataFrame | None = None,
               counted: dict[str, dict[str, dict[str, int]]] | None = None, entities: DataFrame | None = None) -> DataFrame:
    """Every column test; one scan per model, and with ``raw_rawg`` one for all three game staging models.

    ``counted``: model -> test -> column -> failures that were counted while the model was written;
    these tests scan nothing.  ``entities``: the newest snapshot's ``marts.game_entities``, if there already.
    """
    return _column_checks(models, raw_rawg, counted or {}, UNIQUE, entities)


def _column_checks(models: dict[str, DataFrame], raw_rawg: DataFrame | None, counted: dict, unique: dict[str, list[str]],
                   entities: DataFrame | None = None) -> DataFrame:
    shared, parts = raw_rawg is not None, []
    for m, cols in NOT_NULL.items():
        if shared and m in GAME_STAGING:
            continue
        known = counted.get(m, {})
        wanted = {"not_null": cols, "unique": unique.get(m, [])}
        done = [(c, t, known[t][c]) for t, names in wanted.items() for c in names if c in known.get(t, {})]
        nulls, keys = ([c for c in names if c not in known.get(t, {})] for t, names in wanted.items())
        if done:
            parts.append(quality.counted_tests(models[m].sparkSession, m, done))
        if nulls:
            parts.append(quality.column_tests(models[m], m, nulls, keys))
        else:
            parts += [quality.unique(models[m], m, c) for c in keys]
    if shared:
        parts.append(game_staging_not_null(raw_rawg, entities))
    return quality.report(*parts)


def freshness_checks(raws: dict[str, DataFrame], now) -> DataFrame:
    out = None
    for name, raw in raws.items():
        f = quality.freshness(raw, name, now, **FRESHNESS)
        out = f if out is None else out.unionByName(f)
    return out
