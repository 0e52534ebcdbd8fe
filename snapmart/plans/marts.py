"""C6–C9 — the marts, plus the accumulating game mart (M2).

``mart_games`` takes the four staging relations.  With ``per_snapshot=True`` the
staging relations carry every snapshot and all rollups and joins are keyed by
time as well: a game snapshot reads the store snapshot that the last run using
it would read (``store_times``).  ``accumulated_mart_games`` then folds the per-run
outputs the way the incremental merge accumulates them run after run;
``accumulated_games_fused`` gives the same rows folding first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.functions.ordering import asc_nulls_last, desc_nulls_first
from snapmart.functions.timefmt import day_start_ntz
from snapmart.operators.joins import enrich, left_join_on_name
from snapmart.operators.merge import fold_latest
from snapmart.operators.rollup import count_and_list, listagg_rollup, name_rollup

TOP_RATED_COLUMNS = [
    "rawg_game_id", "game_name", "released_date", "rating", "ratings_count", "reviews_count", "metacritic_score",
    "genres", "platform_count", "platforms", "steam_app_id", "is_discounted_on_steam", "steam_discount_percent",
    "steam_final_price_usd",
]


def mart_games(games: DataFrame, genres: DataFrame, platforms: DataFrame, offers: DataFrame,
               per_snapshot: bool = False, times: DataFrame | None = None) -> DataFrame:
    """Games ⟕ store rollup by normalized name ⟕ genre list ⟕ platform count/list.

    ``times``: see ``mart_games_fused``.
    """
    run = ["extracted_at_utc"] if per_snapshot else []
    if per_snapshot:
        if times is None:
            times = store_times(games.select(F.col("extracted_at_utc").alias("t")),
                                offers.select(F.col("extracted_at_utc").alias("t")))
        games = games.join(times, "extracted_at_utc", "left")
    genre_r = listagg_rollup(genres, [*run, "rawg_game_id"], "genre_name", "genres")
    plat_r = count_and_list(platforms, [*run, "rawg_game_id"], "platform_name", "platform_count", "platforms")
    j = enrich(games, genre_r, [*run, "rawg_game_id"])
    j = enrich(j, plat_r, [*run, "rawg_game_id"])
    return _with_store(j, offers, per_snapshot)


def _with_store(games: DataFrame, offers: DataFrame, per_snapshot: bool) -> DataFrame:
    """Join the store rollup by name (and ``store_at``, the store snapshot a game row reads) and give the mart's columns."""
    if per_snapshot:
        store = name_rollup(offers, by=["extracted_at_utc"]).withColumnRenamed("extracted_at_utc", "store_at")
    else:
        store = name_rollup(offers)
    j = left_join_on_name(games, store, "game_name", "game_name_key", extra_keys=["store_at"] if per_snapshot else [])
    return j.select(
        "rawg_game_id", "slug", "game_name", "released_date", "is_tba", "rating", "ratings_count", "reviews_count",
        "metacritic_score", "added_count", "playtime_hours",
        F.coalesce(F.col("genres"), F.lit("Unknown")).alias("genres"),
        F.coalesce(F.col("platform_count"), F.lit(0).cast("bigint")).alias("platform_count"),
        "platforms", "steam_app_id", "steam_category_name", "is_discounted_on_steam", "steam_discount_percent",
        "steam_final_price_usd", "steam_windows_available", "steam_mac_available", "steam_linux_available",
        "extracted_at_utc",
    )


def store_times(game_times: DataFrame, store_times: DataFrame) -> DataFrame:
    """Per game snapshot (``extracted_at_utc``) the store snapshot ``store_at`` that its rows end up with.

    A run happens at every snapshot time of either source and reads the newest
    snapshot of each.  A game snapshot is last merged by the last run before the next
    game snapshot, so its rows end with the newest store snapshot before that one
    (none: NULL).  One row per snapshot; the windows run over these few rows only.
    """
    all_times = (game_times.select("t", F.lit(True).alias("is_game")).distinct()
                 .unionByName(store_times.select("t", F.lit(False).alias("is_game")).distinct()))
    runs = all_times.groupBy("t").agg(F.max(F.when(F.col("is_game"), F.col("t"))).alias("g"),
                                      F.max(F.when(~F.col("is_game"), F.col("t"))).alias("s"))
    so_far = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = runs.select(F.max("g").over(so_far).alias("extracted_at_utc"), F.max("s").over(so_far).alias("store_at"))
    return at.where(F.col("extracted_at_utc").isNotNull()).groupBy("extracted_at_utc").agg(F.max("store_at").alias("store_at"))


def accumulated_mart_games(per_run_mart: DataFrame) -> DataFrame:
    """M2: the merged mart after every run — latest run's row per game id."""
    return fold_latest(per_run_mart, "rawg_game_id", [F.col("extracted_at_utc").desc_nulls_first()],
                       null_key_by=["extracted_at_utc"])


def mart_platform_coverage(platforms: DataFrame, sort: bool = True) -> DataFrame:
    """Games per platform, share with a platform release date, latest extract."""
    out = platforms.groupBy("platform_name").agg(
        F.count_distinct("rawg_game_id").alias("game_count"),
        F.avg(F.when(F.col("released_at").isNotNull(), F.lit(1)).otherwise(F.lit(0))).alias(
            "pct_with_platform_release_date"),
        F.max("extracted_at_utc").alias("latest_extract_at_utc"),
    )
    return out.orderBy(desc_nulls_first("game_count"), asc_nulls_last("platform_name")) if sort else out


def mart_top_rated_games(mart: DataFrame, n: int = 25) -> DataFrame:
    """Top ``n`` rated games; warehouse NULL order, id as the final tie-break."""
    order = [desc_nulls_first("rating"), desc_nulls_first("ratings_count"), desc_nulls_first("reviews_count"),
             asc_nulls_last("game_name"), asc_nulls_last("rawg_game_id")]
    return mart.where(F.col("rating").isNotNull()).orderBy(*order).limit(n).select(*TOP_RATED_COLUMNS)


def mart_pipeline_load_summary(audit: DataFrame, sort: bool = True) -> DataFrame:
    """Attempts, successes, skips, rows and latest load per (day, source, table)."""
    out = audit.groupBy(day_start_ntz("loaded_at").alias("load_date"), "source", "target_table").agg(
        F.count(F.lit(1)).alias("load_attempts"),
        F.sum(F.when(F.col("status") == "loaded", 1).otherwise(0)).cast("bigint").alias("successful_loads"),
        F.sum(F.when(F.col("status") == "skipped_existing", 1).otherwise(0)).cast("bigint").alias(
            "skipped_existing_loads"),
        F.sum("rows_loaded").cast("bigint").alias("total_rows_loaded"),
        F.max("loaded_at").alias("latest_loaded_at"),
    )
    if sort:
        out = out.orderBy(desc_nulls_first("load_date"), asc_nulls_last("source"), asc_nulls_last("target_table"))
    return out


def games_fused(raw_rawg: DataFrame, per_snapshot: bool = True, fold_first: bool = False, entities: DataFrame | None = None) -> DataFrame:
    """The game side of C6 in one pass over the game raw table: one row per (run and) game.

    The three game staging models read the same flattened entries.  Here each
    entry is exploded once into the game itself (kind 0), its genres (kind 1)
    and its platforms (kind 2); one ``row_number`` window deduplicates all three
    (key: kind, run, game, child id — the keys of the three models), and one
    aggregate per (run, game) yields the game columns, the genre set and the
    platform count/list.  A NULL game id matches no child (the models join on
    equality), so children without one are dropped.

    ``fold_first`` keeps only the entries of each game's last run before anything is
    exploded: what the merges of all runs leave, at the cost of one run's entries.

    ``entities``: those of ``game_entities`` with these arguments, where they are there already.
    """
    dedup = game_entities(raw_rawg, per_snapshot, fold_first) if entities is None else entities
    dedup = dedup.where((F.col("kind") == 0) | F.col("rawg_game_id").isNotNull())
    is_game = F.col("kind") == 0
    slug, *rest = [F.col(f"game.{c}") for c in GAME_FIELDS]
    game = F.struct(slug, F.col("name").alias("game_name"), *rest)
    run = ["extracted_at"] if per_snapshot else []
    agg = dedup.groupBy(*run, "rawg_game_id").agg(
        F.max(F.when(is_game, game)).alias("g"),
        F.max(F.when(is_game, F.col("extracted_at"))).alias("extracted_at_utc"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == 1, F.col("name")))).alias("genre_set"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == 2, F.col("name")))).alias("_plats"),
        F.max(F.col("kind") == 1).alias("_has_genre"), F.max(F.col("kind") == 2).alias("_has_plat"))
    return agg.where(F.col("g").isNotNull()).select(
        "rawg_game_id", "g.*", "extracted_at_utc",
        F.when(F.col("_has_genre"), F.col("genre_set")).alias("genre_set"),
        F.when(F.col("_has_genre"), F.array_join("genre_set", ", ")).alias("genres"),
        F.when(F.col("_has_plat"), F.size("_plats").cast("bigint")).alias("platform_count"),
        F.when(F.col("_has_plat"), F.array_join("_plats", ", ")).alias("platforms"))


def mart_games_fused(raw_rawg: DataFrame, offers: DataFrame, per_snapshot: bool = True, fold_first: bool = False,
                     times: DataFrame | None = None, entities: DataFrame | None = None) -> DataFrame:
    """C6 from ``games_fused`` (same rows as ``mart_games``).

    With ``per_snapshot``, ``offers`` holds every store snapshot and ``times`` says which
    one a game snapshot reads (``store_times`` of the raw tables: a snapshot without items
    counts too; by default taken from the offers, which do not show such a one).
    """
    games = games_fused(raw_rawg, per_snapshot, fold_first, entities)
    if per_snapshot:
        if times is None:
            times = store_times(raw_rawg.select(F.col("extracted_at").alias("t")),
                                offers.select(F.col("extracted_at_utc").alias("t")))
        games = games.join(times, "extracted_at_utc", "left")
    return _with_store(games, offers, per_snapshot)


def raw_store_times(raw_rawg: DataFrame, raw_steam: DataFrame) -> DataFrame:
    """``store_times`` of the snapshots in the raw tables."""
    return store_times(raw_rawg.select(F.col("extracted_at").alias("t")), raw_steam.select(F.col("extracted_at").alias("t")))


def accumulated_games_fused(raw_rawg: DataFrame, raw_steam: DataFrame) -> DataFrame:
    """The merged mart after every run, folding first (same rows as ``accumulated_mart_games`` of the per-run mart)."""
    from snapmart.plans import staging
    return mart_games_fused(raw_rawg, staging.stg_steam_featured_games(raw_steam, per_snapshot=True), per_snapshot=True,
                            fold_first=True, times=raw_store_times(raw_rawg, raw_steam))


def last_run_entries(raw_rawg: DataFrame, flat: DataFrame) -> DataFrame:
    """The entries of each game's last run; games without an id are merged anew by every run, so each run keeps its own.

    An entry of the newest run (a NULL time is the newest) stays as it is, so only the games that are gone from it must
    be known: they are found from ids and times alone and written, so that their size is known when the join
    is planned, and no entry is sorted or shuffled for it unless they exceed the session's limit for broadcasts.
    """
    from snapmart.session import fresh_dir

    spark, t = flat.sparkSession, F.col("extracted_at")
    first, newest, timeless = raw_rawg.agg(F.min(t).cast("string"), F.max(t).cast("string"), F.count_if(t.isNull())).first()
    if newest is None or (first == newest and not timeless):
        return flat
    ids = flat.where(F.col("rawg_game_id").isNotNull()).select(F.col("rawg_game_id").alias("_id"), "extracted_at")
    last = ids.groupBy("_id").agg(F.max(t).alias("_last"), F.count_if(t.isNull()).alias("_timeless"))
    at = F.lit(None if timeless else newest).cast("timestamp_ntz")
    path = fresh_dir(spark, "gone-games")
    last.where((F.col("_timeless") == 0) & ~F.col("_last").eqNullSafe(at)).select("_id", "_last").write.parquet(path)
    gone = spark.read.parquet(path)
    known = flat.join(gone, (F.col("rawg_game_id") == F.col("_id")) & (t == F.col("_last")), "left")
    return known.where(t.eqNullSafe(at) | F.col("rawg_game_id").isNull() | F.col("_id").isNotNull()).drop("_id", "_last")


def entity_platforms(entities: DataFrame) -> DataFrame:
    """The rows of ``stg_rawg_game_platforms`` that the platform mart reads, out of ``game_entities`` (``with_released``)."""
    return entities.where(F.col("kind") == 2).select(
        "rawg_game_id", F.col("child_id").alias("platform_id"), F.col("name").alias("platform_name"), "released_at",
        F.col("extracted_at").alias("extracted_at_utc"))


#: A game's typed fields, beside its id and name.
GAME_FIELDS = {"slug": "string", "released_date": "date", "is_tba": "boolean", "rating": "double", "ratings_count": "bigint", "reviews_count": "bigint",
               "metacritic_score": "bigint", "added_count": "bigint", "playtime_hours": "bigint"}


def game_entities(raw_rawg: DataFrame, per_snapshot: bool = True, fold_first: bool = False, with_fields: bool = True,
                  with_released: bool = False) -> DataFrame:
    """Each game entry exploded once into the game (kind 0), its genres (kind 1)
    and its platforms (kind 2), deduplicated with the three staging models' keys
    (kind, [run,] game, child id) in one window.  Rows: extracted_at, kind,
    rawg_game_id, child_id, name (the entity's) and, with ``with_fields``, game (kind 0's other fields);
    with ``with_released`` also released_at (kind 2's).

    Entities are typed before they are sorted and shuffled, as in the staging models: a VARIANT
    that is taken out of a payload carries the payload's whole list of field names."""
    from snapmart.functions.variant import as_bool, as_date, as_double, as_number, as_string, vpath
    from snapmart.operators.dedup import keep_first
    from snapmart.plans import staging

    flat = staging.flattened_games(raw_rawg, per_snapshot).withColumn("rawg_game_id", as_number("game", "$.id"))
    if fold_first:
        flat = last_run_entries(raw_rawg, flat)

    def entity(kind: int, pos: Column, child_id: Column, name: Column, game: Column, released: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pos.alias("cpos"), child_id.alias("child_id"), name.alias("name"),
                        *[game.alias("game")] * with_fields, *[released.alias("released_at")] * with_released)

    no_game, no_date = F.lit(None).cast(f"struct<{','.join(f'{c}:{t}' for c, t in GAME_FIELDS.items())}>"), F.lit(None).cast("date")

    def kids(path: str, kind: int, inner: str):
        # like variant_explode: an array gives its elements, an object its values, anything else nothing
        arr = F.coalesce(vpath("game", path, "array<variant>", strict=False),
                         F.map_values(vpath("game", path, "map<string,variant>", strict=False)),
                         F.array().cast("array<variant>"))
        return F.transform(arr, lambda x, i: entity(kind, i, as_number(x, f"{inner}.id"), as_string(x, f"{inner}.name"), no_game,
                                                    as_date(x, "$.released_at") if kind == 2 else no_date))

    fields = F.struct(
        as_string("game", "$.slug").alias("slug"), as_date("game", "$.released").alias("released_date"),
        as_bool("game", "$.tba").alias("is_tba"), as_double("game", "$.rating").alias("rating"),
        as_number("game", "$.ratings_count").alias("ratings_count"), as_number("game", "$.reviews_count").alias("reviews_count"),
        as_number("game", "$.metacritic").alias("metacritic_score"), as_number("game", "$.added").alias("added_count"),
        as_number("game", "$.playtime").alias("playtime_hours"))
    me = F.array(entity(0, F.lit(0), F.lit(None).cast("bigint"), as_string("game", "$.name"), fields, no_date))
    rows = flat.select("extracted_at", "loaded_at", "s3_key", "game_pos", "rawg_game_id",
                       F.explode(F.concat(me, kids("$.genres", 1, "$"), kids("$.platforms", 2, "$.platform"))).alias("c"))
    rows = rows.select("extracted_at", "loaded_at", "s3_key", "game_pos", "rawg_game_id", "c.*")
    keys = (["extracted_at"] if per_snapshot else []) + ["kind", "rawg_game_id", "child_id"]
    order = [F.col("extracted_at").desc_nulls_first(), F.col("loaded_at").desc_nulls_first(),
             asc_nulls_last("s3_key"), asc_nulls_last("game_pos"), asc_nulls_last("cpos")]
    return keep_first(rows, keys, order)
