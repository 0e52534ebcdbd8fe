"""C1–C5 — the staging models.

Each model takes a raw table ``(source, s3_key, extracted_at, payload, loaded_at)``.
``per_snapshot=False`` is the reference semantics (latest snapshot only);
``per_snapshot=True`` stages every snapshot at once, keyed additionally by
``extracted_at_utc`` — the replay of every daily run in one distributed pass.

Ties inside a snapshot (all rows share ``extracted_at``) are broken by
``loaded_at desc, s3_key, position`` so the winner is deterministic (trap T2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.functions.money import cents_to_usd
from snapmart.functions.ordering import asc_nulls_last
from snapmart.functions.timefmt import epoch_to_ntz
from snapmart.functions.variant import as_bool, as_date, as_double, as_number, as_string, as_ts_ntz
from snapmart.operators.dedup import keep_first
from snapmart.operators.flatten import flatten
from snapmart.operators.snapshot import latest_snapshot

_TIE = ["extracted_at", "loaded_at", "s3_key"]


def _scope(raw: DataFrame, per_snapshot: bool) -> DataFrame:
    raw = raw.select("extracted_at", "loaded_at", "s3_key", "payload")
    return raw if per_snapshot else latest_snapshot(raw)


def _tie_order(*positions: str):
    return [F.col("extracted_at").desc_nulls_first(), F.col("loaded_at").desc_nulls_first(),
            asc_nulls_last("s3_key"), *[asc_nulls_last(p) for p in positions]]


def flattened_games(raw_rawg: DataFrame, per_snapshot: bool = False) -> DataFrame:
    """One row per game entry of the scoped snapshot(s)."""
    return flatten(_scope(raw_rawg, per_snapshot), "payload", "$.payload.results", "game", keep=_TIE)


def _keys(per_snapshot: bool, *keys):
    return (["extracted_at", *keys] if per_snapshot else list(keys))


def stg_rawg_games(raw_rawg: DataFrame, per_snapshot: bool = False, flat: DataFrame | None = None) -> DataFrame:
    """Typed game rows, one per game id (per snapshot)."""
    g = flat if flat is not None else flattened_games(raw_rawg, per_snapshot)
    typed = g.select(
        *_TIE, "game_pos",
        as_number("game", "$.id").alias("rawg_game_id"),
        as_string("game", "$.slug").alias("slug"),
        as_string("game", "$.name").alias("game_name"),
        as_date("game", "$.released").alias("released_date"),
        as_bool("game", "$.tba").alias("is_tba"),
        as_double("game", "$.rating").alias("rating"),
        as_number("game", "$.rating_top").alias("rating_top"),
        as_number("game", "$.ratings_count").alias("ratings_count"),
        as_number("game", "$.reviews_count").alias("reviews_count"),
        as_number("game", "$.reviews_text_count").alias("reviews_text_count"),
        as_number("game", "$.added").alias("added_count"),
        as_number("game", "$.playtime").alias("playtime_hours"),
        as_number("game", "$.suggestions_count").alias("suggestions_count"),
        as_number("game", "$.metacritic").alias("metacritic_score"),
        as_string("game", "$.background_image").alias("background_image_url"),
        as_ts_ntz("game", "$.updated").alias("source_updated_at"),
    )
    out = keep_first(typed, _keys(per_snapshot, "rawg_game_id"), _tie_order("game_pos"))
    return out.select(*GAME_COLUMNS[:-1], F.col("extracted_at").alias("extracted_at_utc"))


GAME_COLUMNS = ["rawg_game_id", "slug", "game_name", "released_date", "is_tba", "rating", "rating_top",
                "ratings_count", "reviews_count", "reviews_text_count", "added_count", "playtime_hours",
                "suggestions_count", "metacritic_score", "background_image_url", "source_updated_at",
                "extracted_at_utc"]


def stg_rawg_game_genres(raw_rawg: DataFrame, per_snapshot: bool = False, flat: DataFrame | None = None) -> DataFrame:
    """Game × genre (U2: a game without genres vanishes here)."""
    g = flat if flat is not None else flattened_games(raw_rawg, per_snapshot)
    g = g.select(*_TIE, "game_pos", "game", as_number("game", "$.id").alias("rawg_game_id"),
                 as_string("game", "$.name").alias("game_name"))
    x = flatten(g, "game", "$.genres", "genre", keep=[*_TIE, "game_pos", "rawg_game_id", "game_name"])
    typed = x.select(*_TIE, "game_pos", "genre_pos", "rawg_game_id", "game_name",
                     as_number("genre", "$.id").alias("genre_id"),
                     as_string("genre", "$.name").alias("genre_name"),
                     as_string("genre", "$.slug").alias("genre_slug"))
    out = keep_first(typed, _keys(per_snapshot, "rawg_game_id", "genre_id"), _tie_order("game_pos", "genre_pos"))
    return out.select("rawg_game_id", "game_name", "genre_id", "genre_name", "genre_slug",
                      F.col("extracted_at").alias("extracted_at_utc"))


def stg_rawg_game_platforms(raw_rawg: DataFrame, per_snapshot: bool = False,
                            flat: DataFrame | None = None) -> DataFrame:
    """Game × platform; the platform object is nested, ``released_at`` its sibling."""
    g = flat if flat is not None else flattened_games(raw_rawg, per_snapshot)
    g = g.select(*_TIE, "game_pos", "game", as_number("game", "$.id").alias("rawg_game_id"),
                 as_string("game", "$.name").alias("game_name"))
    x = flatten(g, "game", "$.platforms", "plat", keep=[*_TIE, "game_pos", "rawg_game_id", "game_name"])
    typed = x.select(*_TIE, "game_pos", "plat_pos", "rawg_game_id", "game_name",
                     as_number("plat", "$.platform.id").alias("platform_id"),
                     as_string("plat", "$.platform.name").alias("platform_name"),
                     as_string("plat", "$.platform.slug").alias("platform_slug"),
                     as_date("plat", "$.released_at").alias("released_at"))
    out = keep_first(typed, _keys(per_snapshot, "rawg_game_id", "platform_id"), _tie_order("game_pos", "plat_pos"))
    return out.select("rawg_game_id", "game_name", "platform_id", "platform_name", "platform_slug", "released_at",
                      F.col("extracted_at").alias("extracted_at_utc"))


OFFER_COLUMNS = ["steam_app_id", "game_name", "item_type", "category_key", "category_name", "is_discounted",
                 "discount_percent", "original_price_usd", "final_price_usd", "currency", "windows_available",
                 "mac_available", "linux_available", "controller_support", "header_image_url", "steam_url",
                 "discount_expires_at", "extracted_at_utc"]


def stg_steam_featured_games(raw_steam: DataFrame, per_snapshot: bool = False) -> DataFrame:
    """C4: store items, deduplicated on (coalesce(id, -1), category, name)."""
    x = flatten(_scope(raw_steam, per_snapshot), "payload", "$.payload.featured_categories", "item", keep=_TIE)
    typed = x.select(
        *_TIE, "item_pos",
        as_number("item", "$.id").alias("steam_app_id"),
        as_string("item", "$.name").alias("game_name"),
        as_number("item", "$.type").alias("item_type"),
        as_string("item", "$.category_key").alias("category_key"),
        as_string("item", "$.category_name").alias("category_name"),
        as_bool("item", "$.discounted").alias("is_discounted"),
        as_number("item", "$.discount_percent").alias("discount_percent"),
        cents_to_usd(as_number("item", "$.original_price")).alias("original_price_usd"),
        cents_to_usd(as_number("item", "$.final_price")).alias("final_price_usd"),
        as_string("item", "$.currency").alias("currency"),
        as_bool("item", "$.windows_available").alias("windows_available"),
        as_bool("item", "$.mac_available").alias("mac_available"),
        as_bool("item", "$.linux_available").alias("linux_available"),
        as_string("item", "$.controller_support").alias("controller_support"),
        as_string("item", "$.header_image").alias("header_image_url"),
        as_string("item", "$.url").alias("steam_url"),
        epoch_to_ntz(as_number("item", "$.discount_expiration")).alias("discount_expires_at"),
    )
    keys = _keys(per_snapshot) + [F.coalesce(F.col("steam_app_id"), F.lit(-1)), F.col("category_key"),
                                  F.col("game_name")]
    out = keep_first(typed, keys, _tie_order("item_pos"))
    return out.select(*OFFER_COLUMNS[:-1], F.col("extracted_at").alias("extracted_at_utc"))


AUDIT_COLUMNS = ["source", "s3_key", "target_table", "rows_loaded", "status", "loaded_at"]


def stg_raw_load_audit(audit: DataFrame) -> DataFrame:
    """Pass-through projection of the audit log."""
    return audit.select(*AUDIT_COLUMNS)
