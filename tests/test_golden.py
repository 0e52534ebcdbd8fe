"""Golden cases: hand-made snapshots with the expected rows of FIXTURES.md §2."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from snapmart.plans import marts, staging
from snapmart.plans.run import build_models
from snapmart.sources import category
from snapmart.functions.variant import as_number, as_string
from tests import fixtures as fx


def test_category_flatten_keeps_document_order(spark):
    docs = spark.createDataFrame([(1, json.dumps(fx.STORE_DOC))], "doc_no int, doc string")
    items = category.flatten_categories(docs, "doc", keep=["doc_no"])
    rows = items.orderBy("cat_pos", "item_pos").select("category_key", as_number("item", "$.id").alias("id")).collect()
    assert [(r.category_key, r.id) for r in rows] == [
        ("specials", 100), ("specials", None), ("specials", None), ("top_sellers", 101), ("top_sellers", 102)]


def test_category_cursor_and_head(spark):
    docs = spark.createDataFrame([(1, json.dumps(fx.STORE_DOC))], "doc_no int, doc string")
    items = category.flatten_categories(docs, "doc", keep=["doc_no"])
    after = category.after_cursor(items, 100).select(as_number("item", "$.id").alias("id")).collect()
    assert sorted(r.id for r in after) == [101, 102]
    head = category.head_with_total(items, ["doc_no"], [F.col("cat_pos"), F.col("item_pos")], 2)
    got = head.orderBy("item_rank").select("category_key", "item_rank", "total_available").collect()
    assert [(r.category_key, r.item_rank, r.total_available) for r in got] == [("specials", 1, 5), ("specials", 2, 5)]


def test_staging_on_latest_snapshot(spark):
    raw = fx.rawg_raw(spark)
    games = staging.stg_rawg_games(raw)
    assert sorted(r.rawg_game_id for r in games.collect()) == [1, 2, 4, 5]
    g1 = games.where("rawg_game_id = 1").first()
    assert g1.rating == 4.5 and g1.ratings_count is None and g1.reviews_count == 5
    genres = staging.stg_rawg_game_genres(raw)
    assert sorted((r.rawg_game_id, r.genre_name) for r in genres.collect()) == [(1, "Action"), (1, "RPG"), (2, "RPG")]
    plats = staging.stg_rawg_game_platforms(raw)
    assert sorted((r.rawg_game_id, r.platform_name) for r in plats.collect()) == [
        (1, "PC"), (1, "Switch"), (2, "PC"), (4, "PC")]


def test_store_staging_and_name_rollup(spark):
    offers = staging.stg_steam_featured_games(fx.steam_raw(spark))
    rows = offers.collect()
    assert len(rows) == 4 and sum(1 for r in rows if r.game_name == "Mystery") == 1
    o100 = [r for r in rows if r.steam_app_id == 100][0]
    assert o100.final_price_usd == Decimal("19.990000")
    assert str(o100.discount_expires_at) == "2026-03-28 09:00:00"
    assert [r for r in rows if r.steam_app_id == 101][0].final_price_usd == Decimal("59.990000")
    from snapmart.operators.rollup import name_rollup
    roll = {r.game_name_key: r for r in name_rollup(offers).collect()}
    assert set(roll) == {"alpha", "mystery"}
    a = roll["alpha"]
    assert (a.steam_app_id, a.steam_category_name, a.is_discounted_on_steam, a.steam_discount_percent,
            a.steam_final_price_usd, a.steam_windows_available, a.steam_mac_available, a.steam_linux_available) == (
        101, "Top Sellers", True, 50, Decimal("59.990000"), True, True, None)
    m = roll["mystery"]
    assert m.steam_category_name == "Specials" and m.steam_app_id is None and m.steam_final_price_usd is None


def test_platform_coverage(spark):
    cov = marts.mart_platform_coverage(staging.stg_rawg_game_platforms(fx.rawg_raw(spark))).collect()
    assert [(r.platform_name, r.game_count) for r in cov] == [("PC", 3), ("Switch", 1)]
    assert abs(cov[0].pct_with_platform_release_date - 2 / 3) < 1e-12 and cov[1].pct_with_platform_release_date == 0.0


EXPECTED_MART = {
    1: (" Alpha ", 4.5, "Action, RPG", 2, "PC, Switch", 101, 50, Decimal("59.990000")),
    2: ("Beta", None, "RPG", 1, "PC", None, None, None),
    3: ("Gone", 4.9, "Unknown", 0, None, None, None, None),
    4: ("alpha", 4.5, "Unknown", 1, "PC", 101, 50, Decimal("59.990000")),
    5: ("Echo", 3.0, "Unknown", 0, None, None, None, None),
}


def _mart_dict(df):
    return {r.rawg_game_id: (r.game_name, r.rating, r.genres, r.platform_count, r.platforms, r.steam_app_id,
                             r.steam_discount_percent, r.steam_final_price_usd) for r in df.collect()}


def test_mart_sequential_runs(spark):
    steam = fx.steam_raw(spark)
    run_a = build_models(fx.rawg_raw(spark, ("A",)), steam, fx.audit(spark), history=False)["mart_games"]
    mart_a = spark.createDataFrame(run_a.collect(), run_a.schema)
    run_b = build_models(fx.rawg_raw(spark), steam, fx.audit(spark), history=False, previous_mart=mart_a)
    assert _mart_dict(run_b["mart_games"]) == EXPECTED_MART
    top = [r.rawg_game_id for r in run_b["mart_top_rated_games"].collect()]
    assert top == [3, 1, 4, 5]


def test_mart_history_replay_matches_sequential(spark):
    # A replay joins each run's store snapshot by run time; the store has only B's.
    models = build_models(fx.rawg_raw(spark), fx.steam_raw(spark), fx.audit(spark), history=True)
    assert _mart_dict(models["mart_games"]) == EXPECTED_MART
    assert [r.rawg_game_id for r in models["mart_top_rated_games"].collect()] == [3, 1, 4, 5]


def test_spark_default_null_order_would_be_wrong(spark):
    models = build_models(fx.rawg_raw(spark), fx.steam_raw(spark), fx.audit(spark), history=True)
    wrong = (models["mart_games"].where("rating is not null")
             .orderBy(F.desc("rating"), F.desc("ratings_count"), F.desc("reviews_count"), "game_name").limit(25))
    assert [r.rawg_game_id for r in wrong.collect()] == [3, 4, 1, 5]


def test_fused_mart_equals_model_composition(spark):
    raw, steam = fx.rawg_raw(spark), fx.steam_raw(spark)
    for per_snapshot in (True, False):
        plain = marts.mart_games(staging.stg_rawg_games(raw, per_snapshot), staging.stg_rawg_game_genres(raw, per_snapshot),
                                 staging.stg_rawg_game_platforms(raw, per_snapshot),
                                 staging.stg_steam_featured_games(steam, per_snapshot), per_snapshot=per_snapshot)
        fused = marts.mart_games_fused(raw, staging.stg_steam_featured_games(steam, per_snapshot), per_snapshot)
        assert plain.exceptAll(fused).count() == 0 and fused.exceptAll(plain).count() == 0


def test_models_are_queryable_in_sql(spark):
    from snapmart.plans.run import register_views
    models = build_models(fx.rawg_raw(spark), fx.steam_raw(spark), fx.audit(spark), history=True)
    assert "mart_top_rated_games" in register_views(models)
    rows = spark.sql("SELECT rawg_game_id FROM mart_top_rated_games ORDER BY rating DESC NULLS FIRST, "
                     "ratings_count DESC NULLS FIRST, reviews_count DESC NULLS FIRST, game_name").collect()
    assert [r.rawg_game_id for r in rows] == [3, 1, 4, 5]
    got = spark.sql("SELECT platform_name, count(DISTINCT rawg_game_id) AS n FROM stg_rawg_game_platforms "
                    "GROUP BY 1 ORDER BY 2 DESC").collect()
    assert [(r.platform_name, r.n) for r in got] == [("PC", 3), ("Switch", 1)]
