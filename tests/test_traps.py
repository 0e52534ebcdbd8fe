
import os
import tempfile

from pyspark.sql import functions as F

from snapmart.plans import marts, staging
from snapmart.plans.run import build_models
from tests import fixtures as fx


def _raw(spark, files):
    """files: (s3_key, loaded_at, snapshot_ts, results) → raw game table."""
    return fx.raw_table(spark, [("rawg", k, fx.envelope("rawg", ts, {"results": res}), la)
                                for k, la, ts, res in files])


def test_t2_ties_break_on_load_time_then_key_then_position(spark):
    raw = _raw(spark, [
        ("k1", "2026-04-01 10:00:00", fx.SNAP_B, [{"id": 9, "name": "first-file", "rating": 1.0},
                                                   {"id": 8, "name": "pos0"}, {"id": 8, "name": "pos1"}]),
        ("k2", "2026-04-01 11:00:00", fx.SNAP_B, [{"id": 9, "name": "later-load", "rating": 2.0}]),
        ("k0", "2026-04-01 09:00:00", fx.SNAP_B, [{"id": 7, "name": "key-b"}]),
        ("ka", "2026-04-01 09:00:00", fx.SNAP_B, [{"id": 7, "name": "key-a"}]),
    ])
    got = {r.rawg_game_id: r.game_name for r in staging.stg_rawg_games(raw).collect()}
    assert got == {9: "later-load", 8: "pos0", 7: "key-b"}  # 'k0' < 'ka'


def test_t4_all_null_genre_names_give_empty_list(spark):
    raw = _raw(spark, [("k", "2026-04-01 10:00:00", fx.SNAP_B,
                        [{"id": 1, "name": "x", "genres": [{"id": 3, "name": None}],
                          "platforms": [{"platform": {"id": 4, "name": None}}]}])])
    empty_steam = fx.raw_table(spark, [("steam", "s", fx.envelope("steam", fx.SNAP_B, {"featured_categories": []}),
                                        "2026-04-01 10:00:00")])
    m = build_models(raw, empty_steam, fx.audit(spark), history=False)["mart_games"].first()
    assert (m.genres, m.platform_count, m.platforms) == ("", 0, "")
    fused = build_models(raw, empty_steam, fx.audit(spark), history=True)["mart_games"].first()
    assert (fused.genres, fused.platform_count, fused.platforms) == ("", 0, "")


def test_t8_reloaded_file_collapses_in_staging(spark):
    once = fx.rawg_raw(spark, ("B",))
    twice = once.unionByName(once.withColumn("loaded_at", F.col("loaded_at") + F.expr("INTERVAL 1 HOUR")))
    a = staging.stg_rawg_games(once).drop("extracted_at_utc")
    b = staging.stg_rawg_games(twice).drop("extracted_at_utc")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_t10_null_key_is_kept_and_flagged(spark):
    from snapmart.operators import quality
    raw = _raw(spark, [("k", "2026-03-31 10:00:00", fx.SNAP_A, [{"name": "no id", "rating": 1.0}]),
                       ("k", "2026-04-01 10:00:00", fx.SNAP_B, [{"name": "no id", "rating": 1.0}])])
    m = build_models(raw, fx.steam_raw(spark), fx.audit(spark), history=True)["mart_games"]
    assert m.where("rawg_game_id is null").count() == 2  # inserted again on each run
    assert quality.not_null(m, "mart_games", ["rawg_game_id"]).first().failures == 2


def test_t11_game_leaving_the_store_list_loses_store_columns(spark):
    raw = _raw(spark, [("k1", "2026-03-31 10:00:00", fx.SNAP_A, [{"id": 1, "name": "alpha"}]),
                       ("k2", "2026-04-01 10:00:00", fx.SNAP_B, [{"id": 1, "name": "alpha"}])])
    steam = fx.raw_table(spark, [("steam", "s", fx.envelope("steam", fx.SNAP_A, {"featured_categories": [
        {"id": 101, "name": "alpha", "category_key": "specials", "category_name": "Specials"}]}),
        "2026-03-31 10:00:00")])
    run_a = build_models(_raw(spark, [("k1", "2026-03-31 10:00:00", fx.SNAP_A, [{"id": 1, "name": "alpha"}])]),
                         steam, fx.audit(spark), history=False)["mart_games"]
    assert run_a.first().steam_app_id == 101
    # the next run's store snapshot no longer lists it
    steam_b = steam.unionByName(fx.raw_table(spark, [("steam", "s2", fx.envelope(
        "steam", fx.SNAP_B, {"featured_categories": []}), "2026-04-01 10:00:00")]))
    hist = build_models(raw, steam_b, fx.audit(spark), history=True)["mart_games"].first()
    assert hist.steam_app_id is None and hist.extracted_at_utc.isoformat().startswith("2026-04-01")


def test_t12_partition_date_is_independent_of_extract_time(spark):
    from snapmart.sources import jsonscan
    root = tempfile.mkdtemp(prefix="landing-")
    d = os.path.join(root, "source=rawg", "extract_date=2026-04-05")
    os.makedirs(d)
    with open(os.path.join(d, "rawg_games_20260401T090000Z.json"), "w") as f:
        f.write(fx.envelope("rawg", fx.SNAP_B, {"results": []}))
    r = jsonscan.to_raw(jsonscan.scan_landing(spark, root, multi_line=True), source="rawg").first()
    assert str(r.extracted_at) == "2026-04-01 09:00:00"
    assert jsonscan.scan_landing(spark, root, multi_line=True).first().extract_date == "2026-04-05"


def test_object_valued_children_agree_between_fused_and_model_plans(spark):
    raw = _raw(spark, [("k", "2026-04-01 10:00:00", fx.SNAP_B, [
        {"id": 1, "name": "obj", "rating": 2.0,
         "genres": {"x": {"id": 1, "name": "RPG"}, "y": {"id": 2, "name": "Action"}},
         "platforms": {"p": {"platform": {"id": 4, "name": "PC"}, "released_at": "2020-01-02"}}},
        {"id": 2, "name": "scalar", "rating": 1.0, "genres": 5, "platforms": "none"}])])
    steam = fx.steam_raw(spark)
    for per_snapshot in (True, False):
        plain = marts.mart_games(staging.stg_rawg_games(raw, per_snapshot), staging.stg_rawg_game_genres(raw, per_snapshot),
                                 staging.stg_rawg_game_platforms(raw, per_snapshot),
                                 staging.stg_steam_featured_games(steam, per_snapshot), per_snapshot=per_snapshot)
        fused = marts.mart_games_fused(raw, staging.stg_steam_featured_games(steam, per_snapshot), per_snapshot)
        assert plain.exceptAll(fused).count() == 0 and fused.exceptAll(plain).count() == 0
    got = {r.rawg_game_id: (r.genres, r.platform_count) for r in fused.collect()}
    assert got == {1: ("Action, RPG", 1), 2: ("Unknown", 0)}


def test_one_pass_staging_checks_equal_per_model_checks(spark):
    from snapmart.operators import quality
    from snapmart.plans import checks
    raw = _raw(spark, [("k", "2026-04-01 10:00:00", fx.SNAP_B, [
        {"name": "no id", "genres": [{"id": 1, "name": None}, {"id": 1, "name": "dup"}],
         "platforms": [{"platform": {"id": 4}}]},
        {"id": 7, "genres": [{"id": 2, "name": "RPG"}], "platforms": [{"platform": {"id": 5, "name": "PC"}}]},
        {"id": 7, "name": "later copy"}])])
    models = {"stg_rawg_games": staging.stg_rawg_games(raw), "stg_rawg_game_genres": staging.stg_rawg_game_genres(raw),
              "stg_rawg_game_platforms": staging.stg_rawg_game_platforms(raw)}
    per_model = quality.report(*[quality.not_null(models[m], m, cols) for m, cols in checks.NOT_NULL.items()
                                 if m in checks.GAME_STAGING])
    shared = checks.game_staging_not_null(raw)
    assert per_model.exceptAll(shared).count() == 0 and shared.exceptAll(per_model).count() == 0
    assert {(r.model, r.column_name): r.failures for r in shared.collect()}[("stg_rawg_games", "rawg_game_id")] == 1


def _composed(raw, steam):
    offers = staging.stg_steam_featured_games(steam, per_snapshot=True)
    return marts.accumulated_mart_games(marts.mart_games(
        staging.stg_rawg_games(raw, True), staging.stg_rawg_game_genres(raw, True), staging.stg_rawg_game_platforms(raw, True),
        offers, per_snapshot=True, times=marts.raw_store_times(raw, steam)))


def _fused(raw, steam):
    return marts.accumulated_games_fused(raw, steam)


def _sequential(spark, raw, steam):
    """Run after run at every snapshot time of either source, each on what had been landed by then."""
    from snapmart.plans.run import build_models
    times = sorted({r[0] for df in (raw, steam) for r in df.select("extracted_at").distinct().collect()})
    mart = None
    for t in times:
        upto = lambda df: df.where(F.col("extracted_at") <= F.lit(str(t)).cast("timestamp_ntz"))
        now = build_models(upto(raw), upto(steam), fx.audit(spark), history=False, previous_mart=mart)["mart_games"]
        mart = spark.createDataFrame(now.collect(), now.schema)
    return mart


def _table(rows):
    return sorted(rows.collect(), key=str)


def test_null_game_id_with_children_takes_none_of_them(spark):
    child = {"name": "Nameless", "rating": 2.0, "genres": [{"id": 1, "name": "RPG"}],
             "platforms": [{"platform": {"id": 4, "name": "PC"}, "released_at": None}]}
    raw = fx.raw_table(spark, [("rawg", "k", fx.envelope("rawg", fx.SNAP_A, {"results": [child, fx.ALPHA]}), "2026-03-31 10:00:00")])
    rows = {r.rawg_game_id: r for r in _fused(raw, fx.steam_raw(spark)).collect()}
    assert (rows[None].genres, rows[None].platform_count, rows[None].platforms) == ("Unknown", 0, None)
    assert rows[1].genres == "Action, RPG"
    one_id = raw.where("true")
    assert _table(_fused(one_id, fx.steam_raw(spark))) == _table(_composed(one_id, fx.steam_raw(spark)))


def test_sources_that_miss_runs_replay_as_the_sequence_of_runs(spark):
    def games(ts, *rows):
        return ("rawg", ts, fx.envelope("rawg", ts, {"results": list(rows)}), ts.replace("T09:00:00Z", " 10:00:00"))

    def store(ts, price):
        items = [{"id": 7, "name": "alpha", "category_key": "s", "category_name": "S", "final_price": price}]
        return ("steam", ts, fx.envelope("steam", ts, {"featured_categories": items}), ts.replace("T09:00:00Z", " 10:00:00"))

    day = lambda k: f"2026-04-0{k}T09:00:00Z"
    alpha, gone = {"id": 1, "name": "Alpha", "rating": 1.0}, {"id": 2, "name": " ALPHA", "rating": 2.0}
    cases = [([1, 2], [1]), ([1, 2], [2]), ([1, 3], [1, 2]), ([1, 3], [2, 3]), ([2], [1, 3]), ([1, 4], [2, 3]), ([1, 2, 3], [])]
    for game_days, store_days in cases:
        raw = fx.raw_table(spark, [games(day(k), *([alpha, gone] if k == game_days[0] else [alpha])) for k in game_days])
        steam = fx.raw_table(spark, [store(day(k), 100 * k) for k in store_days] or [store(day(9), 1)])
        if not store_days:
            steam = steam.where("false")
        want = _table(_sequential(spark, raw, steam))
        assert _table(_fused(raw, steam)) == want, (game_days, store_days)
        assert _table(_composed(raw, steam)) == want, (game_days, store_days)


def test_a_genre_with_a_comma_is_one_genre(spark):
    from snapmart.plans import kpis
    game = {"id": 1, "name": "A", "rating": 4.0, "genres": [{"id": 1, "name": "Action, Adventure"}, {"id": 2, "name": "RPG"}]}
    raw = fx.raw_table(spark, [("rawg", "k", fx.envelope("rawg", fx.SNAP_A, {"results": [game, {"id": 2, "name": "B", "rating": 1.0}]}),
                               "2026-03-31 10:00:00")])
    got = {r.genre: (r.avg_rating, r.game_count) for r in kpis.rating_by_genre(marts.games_fused(raw, fold_first=True)).collect()}
    assert got == {"Action, Adventure": (4.0, 1), "RPG": (4.0, 1), "Unknown": (1.0, 1)}


def test_stream_takes_pretty_printed_files(spark):
    from snapmart.session import fresh_dir
    from snapmart.streaming.file_load import load_stream
    root = tempfile.mkdtemp()
    d = os.path.join(root, "source=rawg", "extract_date=2026-04-01")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write(fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B}))
    raw_root = fresh_dir(spark, "raw")
    load_stream(spark, root, raw_root, fresh_dir(spark, "ckpt"), loaded_at="2026-04-01 10:00:00")
    rows = spark.read.parquet(raw_root).collect()
    assert len(rows) == 1 and str(rows[0].extracted_at) == "2026-04-01 09:00:00"
