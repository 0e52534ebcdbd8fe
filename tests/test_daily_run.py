"""The daily flow end to end on files: load twice = once, forced reload, merge across runs."""

import os
import tempfile

from tests import fixtures as fx
from tests.test_golden import EXPECTED_MART, _mart_dict


def _land(root, source, day, name, body):
    d = os.path.join(root, f"source={source}", f"extract_date={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(body)


def test_daily_runs(spark):
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir
    landing = tempfile.mkdtemp(prefix="landing-")
    _land(landing, "rawg", "2026-03-31", "rawg_games_20260331T090000Z.json",
          fx.envelope("rawg", fx.SNAP_A, {"results": fx.GAMES_A}))
    _land(landing, "rawg", "2026-04-01", "rawg_games_20260401T090000Z.json",
          fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B}))
    items = fx.featured_items()
    _land(landing, "steam", "2026-04-01", "steam_apps_20260401T090000Z.json",
          fx.envelope("steam", fx.SNAP_B, {"featured_categories": items, "total_available": len(items)}))
    wh = fresh_dir(spark, "warehouse")

    a = daily_run(spark, landing, wh, "2026-03-31", loaded_at="2026-03-31 10:00:00")
    assert [(r.source, r.status, r.rows_loaded) for r in a["load_audit"].collect()] == [("rawg", "loaded", 1)]
    b = daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 10:00:00",
                  now="2026-04-02 10:00:00")
    assert sorted((r.source, r.status) for r in b["load_audit"].collect()) == [("rawg", "loaded"), ("steam", "loaded")]
    assert _mart_dict(b["mart_games"]) == EXPECTED_MART
    assert [r.rawg_game_id for r in b["mart_top_rated_games"].collect()] == [3, 1, 4, 5]
    assert {r.status for r in b["freshness"].collect()} == {"pass"}
    fails = {(r.model, r.column_name, r.test) for r in b["report"].collect() if r.status == "fail"}
    assert fails == set()

    again = daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 11:00:00")
    assert {(r.status, r.rows_loaded) for r in again["load_audit"].collect()} == {("skipped_existing", 0)}
    assert _mart_dict(again["mart_games"]) == EXPECTED_MART

    growth = [(r.game_count, r.delta_games) for r in again["kpi_catalog_growth"].orderBy("extracted_at").collect()]
    assert growth == [(2, 2), (4, 2)]

    forced = daily_run(spark, landing, wh, "2026-04-01", force_reload=True, loaded_at="2026-04-01 12:00:00")
    assert {r.status for r in forced["load_audit"].collect()} == {"reloaded"}
    assert _mart_dict(forced["mart_games"]) == EXPECTED_MART  # reloaded rows collapse (T8)
    summary = {(str(r.load_date)[:10], r.source): (r.load_attempts, r.successful_loads, r.skipped_existing_loads)
               for r in forced["mart_pipeline_load_summary"].collect()}
    assert summary[("2026-04-01", "rawg")] == (3, 1, 1)
    assert summary[("2026-03-31", "rawg")] == (1, 1, 0)


def test_daily_runs_with_bucketed_mart(spark):
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir
    landing = tempfile.mkdtemp(prefix="landing-")
    _land(landing, "rawg", "2026-03-31", "a.json", fx.envelope("rawg", fx.SNAP_A, {"results": fx.GAMES_A}))
    _land(landing, "rawg", "2026-04-01", "b.json", fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B}))
    items = fx.featured_items()
    _land(landing, "steam", "2026-04-01", "s.json",
          fx.envelope("steam", fx.SNAP_B, {"featured_categories": items, "total_available": len(items)}))
    wh = fresh_dir(spark, "warehouse")
    daily_run(spark, landing, wh, "2026-03-31", loaded_at="2026-03-31 10:00:00", mart_buckets=4)
    b = daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 10:00:00", mart_buckets=4)
    assert _mart_dict(b["mart_games"]) == EXPECTED_MART
    assert [r.rawg_game_id for r in b["mart_top_rated_games"].collect()] == [3, 1, 4, 5]


def test_a_failing_check_fails_the_run_and_keeps_its_report(spark):
    import pytest
    from snapmart.operators.quality import ChecksFailed
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir
    from snapmart.sources import catalog
    landing, wh = tempfile.mkdtemp(prefix="landing-"), fresh_dir(spark, "warehouse")
    _land(landing, "rawg", "2026-03-31", "a.json", fx.envelope("rawg", fx.SNAP_A, {"results": [{"id": 1, "name": None}]}))
    with pytest.raises(ChecksFailed):
        daily_run(spark, landing, wh, "2026-03-31", loaded_at="2026-03-31 10:00:00")
    report = catalog.read_current(spark, f"{wh}/check_report")
    assert {(r.model, r.column_name) for r in report.where("status = 'fail'").collect()} == {
        ("stg_rawg_games", "game_name"), ("mart_games", "game_name")}
    out = daily_run(spark, landing, wh, "2026-03-31", loaded_at="2026-03-31 11:00:00", fail_on_checks=False, keep_versions=1)
    assert out["report"].where("status = 'fail'").count() == 2
    assert len([d for d in os.listdir(f"{wh}/mart/mart_games/_manifest") if not d.startswith(".")]) == 1
    assert len([d for d in os.listdir(f"{wh}/mart/mart_top_rated_games") if d.startswith("version=")]) == 1


def test_a_run_lands_its_envelopes_by_key_and_reruns_add_nothing(spark):
    import json
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir
    from snapmart.sources import catalog
    landing, wh = fresh_dir(spark, "landing"), fresh_dir(spark, "warehouse")
    key = "raw/source=rawg/extract_date=2026-04-01/rawg_games_20260401T090000Z.json"
    body = json.dumps(json.loads(fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B})))
    env = spark.createDataFrame([("rawg", "2026-04-01", key, body)], "source string, extract_date string, s3_key string, body string")
    for at, upload, status, rows in (("10", "uploaded", "loaded", 1), ("11", "skipped_existing", "skipped_existing", 0)):
        out = daily_run(spark, landing, wh, "2026-04-01", envelopes=env, loaded_at=f"2026-04-01 {at}:00:00")
        assert [r.upload_status for r in out["landing"].collect()] == [upload]
        assert [(r.s3_key, r.status, r.rows_loaded) for r in out["load_audit"].collect()] == [(key, status, rows)]
    assert spark.table("raw.rawg_games_raw").count() == 1 and spark.table("raw.raw_load_audit").count() == 2
    forced = daily_run(spark, landing, wh, "2026-04-01", envelopes=env, force_upload=True, force_reload=True,
                       loaded_at="2026-04-01 12:00:00")
    assert [r.upload_status for r in forced["landing"].collect()] == ["uploaded"]
    assert [(r.status, r.rows_loaded) for r in forced["load_audit"].collect()] == [("reloaded", 1)]


def test_a_skipped_file_is_never_opened(spark):
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir
    landing, wh = tempfile.mkdtemp(prefix="landing-"), fresh_dir(spark, "warehouse")
    _land(landing, "rawg", "2026-04-01", "a.json", fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B}))
    daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 10:00:00")
    _land(landing, "rawg", "2026-04-01", "a.json", "{broken")  # loaded already: a scan of it would abort the run
    out = daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 11:00:00")
    assert [r.status for r in out["load_audit"].collect()] == ["skipped_existing"]


def test_a_root_with_landed_keys_and_plain_files_loads_both(spark):
    import json
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir
    from snapmart.sources import jsonscan
    landing, wh = tempfile.mkdtemp(prefix="landing-"), fresh_dir(spark, "warehouse")
    name = "rawg_games_20260331T090000Z.json"
    pretty = json.dumps(json.loads(fx.envelope("rawg", fx.SNAP_A, {"results": fx.GAMES_A})), indent=1)
    _land(landing, "rawg", "2026-03-31", name, pretty)  # a day of plain files only
    _land(landing, "rawg", "2026-04-01", "early.json", pretty)  # and one of both
    one_line = json.dumps(json.loads(fx.envelope("rawg", fx.SNAP_A, {"results": fx.GAMES_A})))
    _land(landing, "rawg", "2026-04-01", "part-00000-other.txt", one_line)
    key = "raw/source=rawg/extract_date=2026-04-01/rawg_games_20260401T090000Z.json"
    body = json.dumps(json.loads(fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B})))
    env = spark.createDataFrame([("rawg", "2026-04-01", key, body)], "source string, extract_date string, s3_key string, body string")

    def audit(out):
        return sorted((r.s3_key, r.status, r.rows_loaded) for r in out["load_audit"].collect())

    folder = "source=rawg/extract_date=2026-04-01"
    both = daily_run(spark, landing, wh, "2026-04-01", envelopes=env, loaded_at="2026-04-01 10:00:00")
    assert audit(both) == [(key, "loaded", 1), (f"{folder}/early.json", "loaded", 1), (f"{folder}/part-00000-other.txt", "loaded", 1)]
    again = daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 11:00:00")
    assert {s[1:] for s in audit(again)} == {("skipped_existing", 0)} and len(audit(again)) == 3
    path = f"source=rawg/extract_date=2026-03-31/{name}"
    for force, status in ((False, "loaded"), (True, "reloaded")):
        backfill = daily_run(spark, landing, wh, "2026-03-31", force_reload=force, loaded_at="2026-04-01 12:00:00")
        assert audit(backfill) == [(path, status, 1)]
    assert jsonscan.load_key(spark, landing, key).count() == 1
    assert jsonscan.load_key(spark, landing, f"raw/{path}").count() == 0


def test_a_run_takes_its_payloads_apart_once(spark):
    from pyspark.sql import functions as F
    from snapmart.plans import checks
    from snapmart.plans.run import build_models, stage
    odd = {"results": [
        *fx.GAMES_B, {"id": None, "name": "No id", "platforms": [{"platform": {"id": None, "name": None}, "released_at": "2020-01-01"}]},
        {"id": 7, "name": None, "genres": {"b": {"id": 9, "name": "Object"}, "a": {"id": 9, "name": "First"}}, "platforms": "none"},
        {"id": 7, "name": "Later", "genres": [{"id": 8, "name": None}],
         "platforms": [{"platform": {"id": 4, "name": "PC"}}, {"platform": {"id": 4, "name": "PC 2"}, "released_at": "2022-02-02"}]}]}
    rawg = fx.raw_table(spark, [("rawg", key, fx.envelope("rawg", at, body), "2026-04-01 10:00:00") for key, at, body in (
        ("a.json", fx.SNAP_A, {"results": fx.GAMES_A}), ("b.json", fx.SNAP_B, odd), ("c.json", fx.SNAP_B, {"results": fx.GAMES_B[::-1]}))])
    steam = fx.steam_raw(spark)
    staged = stage(rawg, steam)
    by_views = build_models(rawg, steam, fx.audit(spark), history=False)
    by_stage = build_models(rawg, steam, fx.audit(spark), history=False, staged=staged)

    def rows(df):
        return sorted(map(str, df.collect()))

    def opens_payloads(df):
        return "payload" in df._jdf.queryExecution().optimizedPlan().toString()

    for mart in ("mart_games", "mart_platform_coverage", "mart_top_rated_games"):
        assert rows(by_stage[mart]) == rows(by_views[mart])
        assert opens_payloads(by_views[mart]) and not opens_payloads(by_stage[mart])
    assert by_stage["mart_games"].where("rawg_game_id = 7").select(F.col("genres"), F.col("platforms")).collect() == [("First", "PC")]
    report = checks.all_checks({**by_stage, "stg_steam_featured_games": staged.offers}, rawg, entities=staged.entities)
    assert not opens_payloads(report) and rows(report) == rows(checks.all_checks(by_views))


def test_a_run_removes_its_staged_rows(spark):
    import glob
    from snapmart.plans.run import daily_run
    from snapmart.session import fresh_dir, scratch_root
    landing, wh = tempfile.mkdtemp(prefix="landing-"), fresh_dir(spark, "warehouse")
    _land(landing, "rawg", "2026-04-01", "a.json", fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B}))
    before = glob.glob(f"{scratch_root(spark)}/staged-*")
    out = daily_run(spark, landing, wh, "2026-04-01", loaded_at="2026-04-01 10:00:00")
    assert glob.glob(f"{scratch_root(spark)}/staged-*") == before
    assert all(df.count() >= 0 for df in out.values())
