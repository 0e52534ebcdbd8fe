"""Operator semantics: flatten, strict casts, scans, gate, merge, loads, versions, checks."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from snapmart.functions.variant import as_date, as_number
from snapmart.operators.flatten import flatten
from snapmart.session import fresh_dir
from tests import fixtures as fx


def test_flatten_inner_semantics(spark):
    docs = ['{"r":[1,2]}', '{"r":[]}', '{"r":{}}', '{"r":5}', '{"r":null}', '{}']
    df = spark.createDataFrame(list(enumerate(docs)), "k int, s string").select("k", F.parse_json("s").alias("v"))
    out = flatten(df, "v", "$.r", "x", keep=["k"]).collect()
    assert sorted((r.k, r.x_pos) for r in out) == [(0, 0), (0, 1)]


def test_flatten_twice_has_no_ambiguous_columns(spark):
    df = spark.createDataFrame([('{"a":[{"b":[1,2]},{"b":[3]}]}',)], "s string").select(F.parse_json("s").alias("v"))
    one = flatten(df, "v", "$.a", "a", keep=[])
    two = flatten(one, "a", "$.b", "b", keep=["a_pos"])
    assert sorted((r.a_pos, r.b_pos) for r in two.collect()) == [(0, 0), (0, 1), (1, 0)]


def test_number_cast_rounds_like_the_warehouse(spark):
    df = spark.createDataFrame([('{"n":2.5}',), ('{"n":-2.5}',)], "s string").select(F.parse_json("s").alias("v"))
    assert sorted(r.n for r in df.select(as_number("v", "$.n").alias("n")).collect()) == [-3, 3]


def test_strict_date_cast_raises_and_lenient_nulls(spark):
    df = spark.createDataFrame([('{"d":""}',)], "s string").select(F.parse_json("s").alias("v"))
    with pytest.raises(Exception):
        df.select(as_date("v", "$.d")).collect()
    assert df.select(as_date("v", "$.d", strict=False).alias("d")).first().d is None


def test_landing_roundtrip_and_failfast(spark):
    from snapmart.sources import jsonscan
    root = tempfile.mkdtemp(prefix="landing-")
    d = os.path.join(root, "source=rawg", "extract_date=2026-04-01")
    os.makedirs(d)
    with open(os.path.join(d, "rawg_games_20260401T090000Z.json"), "w") as f:
        f.write(fx.envelope("rawg", fx.SNAP_B, {"results": fx.GAMES_B}))
    scan = jsonscan.scan_landing(spark, root, multi_line=True, source="rawg", extract_date="2026-04-01")
    raw = jsonscan.to_raw(scan, source="rawg", loaded_at="2026-04-01 10:00:00", root="file:" + root)
    r = raw.first()
    assert r.s3_key == "source=rawg/extract_date=2026-04-01/rawg_games_20260401T090000Z.json"
    assert str(r.extracted_at) == "2026-04-01 09:00:00"
    # A filter on another day prunes everything
    assert jsonscan.scan_landing(spark, root, multi_line=True, extract_date="2026-04-02").count() == 0
    bad = os.path.join(root, "source=rawg", "extract_date=2026-04-03")
    os.makedirs(bad)
    with open(os.path.join(bad, "broken.json"), "w") as f:
        f.write("{not json")
    with pytest.raises(Exception):
        jsonscan.scan_landing(spark, root, multi_line=True).count()


def test_landing_key_and_unknown_source(spark):
    from snapmart.sources import landing
    df = spark.createDataFrame([("rawg",), ("steam",), ("epic",)], "source string")
    ts = F.lit("2026-04-01 09:00:00").cast("timestamp_ntz")
    ok = df.where("source != 'epic'").select("source", *landing.run_context(ts, extract_date="2026-03-31"))
    keys = sorted(r.k for r in ok.select(landing.landing_key("source", "extract_date", "file_stamp").alias("k")).collect())
    assert keys == ["raw/source=rawg/extract_date=2026-03-31/rawg_games_20260401T090000Z.json",
                    "raw/source=steam/extract_date=2026-03-31/steam_apps_20260401T090000Z.json"]
    with pytest.raises(Exception):
        df.select(landing.file_name("source", F.lit("x"))).collect()


def test_gate(spark):
    from snapmart.sources.landing import gate
    cand = spark.createDataFrame([("a",), ("b",)], "s3_key string")
    existing = spark.createDataFrame([("a",), ("a",)], "s3_key string")
    got = {r.s3_key: r.upload_status for r in gate(cand, existing).collect()}
    assert got == {"a": "skipped_existing", "b": "uploaded"}
    assert {r.upload_status for r in gate(cand, existing, force=True).collect()} == {"uploaded"}


def test_upsert_idempotent_and_fold_equals_sequential(spark):
    from snapmart.operators.merge import fold_latest, upsert
    schema = "k long, v string, t int"
    s1 = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n1", 1)], schema)
    s2 = spark.createDataFrame([(2, "B", 2), (3, "c", 2), (None, "n2", 2)], schema)
    seq = upsert(upsert(spark.createDataFrame([], schema), s1, "k"), s2, "k")
    again = upsert(seq, s2, "k")
    fold = fold_latest(s1.unionByName(s2), "k", [F.col("t").desc()], null_key_by=["t"])
    rows = lambda df: sorted(df.collect(), key=lambda r: (r.k is None, r.k or 0, r.v))
    assert rows(seq) == rows(fold)
    assert [(r.k, r.v) for r in rows(seq)] == [(1, "a"), (2, "B"), (3, "c"), (None, "n1"), (None, "n2")]
    # merging the same snapshot again changes nothing except the NULL key, which never matches
    assert len(again.collect()) == len(seq.collect()) + 1


def test_load_plan_twice_equals_once_and_reload(spark):
    from snapmart.operators.loads import plan_loads
    audit_schema = "source string, s3_key string, target_table string, rows_loaded bigint, status string, loaded_at timestamp_ntz"
    cand = spark.createDataFrame([("rawg", "k1", 3)], "source string, s3_key string, rows_loaded long")
    empty = spark.createDataFrame([], audit_schema)
    first = plan_loads(cand, empty, loaded_at="2026-04-01 10:00:00")
    log1 = empty.unionByName(first)
    second = plan_loads(cand, log1, loaded_at="2026-04-01 11:00:00")
    log2 = log1.unionByName(second)
    forced = plan_loads(cand, log2, force=True, loaded_at="2026-04-01 12:00:00")
    log3 = log2.unionByName(forced)
    assert [(r.status, r.rows_loaded) for r in log3.orderBy("loaded_at").collect()] == [
        ("loaded", 3), ("skipped_existing", 0), ("reloaded", 3)]
    from snapmart.plans.marts import mart_pipeline_load_summary
    s = mart_pipeline_load_summary(log3).first()
    assert (s.load_attempts, s.successful_loads, s.skipped_existing_loads, s.total_rows_loaded) == (3, 1, 1, 6)
    with pytest.raises(Exception):
        plan_loads(spark.createDataFrame([("epic", "k", 1)], "source string, s3_key string, rows_loaded long"),
                   empty).collect()


def test_versioned_table_write(spark):
    from snapmart.sources import catalog
    root = fresh_dir(spark, "tbl")
    assert catalog.read_current(spark, root) is None
    catalog.write_version(spark.range(3), root)
    cur = catalog.read_current(spark, root)
    # the next version is computed from the current one (T19 safe)
    catalog.write_version(cur.withColumn("id", F.col("id") + 10), root)
    assert sorted(r.id for r in catalog.read_current(spark, root).collect()) == [10, 11, 12]


def test_create_objects(spark):
    from snapmart.sources import catalog
    root = fresh_dir(spark, "wh")
    catalog.create_objects(spark, root)
    catalog.create_objects(spark, root)  # idempotent
    assert {r.namespace for r in spark.sql("SHOW DATABASES").collect()} >= {"raw", "staging", "mart"}
    assert spark.table("raw.raw_load_audit").columns == ["source", "s3_key", "target_table", "rows_loaded", "status",
                                                         "loaded_at", "batch"]
    other = fresh_dir(spark, "wh")
    catalog.create_objects(spark, other)  # another root: declared anew
    assert other in spark.sql("DESCRIBE TABLE EXTENDED raw.raw_load_audit").where("col_name = 'Location'").first()["data_type"]


def test_quality_checks(spark):
    from snapmart.operators import quality
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b")], "id long, name string")
    nn = {(r.column_name, r.failures, r.status) for r in quality.not_null(df, "m", ["id", "name"]).collect()}
    assert nn == {("id", 1, "fail"), ("name", 1, "fail")}
    assert quality.unique(df, "m", "id").first().failures == 1
    raw = spark.createDataFrame([("2026-04-01 09:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("extracted_at"))
    st = lambda now: quality.freshness(raw, "rawg", now).first().status
    assert (st("2026-04-03 09:00:00"), st("2026-04-03 09:00:01"), st("2026-04-08 09:00:01")) == ("pass", "warn", "error")
    assert quality.failed(quality.report(quality.unique(df, "m", "id")))


def test_envelopes_stay_bounded_for_a_hot_snapshot_of_copies(spark):
    from snapmart.sources.envelope import build_envelopes
    # 3,000 identical entries, all in one snapshot, spread over several scan partitions
    rows = spark.range(3000, numPartitions=3).select(
        F.lit("2026-04-01 09:00:00").cast("timestamp_ntz").alias("snap"),
        F.struct(F.lit(1).alias("id"), F.lit("same").alias("name")).alias("entry"))
    env = build_envelopes(rows.withColumn("_row_id", F.monotonically_increasing_id()), "rawg", "snap", "entry", per_envelope=50)
    sizes = env.select(F.size(F.variant_get(F.parse_json("body"), "$.payload.results", "array<variant>")).alias("n"))
    got = [r.n for r in sizes.collect()]
    assert sum(got) == 3000 and max(got) <= 50 and len(got) >= 60


def test_variants_stay_whole_in_sessions_built_here_and_elsewhere(spark):
    from snapmart.session import use_unshredded_variants
    key = "spark.sql.variant.writeShredding.enabled"
    assert spark.conf.get(key) == "false"
    other = spark.newSession()
    other.conf.set(key, "true")
    use_unshredded_variants(other)
    assert other.conf.get(key) == "false"


def test_malformed_store_document_raises(spark):
    from snapmart.sources import category
    df = spark.createDataFrame([(1, '{"a": {"name": "A", "items": [{"id": 1}'), (2, '{"a": {"items": []}}')], "k int, doc string")
    with pytest.raises(Exception):
        category.flatten_categories(df, "doc", ["k"]).count()
    with pytest.raises(Exception):
        df.select(category.item_count("doc")).collect()


def test_item_count_equals_the_flatten(spark):
    from snapmart.sources import category
    docs = spark.createDataFrame([(1, json.dumps(fx.STORE_DOC)), (2, "{}"), (3, '{"a": 5, "b": {"items": 3}, "c": {"items": [1, 2]}}')],
                                 "doc_no int, doc string")
    got = {r.doc_no: r.n for r in docs.select("doc_no", category.item_count("doc").alias("n")).collect()}
    flat = category.flatten_categories(docs, "doc", ["doc_no"]).groupBy("doc_no").count()
    assert got == {2: 0, **{r.doc_no: r["count"] for r in flat.collect()}}


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from snapmart import session

    class Context:
        master, applicationId = "yarn", "a"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        session.scratch_root(Session())


def test_old_versions_and_scratch_folders_go(spark):
    from snapmart.session import release_scratch
    from snapmart.sources import catalog
    root = fresh_dir(spark, "tbl")
    made = [os.path.basename(catalog.write_version(spark.range(k), root)) for k in range(4)]
    half = os.path.join(root, made[0].replace("version=0", "version=00", 1)[:24] + "-half")
    os.makedirs(half)
    gone = catalog.expire_versions(spark, root, 2)
    assert set(made[:2]) <= set(gone) and not os.path.exists(half)
    assert catalog.read_current(spark, root).count() == 3
    assert catalog.expire_versions(spark, root, 2) == []
    other = spark.newSession()
    path = fresh_dir(other, "gone")
    other.range(1).write.parquet(path)
    from snapmart import session
    kept = session._FRESH.pop(spark.sparkContext.applicationId)
    session._FRESH[spark.sparkContext.applicationId] = [path]
    assert release_scratch(other) == 1 and not os.path.exists(path)
    session._FRESH[spark.sparkContext.applicationId] = [p for p in kept if p != path]


def _envelopes(spark, n, day="2026-04-01"):
    rows = [("rawg", day, f"raw/source=rawg/extract_date={day}/rawg_games_{k}.json",
             json.dumps({"source": "rawg", "extracted_at_utc": f"{day}T09:00:00Z", "payload": {"results": [{"id": k}]}})) for k in range(n)]
    return spark.createDataFrame(rows, "source string, extract_date string, s3_key string, body string")


def test_landing_by_key_gates_before_the_write_and_replaces_when_forced(spark):
    from snapmart.sources import jsonscan, landing
    root = fresh_dir(spark, "landing")
    assert landing.landed_keys(spark, root) is None
    status = lambda df: sorted((r.s3_key[-6], r.upload_status) for r in df.collect())
    assert status(landing.land(_envelopes(spark, 2), root)) == [("0", "uploaded"), ("1", "uploaded")]
    assert status(landing.land(_envelopes(spark, 3), root)) == [("0", "skipped_existing"), ("1", "skipped_existing"), ("2", "uploaded")]
    lines = lambda: spark.read.text(f"{root}/{landing.DATA}").count()
    assert lines() == 3
    changed = _envelopes(spark, 1).withColumn("body", F.regexp_replace("body", '"id": 0', '"id": 99'))
    landing.land(changed, root, force=True)
    assert lines() == 4
    ids = lambda df: sorted(r.i for r in df.select(as_number("payload", "$.payload.results[0].id").alias("i")).collect())
    assert ids(jsonscan.scan_keys(spark, root, landing.landed_keys(spark, root))) == [1, 2, 99]
    # lines of a write whose keys were never listed are not part of the landing
    spark.createDataFrame([("rawg", "2026-04-01", "unfinished", '{"landing_key":"x","payload":{}}')], "source string, extract_date string, file string, value string") \
        .write.mode("append").partitionBy("source", "extract_date", "file").text(f"{root}/{landing.DATA}")
    assert ids(jsonscan.scan_keys(spark, root, landing.landed_keys(spark, root))) == [1, 2, 99]
    key = "raw/source=rawg/extract_date=2026-04-01/rawg_games_2.json"
    assert ids(jsonscan.load_key(spark, root, key)) == [2]
    assert jsonscan.load_key(spark, root, key.replace("_2", "_7")).count() == 0


def test_envelopes_do_not_depend_on_the_splits(spark):
    from snapmart.plans import world
    sf = "/root/testdata/sf0.001"
    first = {(r.envelope_no, r.extracted_at, r.body) for r in world.order_envelopes(spark, sf, 20).bodies().collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        again = {(r.envelope_no, r.extracted_at, r.body) for r in world.order_envelopes(spark, sf, 20).bodies().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == again and len({(n, t) for n, t, _ in first}) == len(first)


@pytest.mark.parametrize("every", ["year", "month"])
def test_mean_envelope_size_is_near_the_stated_one(spark, every):
    from snapmart.plans import world
    env = world.order_envelopes(spark, "/root/testdata/sf0.01", 50, every=every).bodies()
    n = env.select(F.size(F.variant_get(F.parse_json("body"), "$.payload.results", "array<variant>")).alias("n"))
    mean, most = n.agg(F.avg("n"), F.max("n")).first()
    assert 0.7 * 50 <= mean <= 50 and most <= 50


def test_null_names_are_spread_and_match_nothing(spark):
    from snapmart.operators.joins import left_join_on_name
    left = spark.createDataFrame([(k, None) for k in range(50)] + [(99, " A ")], "k long, name string")
    right = spark.createDataFrame([("a", 7), (None, 8)], "key string, v long")
    rows = left_join_on_name(left, right, "name", "key").collect()
    assert sorted((r.k, r.v) for r in rows if r.v is not None) == [(99, 7)] and len(rows) == 51


def test_one_pass_column_tests_equal_single_ones(spark):
    from snapmart.operators import quality
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (None, None), (2, "c")], "id long, name string")
    both = quality.column_tests(df, "m", ["id", "name"], ["id"])
    single = quality.not_null(df, "m", ["id", "name"]).unionByName(quality.unique(df, "m", "id"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, single.select(*both.columns).collect()))
    empty = quality.column_tests(df.limit(0), "m", ["name"], ["id"]).collect()
    assert {r.failures for r in empty} == {0} and len(empty) == 2


def test_category_flatten_skips_non_objects(spark):
    from snapmart.sources import category
    doc = ('{"a": {"name": "A", "items": [{"id": 1}]}, "s": "{\\"items\\": [{\\"id\\": 9}]}", "n": 5, '
           '"arr": [{"items": [1]}], "b": {"items": [{"id": 2}]}, "e": {"name": "E"}}')
    df = spark.createDataFrame([(1, doc)], "k int, doc string")
    rows = category.flatten_categories(df, "doc", ["k"]).select(
        "category_key", "category_name", as_number("item", "$.id").alias("id")).collect()
    assert [tuple(r) for r in rows] == [("a", "A", 1), ("b", None, 2)]


def test_a_plan_lands_only_new_envelopes_and_its_keys_are_those_of_its_bodies(spark):
    from snapmart.plans import world
    from snapmart.sources import jsonscan, landing
    sf, root = "/root/testdata/sf0.001", fresh_dir(spark, "landing")
    plan = world.order_envelopes(spark, sf, 20)
    keys = {(r.envelope_no, r.extracted_at) for r in plan.keys().collect()}
    bodies = {(r.envelope_no, r.extracted_at): r.body for r in plan.bodies().collect()}
    assert keys == set(bodies)
    half = landing.envelope_keys(plan.bodies()).where("envelope_no % 2 = 0")
    n_half = half.count()
    landing.land(half, root)
    status = landing.land(plan, root)
    assert status.where("upload_status = 'skipped_existing'").count() == n_half
    got = jsonscan.scan_keys(spark, root, landing.landed_keys(spark, root))
    assert got.count() == len(bodies) == got.select("s3_key").distinct().count()
    total = got.agg(F.sum(F.size(F.variant_get("payload", "$.payload.results", "array<variant>")))).first()[0]
    assert total == spark.read.parquet(f"{sf}/orders.parquet").count()
    # half of one file's keys: lines are compared with keys
    some = landing.landed_keys(spark, root).where("substring(s3_key, -6, 1) = '1'")
    assert jsonscan.scan_keys(spark, root, some).count() == some.count() > 0


def test_one_key_opens_one_file(spark):
    from snapmart.plans import world
    from snapmart.sources import jsonscan, landing
    root = fresh_dir(spark, "landing")
    landing.land(world.order_envelopes(spark, "/root/testdata/sf0.001", every="month"), root)
    key = landing.landed_keys(spark, root).first()["s3_key"]
    scan = jsonscan.load_key(spark, root, key)
    assert len(scan.inputFiles()) == 1 and [r.s3_key for r in scan.collect()] == [key]


def test_a_write_without_all_its_envelopes_lists_nothing(spark):
    import dataclasses
    from snapmart.plans import world
    from snapmart.sources import landing
    root = fresh_dir(spark, "landing")
    plan = world.order_envelopes(spark, "/root/testdata/sf0.001", 20)
    torn = dataclasses.replace(plan, rows=plan.rows.where("extracted_at > '1997-01-01'"))
    with pytest.raises(landing.IncompleteLanding):
        landing.land(torn, root)
    assert landing.landed_keys(spark, root) is None


def test_key_stream_loads_each_key_once_and_unlisted_lines_never(spark):
    from snapmart.sources import landing
    from snapmart.streaming.file_load import load_keys_stream
    root, raw, ckpt = fresh_dir(spark, "landing"), fresh_dir(spark, "raw"), fresh_dir(spark, "ckpt")
    landing.land(_envelopes(spark, 3), root)
    landing.land(_envelopes(spark, 2), root, force=True)
    spark.createDataFrame([("rawg", "2026-04-01", "unfinished", '{"landing_key":"x","payload":{}}')], "source string, extract_date string, file string, value string") \
        .write.mode("append").partitionBy("source", "extract_date", "file").text(f"{root}/{landing.DATA}")
    load_keys_stream(spark, root, raw, ckpt)
    landing.land(_envelopes(spark, 4), root, force=True)
    load_keys_stream(spark, root, raw, ckpt)
    rows = spark.read.parquet(raw)
    assert sorted(r.s3_key[-6] for r in rows.select("s3_key").collect()) == ["0", "1", "2", "3"]


def test_manifest_merge_is_one_commit_and_touches_only_its_buckets(spark):
    from snapmart.operators.merge import BUCKET_COL, upsert
    from snapmart.sources import manifest
    root, schema = fresh_dir(spark, "bucketed"), "k long, v string"
    assert manifest.read(spark, root) is None
    first = spark.range(100).selectExpr("id AS k", "concat('v', id) AS v").unionByName(spark.createDataFrame([(None, "n")], schema))
    assert manifest.merge(spark, first, root, "k", 16) == [-1, *range(16)]
    before = manifest.current(spark, root)
    upd = spark.createDataFrame([(3, "new3"), (1000, "new1000"), (None, "n")], schema)
    reader = manifest.read(spark, root)

    def die():
        raise RuntimeError("killed before the commit")

    with pytest.raises(RuntimeError):
        manifest.merge(spark, upd, root, "k", 16, before_commit=die)
    assert manifest.current(spark, root) == before and manifest.read(spark, root).count() == 101
    touched = manifest.merge(spark, upd, root, "k", 16)
    after = manifest.current(spark, root)
    assert -1 in touched and 2 <= len(touched) <= 3
    assert all(after["folders"][str(b)] == before["folders"][str(b)] for b in range(16) if b not in touched)
    want = upsert(first, upd, "k")  # NULL keys are inserted again (T10)
    got = manifest.read(spark, root).drop(BUCKET_COL)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert reader.count() == 101  # a plan made before reads what it was made for
    only = manifest.read(spark, root, only=[b for b in touched if b >= 0])
    assert {r[0] for r in only.select(BUCKET_COL).distinct().collect()} == set(touched) - {-1}
    with pytest.raises(manifest.CommitConflict):
        manifest.merge(spark, upd, root, "k", 16, before_commit=lambda: manifest.merge(spark, upd.where("k = 3"), root, "k", 16))
    rows = manifest.read(spark, root).count()
    assert manifest.expire(spark, root, 1) and manifest.read(spark, root).count() == rows
    assert len(manifest.published(spark, f"{root}/{manifest.MANIFESTS}")) == 1


def test_a_merge_counts_what_the_checks_ask(spark):
    from snapmart.operators import quality
    from snapmart.sources import manifest
    root, schema = fresh_dir(spark, "counted"), "k long, v string"
    runs = [[(1, "a"), (2, None), (2, "b"), (None, None), (None, "n")],
            [(2, "c"), (3, None), (4, "d"), (4, None), (4, "e")],  # 2 is mended, 4 comes three times
            [(None, None), (5, None)],
            [(4, "only"), (3, "x")],
            []]
    for rows in runs:
        manifest.merge(spark, spark.createDataFrame(rows, schema), root, "k", 4, watch=["k", "v"])
        table, counts = manifest.read(spark, root), manifest.current(spark, root)["counts"]
        want = {(r["column_name"], r["test"]): r["failures"] for r in quality.column_tests(table, "m", ["k", "v"], ["k"]).collect()}
        assert counts["rows"] == table.count()
        assert {("k", "unique"): counts["twice"], **{(c, "not_null"): n for c, n in counts["nulls"].items()}} == want


def test_counted_checks_scan_no_written_mart(spark):
    from snapmart.plans import checks
    nothing = {m: spark.range(0).selectExpr(*[f"cast(NULL AS string) AS {c}" for c in cols]) for m, cols in checks.NOT_NULL.items()}
    counted = {"mart_games": {"not_null": {"rawg_game_id": 0, "game_name": 3}, "unique": {"rawg_game_id": 1}},
               "mart_platform_coverage": {"not_null": {"platform_name": 2}}}
    got = {(r["model"], r["column_name"], r["test"]): (r["failures"], r["status"]) for r in checks.all_checks(nothing, None, counted).collect()}
    assert got["mart_games", "game_name", "not_null"] == (3, "fail") and got["mart_games", "rawg_game_id", "unique"] == (1, "fail")
    assert got["mart_games", "rawg_game_id", "not_null"] == (0, "pass") and got["mart_platform_coverage", "platform_name", "not_null"] == (2, "fail")
    assert set(got) == {(r["model"], r["column_name"], r["test"]) for r in checks.all_checks(nothing).collect()}


def test_latest_snapshot_from_the_ledger_prunes_batches(spark):
    from snapmart.sources import ledger
    wh = fresh_dir(spark, "warehouse")
    assert ledger.latest_raw(spark, wh, "rawg_games_raw", "rawg").count() == 0
    for day, times in (("1", ["2026-04-01 09:00:00", None]), ("2", ["2026-04-02 09:00:00", "2026-04-01 09:00:00"]), ("3", ["2026-04-02 09:00:00"]), ("4", [None])):
        rows = spark.createDataFrame([("rawg", f"{day}-{k}", t) for k, t in enumerate(times)], "source string, s3_key string, t string").select(
            "source", "s3_key", F.col("t").cast("timestamp_ntz").alias("extracted_at"), F.parse_json(F.lit("{}")).alias("payload"),
            F.lit("2026-04-03 00:00:00").cast("timestamp_ntz").alias("loaded_at"))
        rows.write.parquet(ledger.batch_path(wh, "rawg_games_raw", day))
        rows.groupBy("source", "extracted_at").agg(F.count("*").alias("n_rows")).write.parquet(ledger.batch_path(wh, ledger.SNAPSHOTS, day))
        if day != "4":
            ledger.commit(spark, wh, day)
    latest = ledger.latest_raw(spark, wh, "rawg_games_raw", "rawg")
    assert sorted(r.s3_key for r in latest.collect()) == ["2-0", "3-0"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch" in plan and "EqualTo(extracted_at" in plan and "ScalarSubquery" not in plan
    assert ledger.sweep(spark, wh) == ["rawg_games_raw/batch=4", "snapshots/batch=4"]


def test_head_in_place_equals_a_plain_head(spark):
    from snapmart.sources import category
    docs, want, total = [], [], {}
    for snap in ("s1", "s2"):
        every = []
        for doc in range(6):
            sizes = [(doc * 7 + c * 3) % 5 if snap == "s1" else 0 for c in range(3)]
            cats = {f"c{c}": {"name": f"C{c}", "items": [{"id": doc * 100 + c * 10 + k} for k in range(n)]} for c, n in enumerate(sizes)}
            docs.append((snap, doc, json.dumps({**cats, "none": {"name": "x"}, "status": 1})))
            every += [(c, doc, k, doc * 100 + c * 10 + k) for c, n in enumerate(sizes) for k in range(n)]
        total[snap] = len(every)
        want += [(snap, f"c{c}", i, rank + 1, len(every)) for rank, (c, d, k, i) in enumerate(sorted(every)[:11])]
    df = spark.createDataFrame(docs, "snap string, doc_no int, doc string")
    head = category.head_in_place(df, "doc", ["snap"], ["doc_no"], 11)
    got = head.select("snap", "category_key", as_number("item", "$.id").alias("i"), "item_rank", "total_available").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 11


def test_growth_states_of_several_loads_merge_exactly(spark):
    from snapmart.operators import growth

    def raw(rows):
        return spark.createDataFrame([(t, json.dumps({"payload": {"results": [{"id": i} for i in ids]}})) for t, ids in rows], "t string, p string").select(
            F.col("t").cast("timestamp_ntz").alias("extracted_at"), F.parse_json("p").alias("payload"))

    a = raw([("2026-04-01 09:00:00", [1, 2, 2, None, 70_000]), ("2026-04-02 09:00:00", [2])])
    b = raw([("2026-04-01 09:00:00", [2, 3]), ("2026-04-03 09:00:00", [None]), ("2026-04-04 09:00:00", [9, 10])])
    states = growth.snapshot_state(a).unionByName(growth.snapshot_state(b))
    got = [(r.game_count, r.prev_game_count, r.delta_games) for r in growth.catalog_growth(states).orderBy("extracted_at").collect()]
    assert got == [(4, None, 4), (1, 4, -3), (0, 1, -1), (2, 0, 2)]
