"""What keeps shuffles, spills and written bytes in proportion to the input: plans, codecs and bounded tasks."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from snapmart.plans import marts, queries, staging, world
from snapmart.session import fresh_dir
from snapmart.sources import category, envelope, jsonscan, landing

from . import fixtures as fx

SF = "/root/testdata/sf0.001"


def _json_below_the_deal(spark, df) -> list[str]:
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    deal = next(k for k, line in enumerate(lines) if "Repartition" in line)
    assert any("ToJson" in line for line in lines[:deal])
    return [line for line in lines[deal:] if "ToJson" in line]


def _entries(spark):
    rows = [(k, k % 3, None if k % 7 == 0 else "é'%d\"" % k) for k in range(900)]
    df = spark.createDataFrame(rows, "k long, s int, name string")
    return df.select(F.col("k").alias("_row_id"), F.make_date(F.lit(2026), F.col("s") + 1, F.lit(1)).cast("timestamp_ntz").alias("snap"), "k", "name")


def test_envelopes_and_documents_are_shuffled_as_fields_not_as_texts(spark):
    assert not _json_below_the_deal(spark, world.both_envelopes(spark, SF).bodies())
    assert not _json_below_the_deal(spark, world.order_envelopes(spark, SF).bodies())
    assert not _json_below_the_deal(spark, world.store_documents(spark, SF))


def test_tasks_that_build_envelopes_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(envelope, "CHUNKS_PER_FILE", 2)
    plan = lambda: envelope.plan_envelopes(_entries(spark).withColumn("entry", F.struct("k", "name")), "rawg", "snap", "entry", per_envelope=10)
    few = plan().bodies()
    monkeypatch.setattr(envelope, "ROWS_PER_TASK", 50)
    many = plan().bodies()
    tasks = [df.rdd.getNumPartitions() for df in (few, many)]
    assert tasks[0] == int(spark.conf.get("spark.sql.shuffle.partitions")) and tasks[1] == 18
    assert sorted(r.body for r in few.collect()) == sorted(r.body for r in many.collect())


def test_sources_of_the_same_rows_hold_the_same_entries(spark, monkeypatch):
    monkeypatch.setattr(envelope, "ROWS_PER_TASK", 100)
    sources = {"rawg": ("results", F.struct(F.col("k").alias("id"), "name")), "steam": ("featured_categories", F.struct(F.col("k").alias("id"), "snap"))}
    plan = envelope.plan_envelopes(_entries(spark), sources, "snap", per_envelope=20)
    single = envelope.plan_envelopes(_entries(spark).withColumn("entry", F.struct(F.col("k").alias("id"), "name")), "rawg", "snap", "entry", per_envelope=20)
    bodies = plan.bodies().collect()
    assert {(r.envelope_no, r.body) for r in bodies if r.source == "rawg"} == {(r.envelope_no, r.body) for r in single.bodies().collect()}
    assert {(r.source, r.extracted_at, r.envelope_no) for r in bodies} == {(r.source, r.extracted_at, r.envelope_no) for r in plan.keys().collect()}
    root = fresh_dir(spark, "landing")
    landing.land(plan, root)
    assert {r.upload_status for r in landing.land(plan, root).collect()} == {"skipped_existing"}
    n = F.size(F.coalesce(F.variant_get("payload", "$.payload.results", "array<variant>"), F.variant_get("payload", "$.payload.featured_categories", "array<variant>")))
    got = jsonscan.scan_keys(spark, root, landing.landed_keys(spark, root)).groupBy("source").agg(F.sum(n).alias("n")).collect()
    assert {r.source: r.n for r in got} == {"rawg": 900, "steam": 900}
    files = glob.glob(f"{root.removeprefix('file:')}/{landing.DATA}/**/part-*", recursive=True)
    assert files and all(f.endswith(".gz") for f in files)


def test_raw_rows_are_written_compressed(spark):
    world.raw_tables(spark, SF)
    path = world.written(spark, SF, "raw", None).removeprefix("file:")
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(c).compression for f in glob.glob(f"{path}/**/*.parquet", recursive=True) for c in range(2)}
    assert codecs == {"ZSTD"}


def _raw(spark):
    g = lambda k, **more: {"id": k, "name": f"g{k}", "genres": [{"id": 1, "name": f"x{k}"}], "platforms": [{"platform": {"id": 2, "name": "PC"}}], **more}
    snaps = [("a", fx.SNAP_A, [g(1, rating=1.0), g(2, rating=2.0), g(3), g(None, slug="a")]),
             ("b", fx.SNAP_B, [g(2, rating=3.0, genres=[]), g(None, slug="b"), g(None, slug="b2")]), ("c", fx.SNAP_B, [g(4), g(2, genres=[{"id": 9, "name": "late"}])])]
    bodies = [(k, t, fx.envelope("rawg", t, {"results": rows})) for k, t, rows in snaps]
    return (spark.createDataFrame(bodies, "s3_key string, t string, body string")
            .select(F.lit("rawg").alias("source"), "s3_key", F.to_timestamp_ntz(F.regexp_replace("t", "Z$", "")).alias("extracted_at"),
                    F.parse_json("body").alias("payload"), F.lit("2026-05-01").cast("timestamp_ntz").alias("loaded_at")))


def test_last_runs_are_found_without_moving_entries(spark):
    raw = _raw(spark)
    timeless = raw.unionByName(raw.where("s3_key = 'a'").withColumns({"s3_key": F.lit("n"), "extracted_at": F.lit(None).cast("timestamp_ntz")}))
    gid = F.variant_get("game", "$.id", "bigint")
    seen = lambda r: sorted((x.s3_key, x.id or 0) for x in marts.last_run_entries(
        r, staging.flattened_games(r, True).withColumn("rawg_game_id", gid)).select("s3_key", F.col("rawg_game_id").alias("id")).collect())
    plan = marts.game_entities(raw, fold_first=True)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "rank(" not in plan
    for most in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        assert seen(raw) == [("a", 0), ("a", 1), ("a", 3), ("b", 0), ("b", 0), ("b", 2), ("c", 2), ("c", 4)]
        assert seen(timeless) == [("a", 0), ("b", 0), ("b", 0), ("c", 4), ("n", 0), ("n", 1), ("n", 2), ("n", 3)]
        assert seen(raw.limit(0)) == [] and len(seen(raw.where("s3_key = 'a'"))) == 4
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    games = {r.rawg_game_id: r.genres for r in marts.games_fused(raw, fold_first=True).where("rawg_game_id is not null").collect()}
    assert games == {1: "x1", 2: "late", 3: "x3", 4: "x4"}


def test_entities_are_sorted_and_shuffled_typed(spark):
    raw = _raw(spark)
    for df in (marts.game_entities(raw, fold_first=True), marts.game_entities(raw, per_snapshot=False, with_fields=False)):
        assert not any("variant" in t for _, t in df.dtypes)


def test_a_head_and_its_total_take_one_pass(spark):
    items = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (None, 0, "d"), (1, 2, "e")], "doc_no int, p int, item string")
    head = category.head_with_total(items, ["doc_no"], [F.col("p")], 2)
    assert sorted((r.doc_no, r.item, r.item_rank, r.total_available) for r in head.collect()) == [(1, "a", 1, 3), (1, "b", 2, 3), (2, "c", 1, 1)]
    plan = head._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Join" not in plan


def test_the_store_pipeline_stages_what_it_stored(spark):
    plan = queries.REGISTRY["store_pipeline"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "collect_list" not in plan and "parse_json" not in plan
