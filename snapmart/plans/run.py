"""The daily run as one driver program: stage → mart → check.

``build_models`` wires every staging model and mart lazily from the raw
tables; nothing is computed until a model is written or checked (but for the ids of
games that are gone from the newest run, ``marts.last_run_entries``, with ``history``).
``mart`` is a game mart that is there already, ``staged`` what ``stage`` wrote.  ``history=True`` replays every snapshot (one run per snapshot, folded into the
accumulating mart); ``history=False`` is a single run on the latest snapshot,
merged into ``previous_mart`` when one is given.
"""

from __future__ import annotations

from itertools import islice
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.operators.merge import upsert
from snapmart.operators.rollup import STORE_ROLLUP_COLUMNS
from snapmart.plans import marts, staging
from snapmart.session import fresh_dir, release_dirs
from snapmart.sources.catalog import COMPRESSION


class Staged(NamedTuple):
    """A run's staged rows, written: the newest snapshot's game entities (``marts.game_entities``) and store offers, and their folders."""

    entities: DataFrame
    offers: DataFrame
    paths: list[str]


#: The columns of the staged entities and offers that marts and column tests read.
STAGED_ENTITIES = ["extracted_at", "kind", "rawg_game_id", "child_id", "name", "game", "released_at"]
STAGED_OFFERS = ["game_name", *(c for _, c in STORE_ROLLUP_COLUMNS)]


def stage(raw_rawg: DataFrame, raw_steam: DataFrame) -> Staged:
    """Take the newest snapshot's payloads apart once, typed and deduplicated; what marts and column tests read then
    is these few columns, not the payloads again."""
    spark = raw_rawg.sparkSession
    entities = marts.game_entities(raw_rawg, per_snapshot=False, with_released=True).select(*STAGED_ENTITIES)
    offers = staging.stg_steam_featured_games(raw_steam).select(*STAGED_OFFERS)
    wanted = [(entities, fresh_dir(spark, "staged-entities")), (offers, fresh_dir(spark, "staged-offers"))]
    for df, path in wanted:
        df.write.option("compression", COMPRESSION).parquet(path)
    return Staged(*(spark.read.schema(df.schema).parquet(path) for df, path in wanted), [path for _, path in wanted])


def build_models(raw_rawg: DataFrame, raw_steam: DataFrame, audit: DataFrame, history: bool = True,
                 previous_mart: DataFrame | None = None, mart: DataFrame | None = None,
                 staged: Staged | None = None) -> dict[str, DataFrame]:
    m: dict[str, DataFrame] = {
        "stg_rawg_games": staging.stg_rawg_games(raw_rawg),
        "stg_rawg_game_genres": staging.stg_rawg_game_genres(raw_rawg),
        "stg_rawg_game_platforms": staging.stg_rawg_game_platforms(raw_rawg),
        "stg_steam_featured_games": staging.stg_steam_featured_games(raw_steam),
        "stg_raw_load_audit": staging.stg_raw_load_audit(audit),
    }
    if mart is not None:
        pass
    elif history:
        mart = marts.accumulated_games_fused(raw_rawg, raw_steam)
    else:
        mart = marts.mart_games_fused(raw_rawg, m["stg_steam_featured_games"] if staged is None else staged.offers, per_snapshot=False,
                                      entities=None if staged is None else staged.entities)
        if previous_mart is not None:
            mart = upsert(previous_mart, mart, "rawg_game_id")
    m["mart_games"] = mart
    platforms = m["stg_rawg_game_platforms"] if staged is None else marts.entity_platforms(staged.entities)
    m["mart_platform_coverage"] = marts.mart_platform_coverage(platforms, sort=False)
    m["mart_top_rated_games"] = marts.mart_top_rated_games(mart)
    m["mart_pipeline_load_summary"] = marts.mart_pipeline_load_summary(m["stg_raw_load_audit"], sort=False)
    return m


VERSIONED_MARTS = ("mart_platform_coverage", "mart_top_rated_games", "mart_pipeline_load_summary")
#: Key buckets of the game mart, fixed by its first merge: so many that one holds some GB at most.
MART_BUCKETS = 16
#: Plain files that one scan names.
FILES_AT_ONCE = 10_000


def materialize(models: dict[str, DataFrame], root: str, buckets: int = MART_BUCKETS, before_commit=None,
                counted: dict | None = None) -> dict[str, DataFrame]:
    """Write the marts (staging stays as views) and return the models re-pointed at the written
    tables, in dependency order: the top-N mart is built from the *written* game mart.

    The game mart accumulates: the run's games are merged into its key buckets
    (``sources.manifest``), so only the buckets they touch are rewritten and readers see the
    mart before or after the merge.  The others are written as new table versions.
    ``counted``, if given, receives what the writes counted for the column tests
    (model -> test -> column -> failures).
    """
    from snapmart.plans.checks import NOT_NULL, UNIQUE
    from snapmart.sources import catalog, manifest

    spark = models["mart_games"].sparkSession
    out, counted = dict(models), {} if counted is None else counted
    table, [key] = f"{root}/mart_games", UNIQUE["mart_games"]
    manifest.merge(spark, models["mart_games"], table, key, buckets, before_commit, NOT_NULL["mart_games"])
    totals = manifest.current(spark, table).get("counts")
    if totals:
        counted["mart_games"] = {"not_null": totals["nulls"], "unique": {key: totals["twice"]}}
    written = manifest.read(spark, table)
    out["mart_games"] = models["mart_games"].limit(0) if written is None else written.drop(manifest.BUCKET_COL)
    out["mart_top_rated_games"] = marts.mart_top_rated_games(out["mart_games"])
    for name in VERSIONED_MARTS:
        counted[name] = {"not_null": catalog.write_counted(out[name], catalog.new_version(f"{root}/{name}"), NOT_NULL[name])}
        out[name] = catalog.read_current(spark, f"{root}/{name}")
    return out


def load_landed(spark, landing_root: str, warehouse: str, extract_date: str | None, force_reload: bool = False, loaded_at=None,
                multi_line: bool = True, before_commit=None) -> DataFrame:
    """Load a day's landed keys and plain files (all days' without one) into the raw tables; returns the audit rows.

    All candidates are planned against the audit log in one join.  Picked ones are opened once
    and written once, below the load's own ``batch=``; rows are counted from what was written.
    The audit rows go beside them, and the ledger's one entry makes both count
    (``sources.ledger``): a load that dies before leaves nothing that counts, and one that is
    repeated loads every key once.  ``before_commit`` is called right before that (for tests).
    """
    from snapmart.operators import growth
    from snapmart.operators.loads import SOURCE_TABLES, STATUS_SKIPPED, plan_status, rows_per_file
    from snapmart.session import use_unshredded_variants
    from snapmart.sources import catalog, landing, ledger
    from snapmart.sources.jsonscan import plain_files, scan_keys, scan_landing, to_raw

    ts = F.lit(loaded_at).cast("timestamp_ntz") if isinstance(loaded_at, str) else loaded_at
    if ts is None:
        ts = F.lit(spark.sql("SELECT cast(current_timestamp() AS timestamp_ntz)").first()[0])
    keys = landing.landed_keys(spark, landing_root, extract_date)
    files = plain_files(spark, landing_root, extract_date, keys)
    if keys is not None:
        files = files.unionByName(keys.select("source", "extract_date", "s3_key", "batch", "file", "in_file"), allowMissingColumns=True)
    plan_dir = fresh_dir(spark, "load-plan")
    plan_status(files, ledger.read(spark, warehouse, "raw_load_audit"), force=force_reload).write.parquet(plan_dir)
    plan = spark.read.parquet(plan_dir)
    picked = plan.where(F.col("status") != STATUS_SKIPPED)
    batch = ledger.new_batch()
    use_unshredded_variants(spark)

    def copy(scan: DataFrame, source: str) -> None:
        rows = to_raw(scan.where(F.col("source") == source), key_col="s3_key", loaded_at=ts)
        rows.write.mode("append").options(**catalog.RAW_OPTIONS).parquet(ledger.batch_path(warehouse, SOURCE_TABLES[source].lower(), batch))

    loaded = None
    by_key = "batch" in plan.columns
    for source, some in sorted((r["source"], r["plain"]) for r in picked.groupBy("source").agg(F.count("file_path").alias("plain")).collect()):
        here = picked.where(F.col("source") == source)
        if by_key:
            copy(scan_keys(spark, landing_root, here.where("batch IS NOT NULL"), extract_date, source), source)
        if some:
            # paths prune the scan, so a skipped file is not opened; however many there are, few are planned at a time
            names = (r["file_path"] for r in here.where("file_path IS NOT NULL").select("file_path").toLocalIterator())
            while chunk := list(islice(names, FILES_AT_ONCE)):
                copy(scan_landing(spark, chunk, multi_line=multi_line, base=landing_root).join(here.select("file_path", "s3_key"), "file_path"), source)
        table = SOURCE_TABLES[source].lower()
        copied = spark.read.schema(catalog.RAW_TABLE_DDL[table]).parquet(ledger.batch_path(warehouse, table, batch))
        copied.groupBy("source", "extracted_at").agg(F.count("*").alias("n_rows")).write.mode("append").parquet(
            ledger.batch_path(warehouse, ledger.SNAPSHOTS, batch))
        if source == "rawg":
            growth.snapshot_state(copied).write.parquet(ledger.batch_path(warehouse, ledger.GROWTH, batch))
        counts = rows_per_file(copied.select("source", "s3_key", F.col("loaded_at").alias("payload")))
        loaded = counts if loaded is None else loaded.unionByName(counts)
    if loaded is None:
        loaded = spark.createDataFrame([], "source string, s3_key string, rows_loaded bigint")
    attempts = plan.join(loaded, ["source", "s3_key"], "left").select(
        "source", "s3_key", "target_table", F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"), "status",
        ts.alias("loaded_at"))
    audit_path = ledger.batch_path(warehouse, "raw_load_audit", batch)
    attempts.write.parquet(audit_path)
    if before_commit is not None:
        before_commit()
    ledger.commit(spark, warehouse, batch)
    return spark.read.schema(catalog.RAW_TABLE_DDL["raw_load_audit"]).parquet(audit_path)


def daily_run(spark, landing_root: str, warehouse: str, extract_date: str, force_reload: bool = False,
              loaded_at=None, multi_line: bool = True, now=None, mart_buckets: int = MART_BUCKETS,
              envelopes: DataFrame | None = None, force_upload: bool = False, fail_on_checks: bool = True,
              keep_versions: int | None = None, declare: bool = True) -> dict[str, DataFrame]:
    """One run of the daily flow as a single driver program.

    create ``declare``: the namespaces and raw tables are declared if missing, and committed
           loads become their partitions
    land   ``envelopes`` (source, extract_date, s3_key, body), if given, are landed by key
           behind the write gate (``force_upload`` lands existing keys again); a rerun passes
           the run values it wants through ``landing.run_context`` into keys and bodies
    load   ``load_landed``: plan, copy, count and audit, in one commit
    stage  staging views over the newest snapshot, found in the ledger's snapshot catalogue; what marts and
           column tests read of them is written once (``stage``), below the scratch root, and removed after the run
    mart   the game mart's touched key buckets are merged and committed by one manifest (M1);
           the other marts are written as new versions
    check  column tests: a mart's are counted while it is written, the game and offer staging
           models' are counted on the staged rows; stored as ``check_report``; failing ones raise ``ChecksFailed`` unless ``fail_on_checks`` is
           off; freshness is reported where ``now`` is given

    Tables live below ``warehouse``: the raw tables where ``catalog.create_objects``
    declares them, ``mart/<name>`` (``keep_versions`` versions of them; None keeps all).
    Files landed by key hold one envelope a line; ``multi_line`` says how other files are read.
    Returns the run's audit rows, the check report, freshness and the models.
    """
    from snapmart.operators import quality
    from snapmart.operators.growth import catalog_growth
    from snapmart.plans import checks
    from snapmart.sources import catalog, landing, ledger, manifest

    out: dict[str, DataFrame] = {}
    if declare:
        catalog.create_objects(spark, warehouse)
    if envelopes is not None:
        out["landing"] = landing.land(envelopes, landing_root, force=force_upload)
    out["load_audit"] = load_landed(spark, landing_root, warehouse, extract_date, force_reload, loaded_at, multi_line)
    if declare:
        catalog.add_batches(spark, warehouse, ledger.batches(spark, warehouse))

    raw_rawg, raw_steam = (ledger.latest_raw(spark, warehouse, f"{s}_games_raw", s) for s in ("rawg", "steam"))
    staged = stage(raw_rawg, raw_steam)
    models = build_models(raw_rawg, raw_steam, ledger.read(spark, warehouse, "raw_load_audit"), history=False, staged=staged)
    counted: dict = {}
    models = materialize(models, f"{warehouse}/mart", mart_buckets, counted=counted)
    tested = {**models, "stg_steam_featured_games": staged.offers}
    catalog.write_version(checks.all_checks(tested, raw_rawg, counted, staged.entities), f"{warehouse}/check_report")
    release_dirs(spark, staged.paths)
    out |= {"report": catalog.read_current(spark, f"{warehouse}/check_report"), **models}
    out["kpi_catalog_growth"] = catalog_growth(ledger.read(spark, warehouse, ledger.GROWTH, ledger.GROWTH_SCHEMA))
    if now is not None:
        raws = {s: ledger.read(spark, warehouse, f"{s}_games_raw") for s in ("rawg", "steam")}
        out["freshness"] = checks.freshness_checks(raws, now)
    if keep_versions is not None:
        manifest.expire(spark, f"{warehouse}/mart/mart_games", keep_versions)
        for name in (*[f"mart/{m}" for m in VERSIONED_MARTS], "check_report"):
            catalog.expire_versions(spark, f"{warehouse}/{name}", keep_versions)
    if fail_on_checks and quality.failed(out["report"]):
        raise quality.ChecksFailed(f"column tests failed; see {warehouse}/check_report")
    return out


def register_views(models: dict[str, DataFrame]) -> list[str]:
    """Expose every model as a temp view, so the marts can be queried in SQL
    (``SELECT … FROM mart_top_rated_games``) as they were in the warehouse."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return sorted(models)
