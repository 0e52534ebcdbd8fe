"""The driver tables cast as the reference's two JSON sources and its audit log.

Roles (mirrored relationally, without JSON, by the oracle SQL):

* snapshot / run time  = year of ``l_shipdate`` (both sources of a run share it)
* game                 = part (``p_partkey``), one game entry per lineitem, its
  genres from ``l_returnflag``/``l_linestatus`` and its platform the supplier
* store item           = lineitem ⋈ part, category from ``l_returnflag``
* audit row            = order (``F`` loaded, ``P`` skipped_existing, ``O`` reloaded)

Every field is a function of the part/supplier/category and the snapshot, so
duplicate entries inside a snapshot agree and the staged rows are determined by
the data alone.  The JSON is really built (``to_json``) and parsed back
(``parse_json``); the raw tables are written once per session and sf directory
below the shared scratch root, the way the raw zone is a persisted table.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.timefmt import file_stamp, iso_date, ntz_to_epoch
from snapmart.operators.loads import rows_per_file
from snapmart.session import fresh_dir, use_unshredded_variants
from snapmart.sources.envelope import DEFAULT_PER_ENVELOPE, EnvelopePlan, build_envelopes, plan_envelopes, tasks_for, with_row_key
from snapmart.sources.catalog import COMPRESSION, RAW_OPTIONS
from snapmart.sources.landing import envelope_keys, landing_key

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Fixed genre values: flag → (genre id, name, slug).
GENRE_BY_RETURNFLAG = {"A": (1, "Adventure", "adventure"), "R": (2, "RPG", "rpg"), "N": (3, "Indie", "indie")}
GENRE_BY_LINESTATUS = {"F": (4, "Action", "action"), "O": (5, "Strategy", "strategy")}
# Fixed store categories: return flag → (document position, key, display name).
CATEGORY_BY_RETURNFLAG = {"A": (0, "specials", "Specials"), "R": (1, "top_sellers", "Top Sellers"),
                          "N": (2, "new_releases", "New Releases")}
# Fixed audit statuses by order status.
AUDIT_STATUS = {"F": "loaded", "P": "skipped_existing", "O": "reloaded"}
STORE_APP_ID_BASE = 100000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def snapshot_of(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("year", c).cast("timestamp_ntz")


def _lookup(col: str, mapping: dict, idx: int) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(v[idx])) if expr is None
                else expr.when(F.col(col) == k, F.lit(v[idx])))
    return expr


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems with their row key, snapshot, part and supplier."""
    li = with_row_key(table(spark, sf_dir, "lineitem")).select(
        "_row_id", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (li.withColumn("snap", snapshot_of("l_shipdate"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(supp, F.col("l_suppkey") == F.col("s_suppkey")))


def game_entry() -> Column:
    k, size = F.col("p_partkey"), F.col("p_size")
    name = (F.when(size == 50, F.lit(None).cast("string"))
            .when(k % 3 == 0, F.upper("p_name"))
            .when(k % 3 == 1, F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
            .otherwise(F.col("p_name")))
    released = F.when(size > 45, F.lit(None).cast("string")).otherwise(
        F.date_format(F.make_date(1990 + size % 20, 1 + size % 12, 1 + size % 28), "yyyy-MM-dd"))
    rating = F.when(size % 10 == 0, F.lit(None).cast("double")).otherwise(size.cast("double") / 10)
    genre = lambda col, m: F.struct(_lookup(col, m, 0).alias("id"), _lookup(col, m, 1).alias("name"),
                                    _lookup(col, m, 2).alias("slug"))
    pk = k + F.col("s_suppkey")
    plat_released = F.when(pk % 4 == 0, F.lit(None).cast("string")).otherwise(
        F.date_format(F.date_add(F.to_date("snap"), (pk % 28).cast("int")), "yyyy-MM-dd"))
    platform = F.struct(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                 F.lower("s_name").alias("slug")).alias("platform"),
                        plat_released.alias("released_at"))
    return F.struct(
        k.alias("id"), F.concat(F.lit("g-"), k.cast("string")).alias("slug"), name.alias("name"),
        released.alias("released"), (size > 45).alias("tba"), rating.alias("rating"), F.lit(5).alias("rating_top"),
        F.when(k % 7 == 0, F.lit(None).cast("bigint")).otherwise((k * 37) % 1000).alias("ratings_count"),
        ((k * 13) % 97).alias("reviews_count"), (k % 5).alias("reviews_text_count"),
        (size * 3).alias("added"), (size % 24).alias("playtime"), (k % 11).alias("suggestions_count"),
        F.when(size % 4 == 0, F.lit(None).cast("int")).otherwise(40 + size).alias("metacritic"),
        F.concat(F.lit("img/"), k.cast("string"), F.lit(".jpg")).alias("background_image"),
        F.date_format("snap", "yyyy-MM-dd'T'HH:mm:ss").alias("updated"),
        F.array(genre("l_returnflag", GENRE_BY_RETURNFLAG), genre("l_linestatus", GENRE_BY_LINESTATUS)).alias("genres"),
        F.array(platform).alias("platforms"),
    )


def store_item(with_category: bool = True) -> Column:
    k, size, flag = F.col("p_partkey"), F.col("p_size"), F.col("l_returnflag")
    name = (F.when(size == 49, F.lit(None).cast("string"))
            .when(k % 4 == 0, F.lower("p_name")).when(k % 4 == 1, F.upper("p_name"))
            .when(k % 4 == 2, F.concat(F.col("p_name"), F.lit("  "))).otherwise(F.col("p_name")))
    pct = F.when(flag == "A", 10 * (1 + size % 5)).otherwise(F.lit(0))
    original = size * 100 + 99
    fields = [
        (F.lit(STORE_APP_ID_BASE) + k).alias("id"), name.alias("name"), F.lit(0).alias("type"),
        (flag == "A").alias("discounted"), pct.alias("discount_percent"), original.alias("original_price"),
        (original - pct * size).alias("final_price"), F.lit("USD").alias("currency"),
        F.lit(True).alias("windows_available"), (size % 2 == 0).alias("mac_available"),
        F.when(size % 3 == 0, F.lit(None).cast("boolean")).otherwise(size % 3 == 1).alias("linux_available"),
        F.when(size % 5 == 0, F.lit("full")).alias("controller_support"),
        F.concat(F.lit("hdr/"), k.cast("string"), F.lit(".jpg")).alias("header_image"),
        F.concat(F.lit("app/"), (F.lit(STORE_APP_ID_BASE) + k).cast("string")).alias("url"),
        (ntz_to_epoch("snap") + size * 86400).alias("discount_expiration"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seq"),
    ]
    if with_category:
        fields += [_lookup("l_returnflag", CATEGORY_BY_RETURNFLAG, 1).alias("category_key"),
                   _lookup("l_returnflag", CATEGORY_BY_RETURNFLAG, 2).alias("category_name")]
    return F.struct(*fields)


def rawg_envelopes(spark: SparkSession, sf_dir: str, per_envelope: int = DEFAULT_PER_ENVELOPE) -> DataFrame:
    e = _lines(spark, sf_dir).select("_row_id", "snap", game_entry().alias("entry"))
    return build_envelopes(e, "rawg", "snap", "entry", per_envelope=per_envelope)


#: Order keys per store document: about 200 items of a snapshot, at any table size.
ORDERS_PER_DOCUMENT = 400


def store_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category-map documents (the store payload before S16): (extracted_at, doc_no, doc).

    Categories appear in their fixed position order, items by ``seq``; a scalar
    ``status`` entry closes each document and must be skipped by the flatten.
    """
    # one shuffle, of the lines' fields; behind it a document's items are written as JSON and sorted by
    # (category position, seq, id); an item's text opens a new category object when the category changes
    doc_no = F.floor(F.col("l_orderkey") / ORDERS_PER_DOCUMENT).cast("bigint")
    dealt = _lines(spark, sf_dir).withColumn("doc_no", doc_no).repartition(
        tasks_for(spark, table(spark, sf_dir, "lineitem").count()), "snap", "doc_no")
    lines = dealt.select(
        "snap", "doc_no", _lookup("l_returnflag", CATEGORY_BY_RETURNFLAG, 0).alias("cat_pos"),
        _lookup("l_returnflag", CATEGORY_BY_RETURNFLAG, 1).alias("cat_key"),
        _lookup("l_returnflag", CATEGORY_BY_RETURNFLAG, 2).alias("cat_name"),
        store_item(with_category=False).alias("item"))
    docs = (lines.groupBy("snap", "doc_no")
            .agg(F.array_sort(F.collect_list(F.struct(
                "cat_pos", F.col("item.seq").alias("s"), F.col("item.id").alias("i"), "cat_key",
                F.regexp_replace(F.to_json(F.struct(F.col("cat_name").alias("name"))), "^\\{|\\}$", "").alias("nm"),
                F.to_json("item").alias("j")))).alias("its")))

    def piece(x, i):
        opener = F.concat(F.lit('"'), x["cat_key"], F.lit('":{'), x["nm"], F.lit(',"items":['), x["j"])
        prev = F.col("its")[i - 1]["cat_pos"]
        return (F.when(i == 0, opener)
                .when(prev != x["cat_pos"], F.concat(F.lit("]},"), opener))
                .otherwise(F.concat(F.lit(","), x["j"])))

    doc = F.concat(F.lit("{"), F.array_join(F.transform("its", piece), ""), F.lit(']},"status":1}'))
    return docs.select(F.col("snap").alias("extracted_at"), "doc_no", doc.alias("doc"))


def raw_from_envelopes(env: DataFrame) -> DataFrame:
    """Envelope text → raw-table rows (the copy step without files)."""
    e = envelope_keys(env)
    payload = F.parse_json("body")
    return e.select("source", "s3_key", F.to_timestamp_ntz(F.variant_get(payload, "$.extracted_at_utc", "string"))
                    .alias("extracted_at"), payload.alias("payload"),
                    (F.col("extracted_at") + F.expr("INTERVAL 1 HOUR")).alias("loaded_at"), "extract_date")


def both_envelopes(spark: SparkSession, sf_dir: str, per_envelope: int = DEFAULT_PER_ENVELOPE) -> EnvelopePlan:
    """Game and store envelopes from one scan of the lines: each line yields both entries, and one
    shuffle of the lines' fields builds all envelopes.  They are counted from the lines alone,
    as every line has its part and supplier."""
    narrow = with_row_key(table(spark, sf_dir, "lineitem")).select("_row_id", snapshot_of("l_shipdate").alias("snap"))
    sources = {"rawg": ("results", game_entry()), "steam": ("featured_categories", store_item())}
    return plan_envelopes(_lines(spark, sf_dir), sources, "snap", per_envelope=per_envelope, narrow=narrow)


_WRITTEN: dict = {}
_LOCK = threading.RLock()


def written(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a dataset that ``build(path)`` writes once per application and sf directory, below the scratch root."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        path = _WRITTEN.get(key)
        if path is None:
            path = fresh_dir(spark, name)
            build(path)
            _WRITTEN[key] = path
    return path


def store_document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store documents as landed: written once, read by every category query."""
    path = written(spark, sf_dir, "store-documents", lambda p: store_documents(spark, sf_dir).write.option("compression", COMPRESSION).parquet(p))
    return spark.read.parquet(path)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw ``rawg``/``steam`` tables, built by Spark from the driver tables and
    written once (Parquet, partitioned by ``source``/``extract_date``) below the
    scratch root; each table is a partition-pruned read of that dataset."""
    def build(path: str) -> None:
        use_unshredded_variants(spark)
        (raw_from_envelopes(both_envelopes(spark, sf_dir).bodies()).write.mode("errorifexists").options(**RAW_OPTIONS)
         .partitionBy("source", "extract_date").parquet(path))

    path = written(spark, sf_dir, "raw", build)
    raw = spark.read.parquet(path).withColumn("extract_date", F.col("extract_date").cast("string"))
    return {s: raw.where(F.col("source") == s) for s in ("rawg", "steam")}


def snapshot_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, extracted_at, extract_date) of the written raw tables: which folders hold which snapshot, written once."""
    def build(path: str) -> None:
        raw = raw_tables(spark, sf_dir)
        (raw["rawg"].unionByName(raw["steam"]).groupBy("source", "extracted_at", "extract_date").agg(F.count(F.lit(1)).alias("n_rows"))
         .write.parquet(path))

    return spark.read.parquet(written(spark, sf_dir, "snapshots", build))


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW_LOAD_AUDIT rows, one per order."""
    o = table(spark, sf_dir, "orders")
    source = F.when(F.col("o_orderpriority") < "3", F.lit("steam")).otherwise(F.lit("rawg"))
    status = _lookup("o_orderstatus", {k: (v,) for k, v in AUDIT_STATUS.items()}, 0)
    key = landing_key(source, iso_date("o_orderdate"), file_stamp("o_orderdate"))
    target = F.when(source == "rawg", F.lit("RAWG_GAMES_RAW")).otherwise(F.lit("STEAM_GAMES_RAW"))
    rows = F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("bigint")).otherwise(
        F.floor(F.col("o_totalprice") / 1000).cast("bigint"))
    loaded_at = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    return o.select(source.alias("source"), key.alias("s3_key"), target.alias("target_table"),
                    rows.alias("rows_loaded"), status.alias("status"), loaded_at.alias("loaded_at"))


def candidate_files(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Landing files of a load run: one per (source, ship day), one document per lineitem.

    ``since``/``until`` (first day, and the day after the last) reach the scan as a range on the ship date.
    """
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_shipdate")
    if since is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        li = li.where(F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz"))
    source = F.when(F.col("l_returnflag") == "R", F.lit("steam")).otherwise(F.lit("rawg"))
    day = F.date_trunc("day", "l_shipdate").cast("timestamp_ntz")
    files = li.select(source.alias("source"), day.alias("day"), F.col("l_returnflag").alias("payload"))
    key = landing_key("source", iso_date("day"), file_stamp("day"))
    return (rows_per_file(files, file_col="day", by=["source"])
            .select("source", key.alias("s3_key"), F.col("rows_loaded").cast("bigint"), "day"))


def order_envelopes(spark: SparkSession, sf_dir: str, per_envelope: int = DEFAULT_PER_ENVELOPE,
                    every: str = "month") -> EnvelopePlan:
    """Orders as a source with a snapshot per month (or ``every`` else; S1 round trips): one entry per order."""
    o = with_row_key(table(spark, sf_dir, "orders")).select(
        "_row_id", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    entry = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
                     F.col("o_totalprice").alias("totalprice"), F.col("o_orderpriority").alias("priority"),
                     F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
    e = o.select("_row_id", F.date_trunc(every, "o_orderdate").cast("timestamp_ntz").alias("snap"),
                 entry.alias("entry"))
    return plan_envelopes(e, "rawg", "snap", "entry", per_envelope=per_envelope)
