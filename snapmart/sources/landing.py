"""S2–S5 — run context, landing keys, partitioned landing writes and the write gate."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.functions.timefmt import file_stamp, iso_date, iso_utc
from snapmart.session import fresh_dir
from snapmart.sources.envelope import CHUNKS_PER_FILE, EnvelopePlan

DEFAULT_PREFIX = "raw"
# Fixed file-name stems per source.
FILE_STEMS = {"rawg": "rawg_games", "steam": "steam_apps"}


def run_context(ts, extracted_at_utc: str | None = None, extract_date: str | None = None,
                stamp: str | None = None) -> list[Column]:
    """S3: the three run values; each falls back to the clock ``ts`` on its own.

    They are never checked against one another (trap T12): a backfill may set
    ``extract_date`` to a day other than ``extracted_at_utc``.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    return [
        F.coalesce(F.lit(extracted_at_utc), iso_utc(t)).alias("extracted_at_utc"),
        F.coalesce(F.lit(extract_date), iso_date(t)).alias("extract_date"),
        F.coalesce(F.lit(stamp), file_stamp(t)).alias("file_stamp"),
    ]


def file_name(source, stamp) -> Column:
    """``rawg_games_<stamp>.json`` / ``steam_apps_<stamp>.json``; other sources raise."""
    s = F.col(source) if isinstance(source, str) else source
    st = F.col(stamp) if isinstance(stamp, str) else stamp
    stem = F.when(s == "rawg", F.lit(FILE_STEMS["rawg"])).when(s == "steam", F.lit(FILE_STEMS["steam"])) \
        .otherwise(F.raise_error(F.concat(F.lit("no landing files are defined for source "), F.coalesce(s, F.lit("NULL")))))
    return F.concat(stem, F.lit("_"), st, F.lit(".json"))


def landing_key(source, extract_date, stamp, prefix: str = DEFAULT_PREFIX) -> Column:
    """``{prefix}/source={s}/extract_date={d}/{file}``."""
    s = F.col(source) if isinstance(source, str) else source
    d = F.col(extract_date) if isinstance(extract_date, str) else extract_date
    return F.concat(F.lit(prefix), F.lit("/source="), s, F.lit("/extract_date="), d, F.lit("/"),
                    file_name(s, stamp))


def relative_key(key, prefix: str = DEFAULT_PREFIX) -> Column:
    """key below the stage root (``removeprefix(prefix + '/')``)."""
    k = F.col(key) if isinstance(key, str) else key
    pre = prefix + "/"
    return F.when(k.startswith(pre), F.substring(k, len(pre) + 1, 1 << 30)).otherwise(k)


#: What is landed by key lies here below the root, in folders ``source=/extract_date=/file=``: one file each,
#: hidden from scans of the files that others put into the root.
DATA = "_landed"
#: Beside it: which keys were landed, by which write, in which file.
KEYS = "_landed_keys"
KEY_SCHEMA = "s3_key string, batch string, file string, in_file bigint, source string, extract_date string"
#: Envelopes a file when they come as rows, not as an ``EnvelopePlan``.
KEYS_PER_FILE = CHUNKS_PER_FILE


def write_landing(envelopes: DataFrame, root: str, mode: str = "append") -> None:
    """JSON Lines, one envelope per line, under ``source=/extract_date=``.

    One document per line keeps the files splittable; the read side handles
    pretty-printed single-document files too (``multi_line=True``).
    """
    (envelopes.select("source", "extract_date", F.col("body").alias("value"))
     .write.mode(mode).partitionBy("source", "extract_date").text(root))


def envelope_keys(env: DataFrame) -> DataFrame:
    """Landing key per envelope; the chunk number keeps keys of one snapshot apart."""
    base = landing_key("source", iso_date("extracted_at"), file_stamp("extracted_at"))
    key = F.regexp_replace(base, r"\.json$", F.concat(F.lit("-"), F.format_string("%05d", "envelope_no"), F.lit(".json")))
    return env.withColumn("extract_date", iso_date("extracted_at")).withColumn("s3_key", key)


def landed_keys(spark: SparkSession, root: str, extract_date: str | None = None) -> DataFrame | None:
    """(source, extract_date, s3_key, batch, file, in_file): every landed key where its newest write put it; None where none was landed.

    ``in_file`` is the number of keys in that file.
    """
    from snapmart.sources.catalog import _fs

    path = f"{root.rstrip('/')}/{KEYS}"
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return None
    rows = spark.read.schema(KEY_SCHEMA).parquet(path)
    if extract_date is not None:
        rows = rows.where(F.col("extract_date") == extract_date)
    newest = rows.groupBy("source", "extract_date", "s3_key").agg(F.max(F.struct("batch", "file", "in_file")).alias("_at"))
    return newest.select("source", "extract_date", "s3_key", "_at.*")


class IncompleteLanding(Exception):
    """A write has not the envelopes it was to have; nothing of it was listed."""


def land(envelopes: DataFrame | EnvelopePlan, root: str, force: bool = False) -> DataFrame:
    """S1-S5 as one step: land envelopes by key; returns each key's ``upload_status``.

    ``envelopes`` is a plan, whose keys are counted first (``envelope_keys``) and of which
    only the new envelopes are built, straight into their files; or rows ``(source,
    extract_date, s3_key, body)``, which are staged once.  The gate comes before the write:
    an envelope whose key is landed already is skipped unless ``force``, which lands it
    again in the older one's place.  Every file is a folder of its own, known before it is
    written (and compressed, as it is small enough for one task to read it), so the key list says which file holds a key.  Keys are listed after their
    data, so an unfinished write leaves files that no key points to; running it again
    lands them properly.
    """
    rows = envelopes.rows if isinstance(envelopes, EnvelopePlan) else envelopes
    spark = rows.sparkSession
    batch = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    if isinstance(envelopes, EnvelopePlan):
        candidates = envelope_keys(envelopes.keys())
        stamp = file_stamp("extracted_at")
    else:
        stage = fresh_dir(spark, "landing-stage")
        envelopes.select("source", "extract_date", "s3_key", "body").write.parquet(stage)
        staged = spark.read.parquet(stage)
        files = staged.groupBy("source", "extract_date").agg(F.ceil(F.count(F.lit(1)) / KEYS_PER_FILE).cast("bigint").alias("_files"))
        staged = staged.join(files, ["source", "extract_date"]).withColumn("file_no", F.pmod(F.xxhash64("s3_key"), F.col("_files"))).drop("_files")
        candidates, stamp = staged.drop("body"), F.lit("rows")
    known = landed_keys(spark, root)
    if known is None:
        known = spark.createDataFrame([], "s3_key string")
    named = F.concat_ws("-", F.lit(batch), stamp, F.format_string("%05d", "file_no"))
    plan_dir = fresh_dir(spark, "land-plan")
    gate(candidates.withColumn("file", named), known, force).write.parquet(plan_dir)
    plan = spark.read.parquet(plan_dir)
    new = plan.where("upload_status = 'uploaded'")
    n_all, n_new = plan.agg(F.count(F.lit(1)), F.count_if(F.col("upload_status") == "uploaded")).first()
    if n_new:
        if isinstance(envelopes, EnvelopePlan):
            bodies = envelope_keys(envelopes.bodies(None if n_new == n_all else new))
            # a chunk is built whole: of one whose other parts are landed already only the new parts are written
            bodies = bodies if n_new == n_all else bodies.join(new.select("s3_key"), "s3_key", "left_semi")
        else:
            bodies = staged.join(new.select("s3_key").distinct(), "s3_key", "left_semi").repartition("source", "extract_date", "file_no")
        written = Observation()
        line = F.concat(F.regexp_replace(F.to_json(F.struct(F.col("s3_key").alias("landing_key"), F.lit(batch).alias("landing_batch"))), "}$", ","),
                        F.substring("body", 2, 1 << 30))
        (bodies.select("source", "extract_date", named.alias("file"), line.alias("value"))
         .observe(written, F.count(F.lit(1)).alias("n"))
         .write.mode("append").option("compression", "gzip").partitionBy("source", "extract_date", "file").text(f"{root.rstrip('/')}/{DATA}"))
        if written.get["n"] != n_new:
            raise IncompleteLanding(f"{written.get['n']} of {n_new} envelopes written to {root}")
        in_file = F.count(F.lit(1)).over(Window.partitionBy("source", "extract_date", "file"))
        # sorted, so that a key or a day is found by the statistics of the list's files
        (new.select("s3_key", F.lit(batch).alias("batch"), "file", in_file.alias("in_file"), "source", "extract_date")
         .repartitionByRange("extract_date", "s3_key").sortWithinPartitions("extract_date", "s3_key")
         .write.mode("append").parquet(f"{root.rstrip('/')}/{KEYS}"))
    return plan.select("source", "extract_date", "s3_key", "upload_status")


def gate(candidates: DataFrame, existing_keys: DataFrame, force: bool = False,
         key_col: str = "s3_key") -> DataFrame:
    """``uploaded`` unless the key already exists and the run is not forced.

    ``existing_keys`` is any relation of keys (``landed_keys``, or a file listing).
    Set-wise, one join for all candidates.
    """
    if force:
        return candidates.withColumn("upload_status", F.lit("uploaded"))
    present = existing_keys.select(F.col(key_col)).distinct().withColumn("_exists", F.lit(True))
    j = candidates.join(present, on=key_col, how="left")
    status = F.when(F.col("_exists"), F.lit("skipped_existing")).otherwise(F.lit("uploaded"))
    return j.withColumn("upload_status", status).drop("_exists")
