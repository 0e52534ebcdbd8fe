"""Atomic commits on a file system: small files that appear whole or not at all.

Data is written first, under a name that nothing reads; one published file then makes
it count.  ``publish`` never replaces a file, so of two writers one gets an error.

``merge`` keeps an accumulating table in key buckets (M1).  Every merge writes the
buckets it touches into a new folder and publishes the next manifest, which names the
folders of each bucket.  Readers open the newest manifest, so they see the table before
or after a merge and never in between; a job that dies leaves folders no manifest names.
Rows with a NULL key match nothing and are inserted by every merge (T10): their bucket is
only ever added to.

A merge also counts what column tests ask (``watch``): rows, NULLs of the watched columns
and keys that occur more than once.  The counts are metrics of the write itself, taken as
changes over the touched buckets, and their new totals stand in the manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from snapmart.operators.merge import BUCKET_COL, key_bucket
from snapmart.sources.catalog import _fs

MANIFESTS = "_manifest"
NULL_BUCKET = -1


class CommitConflict(Exception):
    """Another writer committed first; run again on what it left."""


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Make ``path`` appear with this content, in one step; ``CommitConflict`` if it is there already."""
    fs, final, jvm = _fs(spark, path)
    if fs.exists(final):
        raise CommitConflict(path)
    draft = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    never_over = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, final, never_over)
    except Exception as e:
        fs.delete(draft, False)
        if "AlreadyExists" in str(e):
            raise CommitConflict(path) from e
        raise


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files published in a folder, sorted."""
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if not n.startswith("."))


def _text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    data = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
    finally:
        data.close()


def current(spark: SparkSession, root: str) -> dict | None:
    """The newest manifest: ``version``, ``key``, ``buckets`` and the ``folders`` of each bucket."""
    names = published(spark, f"{root}/{MANIFESTS}")
    return json.loads(_text(spark, f"{root}/{MANIFESTS}/{names[-1]}")) if names else None


def _folders(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    return spark.read.option("basePath", f"{root}/data").parquet(*[f"{root}/data/{n}" for n in names]).drop("merge")


def read(spark: SparkSession, root: str, only: list[int] | None = None) -> DataFrame | None:
    """The table as the newest manifest has it, with its ``key_bucket`` (``only``: these buckets); None before the first merge."""
    manifest = current(spark, root)
    if manifest is None or not manifest["folders"]:
        return None
    names = [f for b, folders in manifest["folders"].items() if only is None or int(b) in only for f in folders]
    return _folders(spark, root, names) if names else _folders(spark, root, sum(manifest["folders"].values(), [])).limit(0)


def _changes(watch: list[str], stays: Column, goes: Column, nth: Column) -> list[Column]:
    """Metrics of a merge: how the counts of the column tests change (``nth``: the row's place among those of its key and age)."""
    def change(what: Column) -> Column:
        return F.count_if(stays & what) - F.count_if(goes & what)

    return [change(F.lit(True)).alias("rows"), change(nth == 2).alias("twice"),
            *[change(F.col(c).isNull()).alias(f"null_{k}") for k, c in enumerate(watch)]]


def merge(spark: SparkSession, updates: DataFrame, root: str, key: str, buckets: int,
          before_commit: Callable[[], None] | None = None, watch: list[str] | None = None) -> list[int]:
    """M1: replace rows of ``updates``' keys, insert the others, keep the rest; returns the touched buckets.

    The number of buckets is fixed by the first merge, and so are the watched columns.  Updates
    are computed once; only the touched buckets (at most ``buckets``, read off the folders
    written) are read and rewritten, each by one task, in one shuffle on the bucket.  The
    metrics are observed in the tasks that write, which count once however often they are tried.
    """
    manifest = current(spark, root) or {"version": 0, "key": key, "buckets": buckets, "folders": {}}
    if manifest["key"] != key:
        raise ValueError(f"{root} is merged by {manifest['key']}")
    buckets = manifest["buckets"]
    run = f"merge={manifest['version'] + 1:06d}-{uuid.uuid4().hex[:8]}"
    first = not manifest["folders"]
    counts = manifest.get("counts") or ({"rows": 0, "twice": 0, "nulls": dict.fromkeys(watch or [], 0)} if first else None)
    watch = list(counts["nulls"]) if counts else []
    seen = Observation()
    new = f"{root}/data/{run}"
    landed = new if first else f"{root}/_updates/{run}"
    # one task a bucket, except for rows without a key
    rows = updates.withColumn(BUCKET_COL, key_bucket(key, buckets)).withColumn(
        "_deal", F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*updates.columns), F.lit(buckets))))
    rows = rows.repartition(BUCKET_COL, "_deal")
    if first:
        nth = F.when(F.col(key).isNotNull(), F.row_number().over(Window.partitionBy(BUCKET_COL, "_deal", key).orderBy(key)))
        rows = rows.withColumn("_nth", nth).observe(seen, *_changes(watch, F.lit(True), F.lit(False), F.col("_nth"))).drop("_nth")
    rows.drop("_deal").write.partitionBy(BUCKET_COL).parquet(landed)
    fs, p, _ = _fs(spark, landed)
    touched = sorted(int(st.getPath().getName().split("=")[1]) for st in fs.listStatus(p) if st.getPath().getName().startswith(BUCKET_COL))
    if not first and touched:
        fresh = spark.read.parquet(landed).withColumn("_old", F.lit(0))
        old = [f for b in touched if b != NULL_BUCKET for f in manifest["folders"].get(str(b), [])]
        keyed = fresh.where(F.col(BUCKET_COL) != NULL_BUCKET)
        if old:
            keyed = keyed.unionByName(_folders(spark, root, old).withColumn("_old", F.lit(1)))
        # new rows come first: a key's first row says whether its old ones stay
        by_age = Window.partitionBy(BUCKET_COL, key).orderBy("_old")
        place, n_new = F.row_number().over(by_age), F.sum(1 - F.col("_old")).over(by_age)
        keyed = (keyed.repartition(BUCKET_COL)
                 .withColumns({"_stays": F.first("_old").over(by_age) == F.col("_old"), "_nth": place - F.col("_old") * n_new}))
        unkeyed = fresh.where(F.col(BUCKET_COL) == NULL_BUCKET).withColumns({"_stays": F.lit(True), "_nth": F.lit(None).cast("bigint")})
        marked = keyed.unionByName(unkeyed).observe(seen, *_changes(watch, F.col("_stays"), F.col("_old") == 1, F.col("_nth")))
        marked.where("_stays").drop("_old", "_stays", "_nth").write.partitionBy(BUCKET_COL).parquet(new)
    if before_commit is not None:
        before_commit()
    folders = dict(manifest["folders"])
    for b in touched:
        kept = folders.get(str(b), []) if b == NULL_BUCKET else []
        folders[str(b)] = [*kept, f"{run}/{BUCKET_COL}={b}"]
    version = manifest["version"] + 1
    if counts and touched:
        found = seen.get
        counts = {"rows": counts["rows"] + found["rows"], "twice": counts["twice"] + found["twice"],
                  "nulls": {c: n + found[f"null_{k}"] for k, (c, n) in enumerate(counts["nulls"].items())}}
    publish(spark, f"{root}/{MANIFESTS}/{version:08d}.json",
            json.dumps({**manifest, "version": version, "folders": folders, "counts": counts}))
    return touched


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Remove merges' folders that none of the newest ``keep`` manifests names, and older manifests; returns the folders."""
    if keep < 1:
        raise ValueError("keep at least one version")
    names = published(spark, f"{root}/{MANIFESTS}")
    if not names:
        return []
    held = {f for n in names[-keep:] for fs in json.loads(_text(spark, f"{root}/{MANIFESTS}/{n}"))["folders"].values() for f in fs}
    fs, data, jvm = _fs(spark, f"{root}/data")
    gone = []
    for run in fs.listStatus(data):
        for st in fs.listStatus(run.getPath()):
            name = f"{run.getPath().getName()}/{st.getPath().getName()}"
            if st.isDirectory() and name not in held:
                fs.delete(st.getPath(), True)
                gone.append(name)
    for n in names[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFESTS}/{n}"), False)
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/_updates"), True)
    return gone
