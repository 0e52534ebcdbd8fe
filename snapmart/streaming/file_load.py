"""Load each landed file once, as a file-source stream.

The stream's checkpoint is the log of files already taken, so a re-run (or a
restarted driver) picks up only new files — the "load each file once" rule of
the raw zone without an audit lookup per file.  Each micro-batch is appended to
the raw table under its own ``batch=<id>`` directory, written with overwrite, so
a batch replayed after a failure rewrites the same directory instead of
duplicating rows.  ``availableNow`` drains what is there and stops, which suits
a scheduled run.

``load_keys_stream`` streams the list of landed keys instead of files, so lines of
unfinished writes never load; the stream's state remembers the keys, so one that was
landed again (by force) is loaded once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.session import use_unshredded_variants
from snapmart.sources.catalog import RAW_OPTIONS
from snapmart.sources.jsonscan import scan_keys, to_raw
from snapmart.sources.landing import KEY_SCHEMA, KEYS, landed_keys

LANDING_SCHEMA = "payload variant, source string, extract_date string"


def landing_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int = 1000,
                   multi_line: bool = True) -> DataFrame:
    """``multi_line``: one document a file, pretty-printed or not; else one document a line."""
    return (spark.readStream.format("json").schema(LANDING_SCHEMA)
            .option("singleVariantColumn", "payload").option("mode", "FAILFAST").option("multiLine", multi_line)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_root)
            .select("source", "extract_date", F.col("_metadata.file_path").alias("file_path"), "payload"))


def load_stream(spark: SparkSession, landing_root: str, raw_root: str, checkpoint: str, loaded_at=None,
                source: str | None = None, multi_line: bool = True) -> None:
    """Run the stream to completion (``availableNow``)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        raw = to_raw(batch, source=source, loaded_at=loaded_at, root=landing_root)
        use_unshredded_variants(batch.sparkSession)
        raw.write.mode("overwrite").options(**RAW_OPTIONS).parquet(f"{raw_root}/batch={batch_id}")

    stream = landing_stream(spark, landing_root, multi_line=multi_line)
    if source is not None:
        stream = stream.where(F.col("source") == source)
    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def load_keys_stream(spark: SparkSession, landing_root: str, raw_root: str, checkpoint: str, loaded_at=None,
                     max_files_per_trigger: int = 1000) -> None:
    """Load every landed key once, run to completion (``availableNow``).

    A micro-batch takes keys that the stream has not seen, and reads each where its newest
    write put it, opening the listed files only.
    """
    path = f"{landing_root.rstrip('/')}/{KEYS}"
    new = (spark.readStream.schema(KEY_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
           .select("s3_key").dropDuplicates(["s3_key"]))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        keys = landed_keys(batch.sparkSession, landing_root).join(batch.distinct(), "s3_key", "left_semi")
        use_unshredded_variants(batch.sparkSession)
        raw = to_raw(scan_keys(batch.sparkSession, landing_root, keys), key_col="s3_key", loaded_at=loaded_at)
        raw.write.mode("overwrite").options(**RAW_OPTIONS).parquet(f"{raw_root}/batch={batch_id}")

    q = (new.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
