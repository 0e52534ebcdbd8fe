"""K5 from stored state: exact, mergeable sets of game ids per snapshot.

A snapshot's games are kept as bitmaps (one row per 32,768 ids, 4 kB), so adding a load means
adding its rows, and distinct counts over any set of loads come from the rows alone:
bitmaps of one snapshot are joined by OR and counted.  No payload is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.functions.variant import as_number
from snapmart.operators.flatten import flatten

STATE_SCHEMA = "extracted_at timestamp_ntz, bucket bigint, games binary"


def snapshot_state(raw_rawg: DataFrame) -> DataFrame:
    """(extracted_at, bucket, games) of raw rows; a snapshot whose games have no id keeps an empty bitmap."""
    flat = flatten(raw_rawg.select("extracted_at", "payload"), "payload", "$.payload.results", "game", keep=["extracted_at"])
    ids = flat.select("extracted_at", as_number("game", "$.id").alias("gid"))
    return (ids.groupBy("extracted_at", F.coalesce(F.bitmap_bucket_number("gid"), F.lit(0)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("gid")).alias("games")))


def catalog_growth(states: DataFrame) -> DataFrame:
    """K5: distinct games per snapshot and the change from the one before, from any states (of whichever loads)."""
    whole = states.groupBy("extracted_at", "bucket").agg(F.bitmap_or_agg("games").alias("games"))
    per = whole.groupBy("extracted_at").agg(F.sum(F.bitmap_count("games")).cast("bigint").alias("game_count"))
    w = Window.orderBy("extracted_at")  # one row per snapshot: no partition needed
    prev = F.lag("game_count").over(w)
    return per.select("extracted_at", "game_count", prev.alias("prev_game_count"),
                      (F.col("game_count") - F.coalesce(prev, F.lit(0))).alias("delta_games"))
