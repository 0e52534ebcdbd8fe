"""K1/K2 — KPIs named by the reference's brief, as plain aggregations (K5: ``operators.growth``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def release_trend(mart: DataFrame) -> DataFrame:
    """K1: games per release month (NULL month = no release date)."""
    month = F.date_trunc("month", "released_date").cast("date")
    return mart.groupBy(month.alias("release_month")).agg(F.count(F.lit(1)).alias("game_count"))


def rating_by_genre(games: DataFrame) -> DataFrame:
    """K2: average rating per genre, from the games' own genre rows (``genre_set``, ``rating``).

    The mart's joined list cannot be split again: a genre's name may hold a comma.  A
    game without genre rows counts as ``Unknown``, as in the mart.
    """
    genres = F.when(F.col("genre_set").isNull(), F.array(F.lit("Unknown"))) \
        .when(F.size("genre_set") == 0, F.array(F.lit(""))).otherwise(F.col("genre_set"))
    g = games.select(F.explode(genres).alias("genre"), "rating")
    return g.groupBy("genre").agg(F.round(F.avg("rating"), 6).alias("avg_rating"),
                                  F.count(F.lit(1)).alias("game_count"), F.count("rating").alias("rated_games"))
