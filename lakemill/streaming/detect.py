"""Trend detection over windowed metrics: composite, hot, breakout, declining and hourly top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalar import ratio, weighted
from lakemill.operators.rank import numbered
from lakemill.streaming.windows import latest_by_hour


def composite_trend(popularity: DataFrame, ratings: DataFrame) -> DataFrame:
    """Popularity and rating windows joined on movie and window start; 0.6 / 0.4 of their scores, where positive."""
    r = ratings.select("movie_id", "window_start", *[c for c in ratings.columns if c not in popularity.columns])
    df = popularity.join(r, ["movie_id", "window_start"])
    df = df.withColumn("popularity_score", weighted((0.4, "popularity_velocity"), (0.3, "avg_popularity"), (0.3, "update_count")))
    df = df.withColumn("rating_score", weighted((0.5, "rating_velocity"), (0.3, "avg_rating"), (0.2, "rating_count")))
    return df.withColumn("trend_score", weighted((0.6, "popularity_score"), (0.4, "rating_score"))).where("trend_score > 0")


def _ranked(df: DataFrame, score: str) -> DataFrame:
    # one rank list a window; on a stream this runs inside foreachBatch
    return numbered(df, ["window_start", "window_end"], [F.desc(score), F.col("movie_id")])


def hot_movies(velocity: DataFrame, volume_weight: float = 0.3, min_trend: float = 10.0, min_volume: int = 10) -> DataFrame:
    score = weighted((0.5, "trend_velocity"), (0.5, "trend_acceleration")) + F.col("total_review_volume") / 100 * volume_weight
    df = velocity.where((F.col("avg_trend_score") >= min_trend) & (F.col("total_review_volume") >= min_volume)).withColumn("hotness_score", score)
    return _ranked(df.where("hotness_score > 0"), "hotness_score")


def breakout_movies(velocity: DataFrame, min_acceleration: float = 0.5, min_velocity: float = 0.2, min_volume: int = 3) -> DataFrame:
    keep = (F.col("trend_acceleration") > min_acceleration) & (F.col("trend_velocity") > min_velocity) & (F.col("total_review_volume") >= min_volume)
    df = velocity.where(keep).withColumn("breakout_score", weighted((0.6, "trend_acceleration"), (0.4, "trend_velocity")))
    return _ranked(df.withColumn("surge_factor", ratio("max_trend_score", "avg_trend_score", F.col("avg_trend_score") > 0, 1.0)), "breakout_score")


def declining_movies(velocity: DataFrame, speed: Column | str = "trend_velocity", max_velocity: float = -0.1, min_trend: float = 5.0, min_volume: int = 2) -> DataFrame:
    """speed: a signed velocity (e.g. of avg_trend_score between windows). trend_velocity itself is never negative."""
    v = F.col(speed) if isinstance(speed, str) else speed
    df = velocity.withColumn("_v", v).where((F.col("_v") < max_velocity) & (F.col("avg_trend_score") > min_trend) & (F.col("total_review_volume") >= min_volume))
    df = df.withColumn("decline_score", F.abs("_v") * 0.7 + F.abs("trend_acceleration") * 0.3).withColumn("momentum_loss", F.abs("_v")).drop("_v")
    return _ranked(df, "decline_score")


def trending_topn(ratings: DataFrame, n: int = 100, min_popularity: float = 10.0, min_votes: int = 10, titles: DataFrame | None = None) -> DataFrame:
    """Top n of each hour by 0.5 popularity + 0.5 vote_count of the last state; titles (movie_id, title) are joined if given."""
    state = latest_by_hour(ratings).where((F.col("popularity") >= min_popularity) & (F.col("vote_count") >= min_votes))
    df = state.withColumn("trending_score", weighted((0.5, "popularity"), (0.5, "vote_count")))
    df = numbered(df, ["hour"], [F.desc("trending_score"), F.col("movie_id")]).where(F.col("rank") <= n)
    df = df.join(titles.select("movie_id", "title"), "movie_id", "left") if titles is not None else df.withColumn("title", F.lit(None).cast("string"))
    return df.select("hour", "rank", "movie_id", F.coalesce("title", F.lit("Unknown")).alias("title"), "trending_score", "popularity", "vote_count")


def latest_titles(metadata: DataFrame, ts: str = "event_time") -> DataFrame:
    """movie_id, title: the last title of each movie."""
    return metadata.groupBy("movie_id").agg(F.max_by("title", F.struct(ts, "title")).alias("title"))


def hourly_trend(ratings: DataFrame, watermark: str | None = "10 minutes") -> DataFrame:
    """Unranked hourly score, in a form that a stream can run in append mode."""
    return latest_by_hour(ratings, watermark=watermark).withColumn("trending_score", weighted((0.5, "popularity"), (0.5, "vote_count")))
