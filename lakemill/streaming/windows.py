"""Windowed aggregates that run alike on batches and streams, and joins of streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalar import ratio, sentiment_band, stable_mean


def _watermarked(df: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return df.withWatermark(ts, delay) if delay and df.isStreaming else df


def time_windows(df: DataFrame, ts: str, duration: str, slide: str | None = None, watermark: str | None = "10 minutes", keys: list[str] = (), aggs: list[Column] = ()) -> DataFrame:
    """Tumbling or sliding windows: keys, window_start, window_end and the aggregates (the count if none)."""
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    out = _watermarked(df, ts, watermark).groupBy(w.alias("window"), *keys).agg(*(list(aggs) or [F.count("*").alias("record_count")]))
    return _flat(out, keys)


def session_windows(df: DataFrame, ts: str, gap: str = "30 minutes", keys: list[str] = (), aggs: list[Column] = (), watermark: str | None = "10 minutes") -> DataFrame:
    """Session windows that end after a gap."""
    out = _watermarked(df, ts, watermark).groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(*(list(aggs) or [F.count("*").alias("record_count")]))
    return _flat(out, keys)


def _flat(df: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c != "window" and c not in keys]
    return df.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def sentiment_windows(scored: DataFrame, ts: str = "event_time", duration: str = "5 minutes", watermark: str | None = "10 minutes", compound: str = "sentiment.compound") -> DataFrame:
    """Per movie and window: mean compound, reviews, and how many are positive, negative, neutral."""
    band = sentiment_band(compound)
    aggs = [F.avg(compound).alias("avg_sentiment"), F.count("*").alias("review_count"), *[F.count_if(band == b).alias(f"{b}_count") for b in ("positive", "negative", "neutral")]]
    return time_windows(scored, ts, duration, None, watermark, ["movie_id"], aggs).withColumn("hour", F.date_trunc("hour", "window_start"))


def rating_windows(ratings: DataFrame, duration: str = "5 minutes", watermark: str | None = "10 minutes", ts: str = "event_time") -> DataFrame:
    """Per movie and window: rating count, mean, range, deviation, high/medium/low counts and range velocity."""
    x = F.col("vote_average")
    aggs = [
        F.count("*").alias("rating_count"), F.avg(x).alias("avg_rating"), F.min(x).alias("min_rating"), F.max(x).alias("max_rating"), F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("stddev_rating"),
        F.count_if(x >= 8).alias("high_ratings"), F.count_if((x >= 6) & (x < 8)).alias("medium_ratings"), F.count_if(x < 6).alias("low_ratings"),
    ]
    out = time_windows(ratings, ts, duration, None, watermark, ["movie_id"], aggs)
    return out.withColumn("rating_velocity", ratio(F.col("max_rating") - F.col("min_rating"), "rating_count", F.col("rating_count") > 1))


def popularity_windows(events: DataFrame, duration: str = "5 minutes", watermark: str | None = "10 minutes", ts: str = "event_time") -> DataFrame:
    """Per movie and window: first title, popularity statistics, updates, velocity (range / mean), acceleration (deviation / mean).

    events: movie_id, title, popularity, vote_average and ts (ratings with titles).
    """
    x = F.col("popularity")
    aggs = [
        F.min_by("title", ts).alias("title"), F.avg(x).alias("avg_popularity"), F.min(x).alias("min_popularity"), F.max(x).alias("max_popularity"), F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("stddev_popularity"),
        F.avg("vote_average").alias("avg_vote_average"), F.count("*").alias("update_count"),
    ]
    out = time_windows(events, ts, duration, None, watermark, ["movie_id"], aggs)
    some = F.col("avg_popularity") > 0
    return out.withColumn("popularity_velocity", ratio(F.col("max_popularity") - F.col("min_popularity"), "avg_popularity", some)).withColumn("popularity_acceleration", ratio("stddev_popularity", "avg_popularity", some))


def trend_velocity(events: DataFrame, duration: str = "5 minutes", watermark: str | None = "10 minutes", ts: str = "event_time") -> DataFrame:
    """Per movie and window: trend means, volume, velocity (max - mean) / count and acceleration (|delta| + |rating velocity|) / 2.

    The means do not depend on the order of rows, as ranks by score would tell equal movies apart by their last bits.
    """
    aggs = [
        F.min_by("title", ts).alias("title"), stable_mean("trend_score").alias("avg_trend_score"), F.max("trend_score").alias("max_trend_score"), stable_mean("popularity_delta").alias("avg_popularity_delta"),
        stable_mean("rating_velocity").alias("avg_rating_velocity"), F.sum("review_volume").alias("total_review_volume"), F.count("*").alias("event_count"),
    ]
    out = time_windows(events, ts, duration, None, watermark, ["movie_id"], aggs)
    vel = ratio(F.col("max_trend_score") - F.col("avg_trend_score"), "event_count", F.col("event_count") > 1)
    return out.withColumn("trend_velocity", vel).withColumn("trend_acceleration", (F.abs("avg_popularity_delta") + F.abs("avg_rating_velocity")) / 2)


def latest_by_hour(ratings: DataFrame, ts: str = "event_time", watermark: str | None = "10 minutes") -> DataFrame:
    """The last state of each movie in each hour; on a stream by a one-hour window, which keeps the watermark."""
    vals = F.struct("vote_average", "vote_count", "popularity")
    last = F.max_by(vals, F.struct(ts, "vote_count", "popularity", "vote_average")).alias("s")
    out = time_windows(ratings.where(F.col("movie_id").isNotNull()), ts, "1 hour", None, watermark, ["movie_id"], [last, F.max(ts).alias("last_updated")])
    return out.select("movie_id", F.col("window_start").alias("hour"), "s.*", "last_updated")


def interval_join(left: DataFrame, right: DataFrame, key: str = "movie_id", within: str = "5 minutes", ts: str = "event_time", watermark: str | None = "10 minutes") -> DataFrame:
    """Inner join of two streams (or batches) on key, with times at most `within` apart."""
    r = right.select(F.col(key).alias("r_key"), F.col(ts).alias("r_time"), *[c for c in right.columns if c not in (key, ts)])
    left, r = _watermarked(left, ts, watermark), _watermarked(r, "r_time", watermark)
    near = F.expr(f"{ts} >= r_time - interval {within} and {ts} <= r_time + interval {within}")
    return left.join(r, (F.col(key) == F.col("r_key")) & near).drop("r_key")


def interval_join_batch(left: DataFrame, right: DataFrame, key: str = "movie_id", seconds: int = 300, ts: str = "event_time") -> DataFrame:
    """As interval_join for batches, with hot keys in mind: times fall into bins of the interval's length, and a row
    meets only its own and the neighbouring bins of its key instead of the key's whole history."""
    r = right.select(F.col(key).alias("r_key"), F.col(ts).alias("r_time"), *[c for c in right.columns if c not in (key, ts)])
    bin_ = lambda c: F.floor(F.unix_micros(F.col(c)) / (seconds * 1_000_000))
    r = r.withColumn("_bin", F.explode(F.array(*[bin_("r_time") + i for i in (-1, 0, 1)])))
    near = F.abs(F.unix_micros(F.col(ts)) - F.unix_micros(F.col("r_time"))) <= seconds * 1_000_000
    out = left.withColumn("_b", bin_(ts)).join(r, (F.col(key) == F.col("r_key")) & (F.col("_b") == F.col("_bin")))
    return out.where(near).drop("_b", "_bin", "r_key")


def hourly_stats_rollup(windows: DataFrame) -> DataFrame:
    """Per movie and hour over popularity windows. Windows of a stream chain on their window time."""
    aggs = [F.count("*").alias("window_count"), F.avg("avg_popularity").alias("avg_popularity"), F.avg("avg_vote_average").alias("avg_vote_average"), F.max("popularity_velocity").alias("max_popularity_velocity"), F.sum("update_count").alias("total_update_count")]
    return windows.groupBy("movie_id", F.date_trunc("hour", "window_start").alias("date_hour")).agg(*aggs)


def hourly_sentiment_rollup(windows: DataFrame) -> DataFrame:
    """Per movie and hour over sentiment windows; the mean is weighted by reviews."""
    n = F.sum("review_count")
    aggs = [F.count("*").alias("window_count"), n.alias("total_review_count"), F.try_divide(F.sum(F.col("avg_sentiment") * F.col("review_count")), n).alias("avg_sentiment_compound"), *[F.sum(f"{b}_count").alias(f"total_{b}_count") for b in ("positive", "negative", "neutral")]]
    return windows.groupBy("movie_id", F.date_trunc("hour", "window_start").alias("date_hour")).agg(*aggs)


def chained_rollup(events: DataFrame, value: str, ts: str = "event_time", inner: str = "5 minutes", outer: str = "1 hour", watermark: str | None = "10 minutes") -> DataFrame:
    """Two chained window aggregations on one stream: means of inner windows, averaged over outer ones."""
    first = _watermarked(events, ts, watermark).groupBy(F.window(ts, inner).alias("w"), "movie_id").agg(F.avg(value).alias("v"), F.count("*").alias("n"))
    out = first.groupBy(F.window(F.window_time("w"), outer).alias("window"), "movie_id").agg(F.count("*").alias("window_count"), F.avg("v").alias(f"avg_{value}"), F.sum("n").alias("total_update_count"))
    return _flat(out, ["movie_id"])


def without_duplicates(df: DataFrame, keys: list[str], ts: str = "event_time", watermark: str = "10 minutes") -> DataFrame:
    """Rows with new keys only; on a stream keys are remembered within the watermark."""
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def standard_window(df: DataFrame, ts: str = "event_time", duration: str = "5 minutes", delay: str = "2 minutes") -> DataFrame:
    """df with window_start and window_end of tumbling windows, and a watermark on ts."""
    w = F.window(ts, duration)
    return df.withWatermark(ts, delay).withColumn("_window", w).select(*df.columns, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"))
