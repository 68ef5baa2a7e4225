"""Serving queries: the merge of batch and speed views and what is asked of it. All return DataFrames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions.scalar import sentiment_band


def merge_views(batch: DataFrame, speed: DataFrame, cutoff: dt.datetime, keys: list[str], ts: str) -> DataFrame:
    """Batch rows before the cutoff and speed rows from it on; on equal keys the speed row stays."""
    b, s = batch.where(F.col(ts) < F.lit(cutoff)), speed.where(F.col(ts) >= F.lit(cutoff))
    return s.unionByName(b.join(s.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def merged_latest(docs: DataFrame, key: str = "movie_id", ts: str = "event_ts", kind: str = "data_type", payloads: tuple[str, ...] = ("sentiment", "stats", "trending")) -> DataFrame:
    """One row a movie with the latest payload of each kind and the time of the last of all."""
    aggs = [F.max_by(p, F.when(F.col(kind) == p, F.col(ts))).alias(p) for p in payloads]
    return docs.groupBy(key).agg(*aggs, F.max(ts).alias("last_updated"))


def movie_detail(merged: DataFrame, movie_ids: list[int], keys: str = "movie_id", ts: str = "hour") -> DataFrame:
    """The latest merged row of each asked movie."""
    return merged_rows(merged.where(F.col(keys).isin(movie_ids)), keys, ts)


def merged_rows(merged: DataFrame, key: str = "movie_id", ts: str = "hour") -> DataFrame:
    """The latest row of every movie."""
    rest = [c for c in merged.columns if c != key]
    return merged.groupBy(key).agg(F.max_by(F.struct(*rest), ts).alias("r")).select(key, "r.*")


def movie_sentiment_summary(windows: DataFrame, as_of: dt.datetime, days: int | None = 7) -> DataFrame:
    """Per movie: review-weighted score, label, counts and velocity (last day's mean less the first's).

    windows has movie_id, hour, avg_sentiment, review_count, positive_count, negative_count, neutral_count.
    """
    df = windows if days is None else windows.where(F.col("hour") >= F.lit(as_of - dt.timedelta(days=days)))
    score = F.try_divide(F.sum(F.col("avg_sentiment") * F.col("review_count")), F.sum("review_count"))
    out = df.groupBy("movie_id").agg(
        score.alias("overall_score"), F.sum("positive_count").alias("positive_count"), F.sum("negative_count").alias("negative_count"), F.sum("neutral_count").alias("neutral_count"),
        F.sum("review_count").alias("total_reviews"), F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"),
        (F.max_by("avg_sentiment", "hour") - F.min_by("avg_sentiment", "hour")).alias("velocity"),
    )
    return out.withColumn("label", sentiment_band("overall_score"))


def daily_sentiment(windows: DataFrame) -> DataFrame:
    """Per movie and day: review-weighted score and reviews."""
    score = F.try_divide(F.sum(F.col("avg_sentiment") * F.col("review_count")), F.sum("review_count"))
    return windows.groupBy("movie_id", F.to_date("hour").alias("date")).agg(score.alias("avg_sentiment"), F.sum("review_count").alias("review_count"))


def trending_list(trending: DataFrame, movies: DataFrame, as_of: dt.datetime, hours: int = 24, genre: str | None = None, limit: int = 20) -> DataFrame:
    """Best score of each movie in the window, joined to its title and genres, ranked anew."""
    best = trending.where(F.col("hour") >= F.lit(as_of - dt.timedelta(hours=hours))).groupBy("movie_id").agg(F.max("trending_score").alias("trending_score"))
    df = best.join(movies.select("movie_id", "title", "genres"), "movie_id")
    if genre:
        df = df.where(F.array_contains("genres", genre))
    # the limit first: the rank is then taken over at most `limit` rows
    top = df.orderBy(F.desc("trending_score"), "movie_id").limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("trending_score"), "movie_id"))).select("rank", "movie_id", "title", "trending_score")


def genre_summary(gold: DataFrame, genre: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Genre analytics of one genre, one row a year, with the direction of its popularity against the year before."""
    df = gold.where(F.col("genre") == genre)
    if year:
        df = df.where(F.col("year") == year)
    if month:
        df = df.where(F.col("month") == month)
    n = F.col("total_movies")
    df = df.groupBy("genre", "year").agg(F.sum(n).alias("total_movies"), (F.sum(F.col("avg_rating") * n) / F.sum(n)).alias("avg_rating"), (F.sum(F.col("avg_popularity") * n) / F.sum(n)).alias("avg_popularity"))
    prev = F.lag("avg_popularity").over(Window.partitionBy("genre").orderBy("year"))
    return df.withColumn("direction", direction(F.col("avg_popularity") - prev, 0.0))


def direction(x: Column, tolerance: float) -> Column:
    return F.when(x > tolerance, "up").when(x < -tolerance, "down").otherwise("stable")


def genre_top_movies(movies: DataFrame, genre: str, k: int = 5) -> DataFrame:
    """The k best rated movies of a genre."""
    df = movies.where(F.array_contains("genres", genre))
    return df.select("movie_id", "title", "vote_average", "popularity").orderBy(F.desc("vote_average"), F.desc("popularity"), "movie_id").limit(k)


def metric_trend(points: DataFrame, metric: str, as_of: dt.datetime, days: int, ts: str = "event_time") -> DataFrame:
    """Daily means of a metric in the last days: date, value."""
    df = points.where((F.col(ts) >= F.lit(as_of - dt.timedelta(days=days))) & (F.col(ts) < F.lit(as_of)))
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.avg(metric).alias("value"), F.count("*").alias("points"))


def trend_summary(daily: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """One row: avg, min, max of the daily values, change per day (regression slope) and its direction."""
    day = F.unix_date("date").cast("double")
    out = daily.agg(F.avg("value").alias("avg_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.regr_slope(F.col("value"), day).alias("change_rate"))
    return out.withColumn("trend", direction(F.col("change_rate"), tolerance))


SORT_COLUMNS = {"popularity": "popularity", "rating": "vote_average", "release_date": "release_date"}


def matches(movies: DataFrame, text: str | None = None, genre: str | None = None, years: tuple[int | None, int | None] = (None, None), ratings: tuple[float | None, float | None] = (None, None)) -> DataFrame:
    """Movies whose title holds text, of a genre, and within ranges of release year and rating."""
    df = movies
    if text:
        df = df.where(F.contains(F.lower("title"), F.lit(text.lower())))
    if genre:
        df = df.where(F.array_contains("genres", genre))
    for col, (lo, hi) in ((F.year("release_date"), years), (F.col("vote_average"), ratings)):
        if lo is not None:
            df = df.where(col >= lo)
        if hi is not None:
            df = df.where(col <= hi)
    return df


def search(movies: DataFrame, text: str | None = None, genre: str | None = None, years: tuple[int | None, int | None] = (None, None), ratings: tuple[float | None, float | None] = (None, None), sort_by: str = "popularity", limit: int = 20, offset: int = 0) -> DataFrame:
    """A page of matching movies with page number and the total of matches, as one plan."""
    if sort_by not in SORT_COLUMNS or not 1 <= limit <= 100 or offset < 0:
        raise ValueError("sort_by, limit or offset out of range")
    df = matches(movies, text, genre, years, ratings)
    page = df.orderBy(F.desc(SORT_COLUMNS[sort_by]), "movie_id").offset(offset).limit(limit)
    return page.withColumn("total", df.agg(F.count("*").alias("n")).scalar()).withColumn("page", F.lit(offset // limit + 1)).select("movie_id", "title", "popularity", "vote_average", "release_date", "page", "total")


def search_after(movies: DataFrame, after: tuple[object, int] | None = None, sort_by: str = "popularity", limit: int = 20, **filters) -> DataFrame:
    """The matching movies that follow `after`, the (sort value, movie_id) of the last row seen, with the total of matches.

    A page deep in the result costs what the first one does: rows before the cursor are left out by a comparison instead
    of being sorted and skipped. The total is observed in the same scan. Rows without a sort value come last. The
    page itself (at most 100 rows) is made here.
    """
    if sort_by not in SORT_COLUMNS or not 1 <= limit <= 100:
        raise ValueError("sort_by or limit out of range")
    name, seen = SORT_COLUMNS[sort_by], Observation()
    cols = ["movie_id", "title", "popularity", "vote_average", "release_date"]
    df = matches(movies, **filters).select(*cols).observe(seen, F.count(F.lit(1)).alias("total"))
    if after is not None:
        value, last = after
        tied = F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        later = F.lit(False) if value is None else (F.col(name) < F.lit(value)) | F.col(name).isNull()
        df = df.where(F.coalesce(later, F.lit(False)) | (F.coalesce(tied, F.lit(False)) & (F.col("movie_id") > last)))
    page = df.orderBy(F.desc(name), "movie_id").limit(limit).collect()
    spark = movies.sparkSession
    return spark.createDataFrame([(*r, seen.get["total"]) for r in page], T.StructType([*df.schema.fields, T.StructField("total", T.LongType())]))


def sentiment_history(windows: DataFrame, movie_id: int, as_of: dt.datetime, hours_back: int = 24) -> DataFrame:
    """Newest first."""
    df = windows.where((F.col("movie_id") == movie_id) & (F.col("hour") >= F.lit(as_of - dt.timedelta(hours=hours_back))))
    return df.orderBy(F.desc("window_start"))


def trending_of_window(trending: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    return trending.where((F.col("hour") >= F.lit(start)) & (F.col("hour") < F.lit(end))).orderBy("hour", "rank")


def latest_stats(stats: DataFrame, n: int) -> DataFrame:
    """The n rows updated last (TakeOrderedAndProject)."""
    return stats.orderBy(F.desc("last_updated"), "movie_id").limit(n)


def freshness(views: dict[str, tuple[DataFrame, str]], as_of: dt.datetime) -> DataFrame:
    """layer, last_update, lag_seconds for each named view and its time column."""
    out = None
    for name, (df, ts) in views.items():
        one = df.agg(F.max(F.col(ts).cast("timestamp")).alias("last_update")).select(F.lit(name).alias("layer"), "last_update")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("lag_seconds", F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("last_update"))


def dashboard(movies: DataFrame) -> DataFrame:
    """One row: total movies, total votes, mean rating and popularity."""
    return movies.agg(F.count("*").alias("total_movies"), F.sum("vote_count").alias("total_votes"), F.avg("vote_average").alias("avg_rating"), F.avg("popularity").alias("avg_popularity"))


def genre_distribution(movies: DataFrame) -> DataFrame:
    """genre, movies and its share of all movies."""
    df = movies.select(F.explode("genres").alias("genre")).groupBy("genre").agg(F.count("*").alias("movies"))
    return df.withColumn("share", F.col("movies") / movies.agg(F.count("*").alias("n")).scalar())
