"""Silver layer: lookback, keep-latest, projection to the contract, enrichment. All lazy; time is a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.scalar import first_or, map_genres, partition_year_month, quality_flag, safe_date, safe_timestamp
from lakemill.functions.sentiment import NEGATIVE, POSITIVE, word_label, word_score
from lakemill.operators.dedup import keep_latest


def lookback(df: DataFrame, ts: str, as_of: dt.datetime, hours: int, partitioned: bool | None = None) -> DataFrame:
    """Rows of the last hours before as_of. ts may be a string or a timestamp.

    With partitioned, an equal predicate on partition_year/month/day is added, so that only those folders are listed;
    by default that is so if df has these columns, as the tables of the lake do.
    """
    if partitioned is None:
        partitioned = {"partition_year", "partition_month", "partition_day"} <= set(df.columns)
    start = as_of - dt.timedelta(hours=hours)
    x = safe_timestamp(ts)
    out = df.where(x.between(F.lit(start), F.lit(as_of)))
    if partitioned:
        days = [(start + dt.timedelta(days=i)).date() for i in range((as_of.date() - start.date()).days + 1)]
        if len(days) <= 62:
            cond = F.lit(False)
            for d in days:
                cond = cond | ((F.col("partition_year") == d.year) & (F.col("partition_month") == d.month) & (F.col("partition_day") == d.day))
        else:
            ym = F.col("partition_year") * 100 + F.col("partition_month")
            cond = ym.between(start.year * 100 + start.month, as_of.year * 100 + as_of.month)
        out = out.where(cond)
    return out


def since_days(df: DataFrame, col: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows whose date is at most `days` before as_of."""
    return df.where(F.col(col) >= F.date_sub(F.lit(as_of), days))


def silver_movies(bronze: DataFrame, as_of: dt.datetime, hours: int = 4, genres: dict[int, str] | None = None) -> DataFrame:
    """Latest record of each id, projected, with genre names, quality flag and partition columns."""
    ts = F.col("extraction_timestamp")
    df = keep_latest(lookback(bronze, "extraction_timestamp", as_of, hours), ["id"], [safe_timestamp(ts).desc(), F.col("raw_data").desc()])
    df = df.select(
        F.col("id").cast("int").alias("movie_id"), "title", "original_title", "overview", safe_date("release_date").alias("release_date"), F.col("adult").cast("boolean").alias("adult"),
        F.col("popularity").cast("double").alias("popularity"), F.col("vote_average").cast("double").alias("vote_average"), F.col("vote_count").cast("int").alias("vote_count"),
        "poster_path", "backdrop_path", "original_language", safe_timestamp(ts).alias("processed_timestamp"), map_genres("genre_ids", genres).alias("genres"),
    )
    year, month = partition_year_month("release_date", "processed_timestamp")
    return df.withColumns({"quality_flag": quality_flag("title", "release_date"), "partition_year": year, "partition_month": month, "partition_genre": first_or("genres")})


def silver_reviews(bronze: DataFrame, as_of: dt.datetime, hours: int = 4, positive: list[str] = POSITIVE, negative: list[str] = NEGATIVE) -> DataFrame:
    """Latest record of each review with word-list sentiment."""
    ts = F.col("extraction_timestamp")
    df = keep_latest(lookback(bronze, "extraction_timestamp", as_of, hours), ["id"], [safe_timestamp(ts).desc(), F.col("raw_data").desc()])
    df = df.select(F.col("id").alias("review_id"), F.col("movie_id").cast("int").alias("movie_id"), "author", "content", safe_date(F.substring("created_at", 1, 10)).alias("review_date"), safe_timestamp(ts).alias("processed_timestamp"))
    df = df.withColumn("sentiment_score", word_score("content", positive, negative)).withColumn("sentiment_label", word_label("sentiment_score"))
    year, month = partition_year_month("review_date", "processed_timestamp")
    return df.withColumns({"partition_year": year, "partition_month": month})


def silver_credits(bronze: DataFrame, as_of: dt.datetime, hours: int = 4) -> DataFrame:
    """Latest credits of each movie, nested columns kept."""
    ts = F.col("extraction_timestamp")
    df = keep_latest(lookback(bronze, "extraction_timestamp", as_of, hours), ["movie_id"], [safe_timestamp(ts).desc(), F.col("raw_data").desc()])
    df = df.select(F.col("movie_id").cast("int").alias("movie_id"), "cast", "crew", safe_timestamp(ts).alias("processed_timestamp"))
    return df.withColumns({"partition_year": F.year("processed_timestamp"), "partition_month": F.month("processed_timestamp")})
