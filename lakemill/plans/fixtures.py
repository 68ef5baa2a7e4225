"""The library's datasets as views over the given tables, in Spark and as a DuckDB WITH clause."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.datetime(2024, 1, 31)
EXTRACTED = dt.datetime(2024, 1, 31)
#: words that the given texts use, so that sentiment is not all neutral
POSITIVE, NEGATIVE = ["that", "with"], ["this", "from"]
LEXICON = {"that": 1.5, "with": 0.7, "this": -1.2, "from": -0.8}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def movies(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.avg("l_quantity").alias("q"), F.count("*").cast("int").alias("n"))
    return table(spark, sf, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("movie_id"), F.concat(F.lit("title "), F.col("o_orderkey").cast("string")).alias("title"), F.to_date("o_orderdate").alias("release_date"),
        F.array("o_orderpriority", "o_orderstatus").alias("genres"), (F.col("o_totalprice") / 1000).alias("popularity"), (F.col("q") / 5).alias("vote_average"), F.col("n").alias("vote_count"),
    )


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), (F.col("doc_id") % 50).alias("movie_id"), F.col("source").alias("author"), F.col("text").alias("content"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("created_at"),
    )


def credits(spark: SparkSession, sf: str) -> DataFrame:
    cast = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("order"), F.col("l_suppkey").alias("person_id"))))
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("movie_id")).agg(cast.alias("cast"))


def _events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("*", F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("ts").cast("timestamp").alias("event_time"))


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select(F.col("user_id").alias("movie_id"), F.least(F.col("value") / 20, F.lit(10.0)).alias("vote_average"), F.col("k").alias("vote_count"), F.col("value").alias("popularity"), "event_time")


def titled_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return ratings(spark, sf).withColumn("title", F.concat(F.lit("title "), F.col("movie_id").cast("string")))


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).where("event_type = 'signup'").select(F.col("user_id").alias("movie_id"), F.concat(F.lit("title "), F.col("user_id").cast("string")).alias("title"), "event_time")


def trending_events(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select(
        F.col("user_id").alias("movie_id"), F.concat(F.lit("title "), F.col("user_id").cast("string")).alias("title"), (F.col("value") / 10).alias("trend_score"),
        ((F.col("value") - 100) / 100).alias("popularity_delta"), ((F.col("k") - 50) / 50).alias("rating_velocity"), F.col("k").cast("long").alias("review_volume"), "event_time",
    )


def bronze_movies(spark: SparkSession, sf: str) -> DataFrame:
    """Raw movie records: two extractions a movie, an hour apart, the later with one more vote; odd ids lack a date."""
    m = movies(spark, sf)
    rows = m.select(
        F.col("movie_id").alias("id"), "title", F.col("title").alias("original_title"), F.lit("").alias("overview"),
        F.when(F.col("movie_id") % 7 == 0, F.lit("")).otherwise(F.col("release_date").cast("string")).alias("release_date"), F.lit(False).alias("adult"), "popularity", "vote_average",
        F.lit(None).cast("string").alias("poster_path"), F.lit(None).cast("string").alias("backdrop_path"), F.lit("en").alias("original_language"),
        F.when(F.col("movie_id") % 5 == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.when(F.col("movie_id") % 2 == 0, 28).otherwise(18).cast("long"), F.lit(1).cast("long"))).alias("genre_ids"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("v"), F.col("vote_count").cast("long").alias("n"),
    )
    stamp = F.when(F.col("v") == 0, "2024-01-30T22:00:00Z").otherwise("2024-01-30T23:00:00Z")
    return rows.withColumn("vote_count", F.col("n") + F.col("v")).withColumn("extraction_timestamp", stamp).withColumn("raw_data", F.concat_ws("|", "id", "v")).drop("v", "n")


def bronze_reviews(spark: SparkSession, sf: str) -> DataFrame:
    r = reviews(spark, sf)
    return r.select(F.col("review_id").alias("id"), "movie_id", "author", "content", F.col("created_at").cast("string").alias("created_at"), F.lit("2024-01-30T23:30:00Z").alias("extraction_timestamp"), F.col("review_id").alias("raw_data"))


def bronze_credits(spark: SparkSession, sf: str) -> DataFrame:
    c = credits(spark, sf)
    return c.select("movie_id", "cast", F.array().cast("array<struct<person_id:bigint,name:string,job:string>>").alias("crew"), F.lit("2024-01-30T23:30:00Z").alias("extraction_timestamp"), F.col("movie_id").cast("string").alias("raw_data"))


#: the same views in DuckDB
WITH = """
WITH movies AS (
  SELECT o_orderkey AS movie_id, 'title ' || o_orderkey AS title, CAST(o_orderdate AS DATE) AS release_date, [o_orderpriority, o_orderstatus] AS genres,
         o_totalprice / 1000 AS popularity, q / 5 AS vote_average, n AS vote_count
  FROM orders JOIN (SELECT l_orderkey, avg(l_quantity) AS q, CAST(count(*) AS INTEGER) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
reviews AS (
  SELECT CAST(doc_id AS VARCHAR) AS review_id, doc_id % 50 AS movie_id, source AS author, text AS content, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS created_at,
         list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS toks
  FROM documents),
scored AS (
  SELECT *, CASE WHEN len(toks) > 0 THEN greatest(-1.0, least(1.0,
      CAST(len(list_filter(toks, lambda x: x IN ('that', 'with'))) - len(list_filter(toks, lambda x: x IN ('this', 'from'))) AS DOUBLE) / len(toks) * 10)) ELSE 0.0 END AS sentiment_score,
    1.5 * len(list_filter(toks, lambda x: x = 'that')) + 0.7 * len(list_filter(toks, lambda x: x = 'with')) - 1.2 * len(list_filter(toks, lambda x: x = 'this')) - 0.8 * len(list_filter(toks, lambda x: x = 'from')) AS s
  FROM reviews),
credits AS (
  SELECT l_orderkey AS movie_id, list(l_suppkey ORDER BY l_linenumber, l_suppkey) AS people FROM lineitem GROUP BY l_orderkey),
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ratings AS (
  SELECT user_id AS movie_id, least(value / 20, 10.0) AS vote_average, k AS vote_count, value AS popularity, ts AS event_time, 'title ' || user_id AS title FROM ev),
metadata AS (SELECT user_id AS movie_id, 'title ' || user_id AS title, ts AS event_time FROM ev WHERE event_type = 'signup'),
trending_events AS (
  SELECT user_id AS movie_id, 'title ' || user_id AS title, value / 10 AS trend_score, (value - 100) / 100 AS popularity_delta, (k - 50) / 50 AS rating_velocity,
         CAST(k AS BIGINT) AS review_volume, ts AS event_time FROM ev),
day_ratings AS (
  SELECT movie_id, date_trunc('day', event_time) AS window_start, date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end, count(*) AS rating_count, avg(vote_average) AS avg_rating,
         min(vote_average) AS min_rating, max(vote_average) AS max_rating, coalesce(stddev_samp(vote_average), 0.0) AS stddev_rating,
         count(*) FILTER (vote_average >= 8) AS high_ratings, count(*) FILTER (vote_average >= 6 AND vote_average < 8) AS medium_ratings, count(*) FILTER (vote_average < 6) AS low_ratings,
         CASE WHEN count(*) > 1 THEN (max(vote_average) - min(vote_average)) / count(*) ELSE 0.0 END AS rating_velocity
  FROM ratings GROUP BY ALL),
day_popularity AS (
  SELECT movie_id, date_trunc('day', event_time) AS window_start, date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end, min(title) AS title, avg(popularity) AS avg_popularity,
         min(popularity) AS min_popularity, max(popularity) AS max_popularity, coalesce(stddev_samp(popularity), 0.0) AS stddev_popularity, avg(vote_average) AS avg_vote_average, count(*) AS update_count,
         CASE WHEN avg(popularity) > 0 THEN (max(popularity) - min(popularity)) / avg(popularity) ELSE 0.0 END AS popularity_velocity,
         CASE WHEN avg(popularity) > 0 THEN coalesce(stddev_samp(popularity), 0.0) / avg(popularity) ELSE 0.0 END AS popularity_acceleration
  FROM ratings GROUP BY ALL),
day_trend AS (
  SELECT movie_id, date_trunc('day', event_time) AS window_start, date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end, min(title) AS title, avg(trend_score) AS avg_trend_score,
         max(trend_score) AS max_trend_score, avg(popularity_delta) AS avg_popularity_delta, avg(rating_velocity) AS avg_rating_velocity, CAST(sum(review_volume) AS BIGINT) AS total_review_volume, count(*) AS event_count,
         CASE WHEN count(*) > 1 THEN (max(trend_score) - avg(trend_score)) / count(*) ELSE 0.0 END AS trend_velocity,
         (abs(avg(popularity_delta)) + abs(avg(rating_velocity))) / 2 AS trend_acceleration
  FROM trending_events GROUP BY ALL),
hour_sentiment AS (
  SELECT movie_id, date_trunc('hour', created_at) AS hour, date_trunc('hour', created_at) AS window_start, date_trunc('hour', created_at) + INTERVAL 1 HOUR AS window_end,
         avg(s / sqrt(s * s + 15)) AS avg_sentiment, count(*) AS review_count, count(*) FILTER (s / sqrt(s * s + 15) >= 0.05) AS positive_count,
         count(*) FILTER (s / sqrt(s * s + 15) <= -0.05) AS negative_count, count(*) FILTER (abs(s / sqrt(s * s + 15)) < 0.05) AS neutral_count
  FROM scored GROUP BY ALL),
hour_state AS (
  SELECT movie_id, date_trunc('hour', event_time) AS hour, arg_max(vote_average, (event_time, vote_count, popularity)) AS vote_average, arg_max(vote_count, (event_time, vote_count, popularity)) AS vote_count,
         arg_max(popularity, (event_time, vote_count, popularity)) AS popularity, max(event_time) AS last_updated
  FROM ratings GROUP BY ALL),
hour_top AS (
  SELECT * FROM (SELECT hour, CAST(row_number() OVER (PARTITION BY hour ORDER BY 0.5 * popularity + 0.5 * vote_count DESC, movie_id) AS INTEGER) AS rank, movie_id,
    0.5 * popularity + 0.5 * vote_count AS trending_score, popularity, vote_count FROM hour_state WHERE popularity >= 10 AND vote_count >= 10) WHERE rank <= 100)
"""
