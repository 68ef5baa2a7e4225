"""One query for each operator of the library over the given tables, each beside the DuckDB SQL of its result."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions import scalar, sentiment
from lakemill.operators import dedup, expectations, rank, rolling
from lakemill.plans import fixtures as fx
from lakemill.plans import gold, serving, silver
from lakemill.session import shared_folder
from lakemill.sources import layers, streams, views
from lakemill.streaming import detect, state, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DAY = "1 day"


def rounded(df: DataFrame, places: int = 9) -> DataFrame:
    """Doubles rounded, with no negative zero: sums differ in their last bits between engines."""
    return df.select(*[(F.round(F.col(f.name), places) + 0.0).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields])


def query(sql: str | None = None, doubles: str = "", places: int = 9):
    """Registers a function under its name, with its oracle; doubles are the columns that both sides round.

    At 9 places no tie is near for means of values with few decimals; sums of large values take 6.
    """

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf: rounded(f(spark, sf), places)
        if sql:
            cols = doubles.split()
            head = "SELECT * " + (f"REPLACE ({', '.join(f'round({c}, {places}) + 0.0 AS {c}' for c in cols)}) " if cols else "")
            ORACLES[f.__name__] = f"{fx.WITH}\n{head}FROM ({sql})"
        return f

    return put


# ---- Gold -----------------------------------------------------------------------------------------------------------


def _scored(spark, sf):
    return fx.reviews(spark, sf).withColumn("sentiment_score", sentiment.word_score("content", fx.POSITIVE, fx.NEGATIVE))


@query(
    """SELECT genre, CAST(year(release_date) AS INTEGER) AS year, CAST(month(release_date) AS INTEGER) AS month, count(*) AS total_movies, avg(vote_average) AS avg_rating, CAST(sum(vote_count) AS BIGINT) AS total_votes,
    avg(popularity) AS avg_popularity, max(vote_average) AS max_rating, min(vote_average) AS min_rating, avg(ms) AS avg_sentiment
    FROM (SELECT m.*, unnest(genres) AS genre, ms FROM movies m LEFT JOIN (SELECT movie_id, avg(sentiment_score) AS ms FROM scored GROUP BY 1) USING (movie_id)) GROUP BY ALL""",
    "avg_rating avg_popularity max_rating min_rating avg_sentiment",
    places=11,
)
def genre_analytics(spark, sf):
    return gold.genre_analytics(fx.movies(spark, sf), _scored(spark, sf), fx.EVENTS_AS_OF).drop("computed_at", "partition_year", "partition_month")


_TREND = """SELECT movie_id, title, w.l AS "window", percent_rank() OVER (PARTITION BY w.l ORDER BY popularity DESC) * 100 AS trend_score,
    CASE WHEN date_diff('day', release_date, DATE '2001-08-02') <> 0 THEN CAST(vote_count AS DOUBLE) / date_diff('day', release_date, DATE '2001-08-02') END AS velocity, popularity
    FROM movies JOIN (VALUES (7, '7d'), (30, '30d'), (90, '90d')) w(d, l) ON release_date >= DATE '2001-08-02' - CAST(w.d AS INTEGER)"""


@query(_TREND, "trend_score velocity popularity")
def trending_scores(spark, sf):
    return gold.trending_scores(fx.movies(spark, sf), fx.AS_OF, stamp=fx.EVENTS_AS_OF).drop("computed_at", "partition_year", "partition_month")


@query(_TREND.replace("popularity DESC", "popularity"), "trend_score velocity popularity")
def trending_scores_higher_is_better(spark, sf):
    return gold.trending_scores(fx.movies(spark, sf), fx.AS_OF, higher_is_better=True, stamp=fx.EVENTS_AS_OF).drop("computed_at", "partition_year", "partition_month")


@query(
    """SELECT *, (total_movies - lag(total_movies) OVER (ORDER BY year)) * 100.0 / lag(total_movies) OVER (ORDER BY year) AS yoy_change FROM (
    SELECT CAST(year(release_date) AS INTEGER) AS year, count(*) AS total_movies, avg(vote_average) AS avg_rating, avg(popularity) AS avg_popularity, CAST(sum(vote_count) AS BIGINT) AS total_votes FROM movies GROUP BY 1)""",
    "avg_rating avg_popularity yoy_change",
)
def temporal_analysis(spark, sf):
    return gold.temporal_analysis(fx.movies(spark, sf), fx.EVENTS_AS_OF).drop("computed_at", "partition_year", "partition_month")


@query("SELECT CAST(month(release_date) AS INTEGER) AS month, count(*) AS total_movies, avg(popularity) AS avg_popularity, avg(vote_average) AS avg_rating FROM movies GROUP BY 1", "avg_popularity avg_rating")
def seasonal_pattern(spark, sf):
    return gold.seasonal_pattern(fx.movies(spark, sf))


@query(
    """SELECT genre, CAST(year(release_date) AS INTEGER) AS year, CASE WHEN popularity < 100 THEN 'low' WHEN popularity < 300 THEN 'mid' ELSE 'high' END AS tier, avg(ms) AS avg_sentiment, count(*) AS movies
    FROM (SELECT m.*, unnest(genres) AS genre, ms FROM movies m JOIN (SELECT movie_id, avg(sentiment_score) AS ms FROM scored GROUP BY 1) USING (movie_id)) GROUP BY ALL""",
    "avg_sentiment",
)
def sentiment_by_tier(spark, sf):
    return gold.sentiment_by_tier(fx.movies(spark, sf), _scored(spark, sf))


@query(
    """SELECT genre, count(*) AS movies, sum(popularity) AS budget, sum(vote_average) AS revenue, sum(vote_average) / sum(popularity) AS return_ratio
    FROM (SELECT *, unnest(genres) AS genre FROM movies WHERE popularity > 0) GROUP BY 1""",
    "budget revenue return_ratio", places=6)
def budget_analysis(spark, sf):
    return gold.budget_analysis(fx.movies(spark, sf).withColumns({"budget": F.col("popularity"), "revenue": F.col("vote_average")}))


@query(
    """SELECT target, CAST(rank AS INTEGER) AS rank, movie_id, similarity, popularity FROM (SELECT t.movie_id AS target, m.movie_id, CAST(len(list_intersect(t.f, m.f)) AS DOUBLE) / len(list_distinct(list_concat(t.f, m.f))) AS similarity, m.popularity,
    row_number() OVER (PARTITION BY t.movie_id ORDER BY CAST(len(list_intersect(t.f, m.f)) AS DOUBLE) / len(list_distinct(list_concat(t.f, m.f))) DESC, m.popularity DESC, m.movie_id) AS rank
    FROM (SELECT *, list_concat(genres, [CAST(year(release_date) AS VARCHAR)]) AS f FROM movies WHERE movie_id % 50 = 0) t JOIN (SELECT *, list_concat(genres, [CAST(year(release_date) AS VARCHAR)]) AS f FROM movies) m
    ON t.movie_id <> m.movie_id AND len(list_intersect(t.f, m.f)) > 0) WHERE rank <= 5""",
    "similarity popularity",
)
def similar_movies(spark, sf):
    m = fx.movies(spark, sf).withColumn("features", F.concat("genres", F.array(F.year("release_date").cast("string"))))
    return gold.similar_movies(m, m.where("movie_id % 50 = 0"))


@query(
    """SELECT movie_id, slope, intercept, last_x, intercept + slope * (last_x + 1) AS forecast FROM (SELECT movie_id, regr_slope(avg_popularity, x) AS slope, regr_intercept(avg_popularity, x) AS intercept, max(x) AS last_x
    FROM (SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(window_start AS DATE)) AS DOUBLE) AS x FROM day_popularity) GROUP BY 1)""",
    "slope intercept last_x forecast",
)
def demand_forecast(spark, sf):
    pts = windows.popularity_windows(fx.titled_ratings(spark, sf), DAY).withColumn("x", F.datediff(F.to_date("window_start"), F.lit(dt.date(2024, 1, 1))).cast("double"))
    return gold.demand_forecast(pts, "movie_id", "x", "avg_popularity", 1)


@query(
    """SELECT a, b, count(*) AS movies FROM (SELECT DISTINCT x.movie_id, x.p AS a, y.p AS b FROM (SELECT movie_id, unnest(people) AS p FROM credits) x JOIN (SELECT movie_id, unnest(people) AS p FROM credits) y
    ON x.movie_id = y.movie_id AND x.p < y.p) GROUP BY ALL"""
)
def collaboration_edges(spark, sf):
    return gold.collaboration_edges(fx.credits(spark, sf))


# ---- Silver ---------------------------------------------------------------------------------------------------------


@query(
    """SELECT CAST(movie_id AS INTEGER) AS movie_id, title, title AS original_title, '' AS overview, false AS adult, CAST(NULL AS VARCHAR) AS poster_path, CAST(NULL AS VARCHAR) AS backdrop_path, 'en' AS original_language,
    CASE WHEN movie_id % 7 = 0 THEN NULL ELSE CAST(release_date AS VARCHAR) END AS release_date, popularity, vote_average, CAST(vote_count + 1 AS INTEGER) AS vote_count,
    TIMESTAMP '2024-01-30 23:00:00' AS processed_timestamp, CASE WHEN movie_id % 5 = 0 THEN '' WHEN movie_id % 2 = 0 THEN 'Action,Unknown' ELSE 'Drama,Unknown' END AS genres,
    CASE WHEN movie_id % 7 = 0 THEN 'WARNING' ELSE 'OK' END AS quality_flag, CAST(CASE WHEN movie_id % 7 = 0 THEN 2024 ELSE year(release_date) END AS INTEGER) AS partition_year,
    CAST(CASE WHEN movie_id % 7 = 0 THEN 1 ELSE month(release_date) END AS INTEGER) AS partition_month, CASE WHEN movie_id % 5 = 0 THEN 'Unknown' WHEN movie_id % 2 = 0 THEN 'Action' ELSE 'Drama' END AS partition_genre FROM movies""",
    "popularity vote_average",
)
def silver_movies(spark, sf):
    df = silver.silver_movies(fx.bronze_movies(spark, sf), fx.EXTRACTED, 4)
    return df.withColumns({"genres": F.concat_ws(",", "genres"), "release_date": F.col("release_date").cast("string")})


@query(
    """SELECT review_id, CAST(movie_id AS INTEGER) AS movie_id, author, CAST(created_at AS DATE) AS review_date, sentiment_score,
    CASE WHEN sentiment_score > 0.2 THEN 'positive' WHEN sentiment_score < -0.2 THEN 'negative' ELSE 'neutral' END AS sentiment_label, CAST(year(created_at) AS INTEGER) AS partition_year, CAST(month(created_at) AS INTEGER) AS partition_month FROM scored""",
    "sentiment_score",
)
def silver_reviews(spark, sf):
    return silver.silver_reviews(fx.bronze_reviews(spark, sf), fx.EXTRACTED, 4, fx.POSITIVE, fx.NEGATIVE).drop("content", "processed_timestamp")


@query("SELECT CAST(movie_id AS INTEGER) AS movie_id, CAST(len(people) AS INTEGER) AS cast_size, CAST(people[1] AS BIGINT) AS lead, 2024 AS partition_year, 1 AS partition_month FROM credits")
def silver_credits(spark, sf):
    return silver.silver_credits(fx.bronze_credits(spark, sf), fx.EXTRACTED, 4).select("movie_id", F.size("cast").alias("cast_size"), F.get("cast", 0)["person_id"].alias("lead"), "partition_year", "partition_month")


@query("SELECT movie_id, title, vote_count FROM movies WHERE release_date >= DATE '2001-08-02' - 30")
def lookback_days(spark, sf):
    return silver.since_days(fx.movies(spark, sf), "release_date", fx.AS_OF, 30).select("movie_id", "title", "vote_count")


@query("SELECT l_orderkey, max(l_linenumber) AS l_linenumber, arg_max(l_suppkey, (l_linenumber, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY 1")
def keep_latest(spark, sf):
    df = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return dedup.keep_latest(df, ["l_orderkey"], [F.desc("l_linenumber"), F.desc("l_suppkey")])


@query("SELECT l_orderkey, max(l_linenumber) AS l_linenumber, arg_max(l_suppkey, (l_linenumber, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY 1")
def latest_by(spark, sf):
    return dedup.latest_by(fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), ["l_orderkey"], "l_linenumber", ["l_suppkey"])


@query("SELECT movie_id, title, CASE WHEN vote_count > 4 THEN 'popular' ELSE 'all' END AS category FROM movies")
def union_latest(spark, sf):
    m = fx.movies(spark, sf)
    a, b = m.select("movie_id", "title", F.lit("all").alias("category")), m.where("vote_count > 4").select("movie_id", "title", F.lit("popular").alias("category"))
    return dedup.union_latest([a, b], "movie_id")


@query(
    """SELECT movie_id, title, CAST(vote_count AS BIGINT) AS vote_count, '2024-01-31T00:00:00Z' AS extraction_timestamp, 2024 AS partition_year, 1 AS partition_month, 31 AS partition_day, 0 AS partition_hour,
    '{"movie_id":' || movie_id || ',"title":"' || title || '","vote_count":' || vote_count || '}' AS raw_data FROM movies"""
)
def ingest_metadata(spark, sf):
    return layers.with_ingest_metadata(fx.movies(spark, sf).select("movie_id", "title", F.col("vote_count").cast("long").alias("vote_count")), fx.EXTRACTED)


# ---- functions ------------------------------------------------------------------------------------------------------


@query("SELECT review_id, sentiment_score, CASE WHEN sentiment_score > 0.2 THEN 'positive' WHEN sentiment_score < -0.2 THEN 'negative' ELSE 'neutral' END AS label FROM scored", "sentiment_score")
def lexicon_sentiment(spark, sf):
    return _scored(spark, sf).select("review_id", "sentiment_score", sentiment.word_label("sentiment_score").alias("label"))


#: the default word lists as the oracle has them, written out and not taken from the library
_GOOD = "'excellent', 'amazing', 'great', 'wonderful', 'fantastic', 'perfect', 'love', 'loved', 'best', 'brilliant', 'outstanding', 'superb', 'masterpiece', 'incredible', 'awesome', 'beautiful', 'good'"
_BAD = "'terrible', 'awful', 'bad', 'worst', 'horrible', 'poor', 'boring', 'waste', 'disappointing', 'disappointed', 'dull', 'weak', 'fail', 'failed', 'hate', 'hated', 'trash'"
_OTHER = "'enjoyed', 'mediocre', 'ugly', 'worse', 'Superb', 'good.'"


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS review_id, word, CASE WHEN lower(word) IN ({_GOOD}) THEN 1.0 WHEN lower(word) IN ({_BAD}) THEN -1.0 ELSE 0.0 END AS sentiment_score,
    CASE WHEN lower(word) IN ({_GOOD}) THEN 'positive' WHEN lower(word) IN ({_BAD}) THEN 'negative' ELSE 'neutral' END AS label FROM (SELECT doc_id, list_extract([{_GOOD}, {_BAD}, {_OTHER}], CAST(doc_id % 40 AS INTEGER) + 1) AS word FROM documents)""",
    "sentiment_score",
)
def default_word_sentiment(spark, sf):
    """Each document gets one of the default words, or one that is none, in a short sentence."""
    words = F.array(*[F.lit(w.strip(" '")) for w in f"{_GOOD}, {_BAD}, {_OTHER}".split(",")])
    df = fx.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("review_id"), F.get(words, (F.col("doc_id") % 40).cast("int")).alias("word"))
    return df.withColumn("sentiment_score", sentiment.word_score(F.concat_ws(" ", F.lit("a"), "word", F.lit(" film\n")))).withColumn("label", sentiment.word_label("sentiment_score"))


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS review_id, CASE WHEN n = 0 THEN 0.0 ELSE greatest(-1.0, least(1.0, h * 10.0 / n)) END AS score, CASE WHEN n > 0 AND h * 10.0 / n > 0.2 THEN 'positive' WHEN n > 0 AND h * 10.0 / n < -0.2 THEN 'negative' ELSE 'neutral' END AS label FROM (SELECT doc_id, len(t) AS n, "
    f"len(list_filter(t, lambda x: x IN ({_GOOD}))) - len(list_filter(t, lambda x: x IN ({_BAD}))) AS h FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS t FROM documents))",
    "score",
)
def sql_sentiment(spark, sf):
    sentiment.register_sql(spark)
    fx.reviews(spark, sf).createOrReplaceTempView("_lakemill_reviews")
    return spark.sql("select review_id, sentiment_score(content) as score, sentiment_label(content) as label from _lakemill_reviews")


@query(
    """SELECT review_id, s / sqrt(s * s + 15) AS compound, CASE WHEN s / sqrt(s * s + 15) >= 0.05 THEN 'positive' WHEN s / sqrt(s * s + 15) <= -0.05 THEN 'negative' ELSE 'neutral' END AS band,
    CASE WHEN len(toks) = 0 THEN 0.0 ELSE (len(toks) - len(list_filter(toks, lambda x: x IN ('that', 'with', 'this', 'from')))) / (len(toks) + 1.5 * len(list_filter(toks, lambda x: x = 'that')) + 0.7 * len(list_filter(toks, lambda x: x = 'with')) + 1.2 * len(list_filter(toks, lambda x: x = 'this')) + 0.8 * len(list_filter(toks, lambda x: x = 'from'))) END AS neutral FROM scored""",
    "compound neutral",
)
def compound_sentiment(spark, sf):
    df = sentiment.compound_score(fx.reviews(spark, sf), "content", fx.LEXICON)
    return df.select("review_id", "sentiment.compound", scalar.sentiment_band("sentiment.compound").alias("band"), "sentiment.neutral")


@query(
    """SELECT movie_id, event_time, CAST(hour(event_time) AS INTEGER) AS hour_of_day, CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week, CAST(dayofyear(event_time) AS INTEGER) AS day_of_year,
    CAST(weekofyear(event_time) AS INTEGER) AS week_of_year FROM ratings"""
)
def time_features(spark, sf):
    return scalar.time_features(fx.ratings(spark, sf).select("movie_id", "event_time"), "event_time")


@query("SELECT movie_id, CASE WHEN movie_id % 5 = 0 THEN '' WHEN movie_id % 2 = 0 THEN 'Action,Unknown' ELSE 'Drama,Unknown' END AS names, CASE WHEN movie_id % 5 = 0 THEN 'Unknown' WHEN movie_id % 2 = 0 THEN 'Action' ELSE 'Drama' END AS primary_genre FROM movies")
def genre_names(spark, sf):
    b = dedup.keep_latest(fx.bronze_movies(spark, sf), ["id"], [F.col("extraction_timestamp").desc()]).withColumn("names", scalar.map_genres("genre_ids"))
    return b.select(F.col("id").alias("movie_id"), F.concat_ws(",", "names").alias("names"), scalar.first_or("names").alias("primary_genre"))


@query("SELECT event_id, date_trunc('second', ts) AS event_time FROM events")
def epoch_event_time(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select("event_id", scalar.event_time(F.unix_millis(F.col("ts").cast("timestamp"))).alias("event_time"))


@query("SELECT movie_id, window_start, CAST(86400 AS BIGINT) AS window_seconds, rating_count / 86400.0 AS records_per_second FROM day_ratings", "records_per_second")
def throughput(spark, sf):
    df = windows.rating_windows(fx.ratings(spark, sf), DAY)
    return scalar.throughput(df, "window_start", "window_end", "rating_count").select("movie_id", "window_start", "window_seconds", "records_per_second")


@query("SELECT event_id, CAST(epoch(date_trunc('hour', ts) + INTERVAL 1 HOUR) - epoch(date_trunc('second', ts)) AS BIGINT) AS latency_seconds, (epoch(date_trunc('hour', ts) + INTERVAL 1 HOUR) - epoch(date_trunc('second', ts))) / 60.0 AS latency_minutes FROM events", "latency_minutes")
def latency(spark, sf):
    e = fx.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).withColumn("done", F.date_trunc("hour", "ts") + F.expr("interval 1 hour"))
    return scalar.latency(e, "ts", "done").select("event_id", "latency_seconds", "latency_minutes")


@query("SELECT movie_id, window_start, 0.4 * trend_velocity + 0.3 * trend_acceleration + 0.3 * total_review_volume / 100 AS score FROM day_trend", "score")
def trend_score(spark, sf):
    df = windows.trend_velocity(fx.trending_events(spark, sf), DAY)
    return df.select("movie_id", "window_start", scalar.trend_score("trend_velocity", "trend_acceleration", "total_review_volume").alias("score"))


# ---- ranks and rolling windows --------------------------------------------------------------------------------------

_DAYS = "movie_id, window_start"


@query("SELECT movie_id, popularity, percent_rank() OVER (ORDER BY popularity DESC) AS popularity_percentile FROM movies", "popularity popularity_percentile")
def global_percent_rank(spark, sf):
    return rank.global_percent_rank(fx.movies(spark, sf).select("movie_id", "popularity"), "popularity", ascending=False, out="popularity_percentile")


@query("SELECT movie_id, event_time, popularity, percent_rank() OVER (PARTITION BY movie_id ORDER BY popularity) AS popularity_percentile FROM ratings", "popularity popularity_percentile")
def percentile_rank(spark, sf):
    return rank.percentile_rank(fx.ratings(spark, sf).select("movie_id", "event_time", "popularity"), "popularity", ["movie_id"])


@query("SELECT * FROM (SELECT movie_id, genre, vote_count, CAST(rank() OVER (PARTITION BY genre ORDER BY vote_count DESC) AS INTEGER) AS rank FROM (SELECT *, unnest(genres) AS genre FROM movies)) WHERE rank <= 10")
def top_k_ties(spark, sf):
    return rank.top_k(fx.movies(spark, sf).select("movie_id", F.explode("genres").alias("genre"), "vote_count"), ["genre"], "vote_count", 10)


@query("SELECT * FROM (SELECT movie_id, genre, popularity, CAST(row_number() OVER (PARTITION BY genre ORDER BY popularity DESC, movie_id) AS INTEGER) AS rank FROM (SELECT *, unnest(genres) AS genre FROM movies)) WHERE rank <= 10", "popularity")
def top_k_exact(spark, sf):
    return rank.top_k(fx.movies(spark, sf).select("movie_id", F.explode("genres").alias("genre"), "popularity"), ["genre"], "popularity", 10, "row_number", [F.col("movie_id")])


@query(
    f"""SELECT {_DAYS}, avg_popularity, v AS avg_popularity_velocity, coalesce(v - lag(v) OVER (PARTITION BY movie_id ORDER BY window_start), 0.0) AS avg_popularity_acceleration FROM (
    SELECT *, coalesce((avg_popularity - lag(avg_popularity) OVER w) / (lag(avg_popularity) OVER w + 1), 0.0) AS v FROM day_popularity WINDOW w AS (PARTITION BY movie_id ORDER BY window_start))""",
    "avg_popularity avg_popularity_velocity avg_popularity_acceleration")
def velocity_acceleration(spark, sf):
    df = windows.popularity_windows(fx.titled_ratings(spark, sf), DAY).select("movie_id", "window_start", "avg_popularity")
    return rolling.movie_velocity(df, "avg_popularity").drop("prev_avg_popularity", "prev_avg_popularity_velocity")


@query(
    """SELECT movie_id, event_time, (popularity - lag(popularity) OVER w) / nullif((epoch_us(event_time) - epoch_us(lag(event_time) OVER w)) / 1000000.0, 0) AS velocity FROM ratings WINDOW w AS (PARTITION BY movie_id ORDER BY event_time)""",
    "velocity",
)
def per_second_velocity(spark, sf):
    return rolling.per_second_velocity(fx.ratings(spark, sf).select("movie_id", "event_time", "popularity"), "popularity", ["movie_id"], "event_time").drop("popularity")


@query(
    f"SELECT {_DAYS}, " + ", ".join(f"avg(avg_popularity) OVER (PARTITION BY movie_id ORDER BY window_start ROWS {n - 1} PRECEDING) AS avg_popularity_ma_{n}" for n in (3, 5, 10)) + " FROM day_popularity",
    "avg_popularity_ma_3 avg_popularity_ma_5 avg_popularity_ma_10")
def moving_averages(spark, sf):
    df = windows.popularity_windows(fx.titled_ratings(spark, sf), DAY).select("movie_id", "window_start", "avg_popularity")
    return rolling.moving_averages(df, "avg_popularity", ["movie_id"], ["window_start"]).drop("avg_popularity")


_Z = """SELECT movie_id, window_start, z AS avg_popularity_zscore, abs(z) > {t} AS is_anomaly FROM (SELECT *, CASE WHEN stddev_samp(avg_popularity) OVER w > 0
    THEN (avg_popularity - avg(avg_popularity) OVER w) / stddev_samp(avg_popularity) OVER w ELSE 0.0 END AS z FROM day_popularity WINDOW w AS (PARTITION BY movie_id ORDER BY window_start ROWS 9 PRECEDING))"""


@query(_Z.format(t=2.0), "avg_popularity_zscore")
def zscore_anomalies(spark, sf):
    df = windows.popularity_windows(fx.titled_ratings(spark, sf), DAY).select("movie_id", "window_start", "avg_popularity")
    return rolling.zscore_anomalies(df, "avg_popularity", ["movie_id"], ["window_start"]).drop("avg_popularity")


@query(_Z.format(t=2.5), "avg_popularity_zscore")
def movie_anomalies(spark, sf):
    df = windows.popularity_windows(fx.titled_ratings(spark, sf), DAY).select("movie_id", "window_start", "avg_popularity")
    return rolling.movie_anomalies(df, "avg_popularity").drop("avg_popularity")


@query(
    "SELECT o_orderstatus, " + ", ".join(f"{f}(o_totalprice) AS o_totalprice_{n}" for f, n in (("count", "count"), ("avg", "avg"), ("min", "min"), ("max", "max"), ("sum", "sum"), ("stddev_samp", "stddev"))) + " FROM orders GROUP BY 1",
    "o_totalprice_avg o_totalprice_min o_totalprice_max o_totalprice_stddev", places=6)
def numeric_aggs(spark, sf):
    out = fx.table(spark, sf, "orders").groupBy("o_orderstatus").agg(*rolling.numeric_aggs(["o_totalprice"]))
    return out.withColumn("o_totalprice_sum", F.round("o_totalprice_sum", 2))


ORACLES["numeric_aggs"] = ORACLES["numeric_aggs"].replace("sum(o_totalprice) AS", "round(sum(o_totalprice), 2) AS")
_BINS = [(0.0, 50.0), (50.0, 100.0), (100.0, 500.0)]


@query("SELECT event_id, " + ", ".join(f"CASE WHEN value >= {a} AND value < {b} THEN 1 ELSE 0 END AS {rolling.bin_name('value', (a, b))}" for a, b in _BINS) + " FROM events")
def bin_indicators(spark, sf):
    return rolling.bin_indicators(fx.table(spark, sf, "events").select("event_id", "value"), "value", _BINS).drop("value")


@query("SELECT event_type, " + ", ".join(f"count(*) FILTER (value >= {a} AND value < {b}) AS {rolling.bin_name('value', (a, b))}" for a, b in _BINS) + " FROM events GROUP BY 1")
def histogram_counts(spark, sf):
    return rolling.histogram_counts(fx.table(spark, sf, "events"), "value", _BINS, ["event_type"])


# ---- windows of streams, over batches -------------------------------------------------------------------------------


@query("SELECT movie_id, date_trunc('day', event_time) AS window_start, date_trunc('day', event_time) + INTERVAL 1 DAY AS window_end, count(*) AS record_count FROM ratings GROUP BY ALL")
def tumbling_windows(spark, sf):
    return windows.time_windows(fx.ratings(spark, sf), "event_time", DAY, keys=["movie_id"])


@query(
    """SELECT movie_id, window_start, window_start + INTERVAL 2 DAY AS window_end, count(*) AS record_count FROM (
    SELECT movie_id, unnest([date_trunc('day', event_time), date_trunc('day', event_time) - INTERVAL 1 DAY]) AS window_start FROM ratings) GROUP BY ALL"""
)
def sliding_windows(spark, sf):
    return windows.time_windows(fx.ratings(spark, sf), "event_time", "2 days", DAY, keys=["movie_id"])


@query(
    """SELECT movie_id, min(event_time) AS window_start, max(event_time) + INTERVAL 6 HOUR AS window_end, count(*) AS record_count FROM (SELECT *, sum(new) OVER (PARTITION BY movie_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS g FROM (
    SELECT movie_id, event_time, CASE WHEN event_time < lag(event_time) OVER (PARTITION BY movie_id ORDER BY event_time) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM ratings)) GROUP BY movie_id, g"""
)
def session_windows(spark, sf):
    return windows.session_windows(fx.ratings(spark, sf), "event_time", "6 hours", ["movie_id"])


def _hour_sentiment(spark, sf):
    df = sentiment.compound_score(fx.reviews(spark, sf), "content", fx.LEXICON).withColumnRenamed("created_at", "event_time")
    return windows.sentiment_windows(df, duration="1 hour")


@query("SELECT * FROM hour_sentiment", "avg_sentiment")
def sentiment_windows(spark, sf):
    return _hour_sentiment(spark, sf)


@query("SELECT * FROM day_ratings", "avg_rating min_rating max_rating stddev_rating rating_velocity")
def rating_windows(spark, sf):
    return windows.rating_windows(fx.ratings(spark, sf), DAY)


@query("SELECT * FROM day_popularity", "avg_popularity min_popularity max_popularity stddev_popularity avg_vote_average popularity_velocity popularity_acceleration")
def popularity_windows(spark, sf):
    return windows.popularity_windows(fx.titled_ratings(spark, sf), DAY)


_TREND_D = "avg_trend_score max_trend_score avg_popularity_delta avg_rating_velocity trend_velocity trend_acceleration"


@query("SELECT * FROM day_trend", _TREND_D)
def trend_velocity(spark, sf):
    return windows.trend_velocity(fx.trending_events(spark, sf), DAY)


@query("SELECT * FROM hour_state", "vote_average popularity")
def latest_by_hour(spark, sf):
    return windows.latest_by_hour(fx.ratings(spark, sf))


_STREAM_JOIN = "SELECT r.movie_id, r.event_time, m.event_time AS r_time, m.title, r.vote_count FROM ratings r JOIN metadata m ON r.movie_id = m.movie_id AND r.event_time BETWEEN m.event_time - INTERVAL {m} MINUTE AND m.event_time + INTERVAL {m} MINUTE"


@query(_STREAM_JOIN.format(m=5))
def interval_join(spark, sf):
    return windows.interval_join(fx.ratings(spark, sf), fx.metadata(spark, sf)).select("movie_id", "event_time", "r_time", "title", "vote_count")


@query(_STREAM_JOIN.format(m=180))
def interval_join_binned(spark, sf):
    return windows.interval_join_batch(fx.ratings(spark, sf), fx.metadata(spark, sf), seconds=10800).select("movie_id", "event_time", "r_time", "title", "vote_count")


@query(
    """SELECT movie_id, window_start, 0.4 * popularity_velocity + 0.3 * avg_popularity + 0.3 * update_count AS popularity_score, 0.5 * rating_velocity + 0.3 * avg_rating + 0.2 * rating_count AS rating_score,
    0.6 * (0.4 * popularity_velocity + 0.3 * avg_popularity + 0.3 * update_count) + 0.4 * (0.5 * rating_velocity + 0.3 * avg_rating + 0.2 * rating_count) AS trend_score FROM day_popularity JOIN day_ratings USING (movie_id, window_start)""",
    "popularity_score rating_score trend_score")
def composite_trend(spark, sf):
    df = detect.composite_trend(windows.popularity_windows(fx.titled_ratings(spark, sf), DAY), windows.rating_windows(fx.ratings(spark, sf), DAY))
    return df.select("movie_id", "window_start", "popularity_score", "rating_score", "trend_score")


def _trend_days(spark, sf):
    return windows.trend_velocity(fx.trending_events(spark, sf), DAY)


def _rank_sql(score: str, where: str, more: str = "") -> str:
    return f"SELECT movie_id, window_start, total_review_volume, s AS {score}{more}, CAST(row_number() OVER (PARTITION BY window_start ORDER BY s DESC, movie_id) AS INTEGER) AS rank FROM (SELECT * FROM ({{src}}) WHERE {where})"


@query(
    _rank_sql("hotness_score", "s > 0").format(src="SELECT *, 0.5 * trend_velocity + 0.5 * trend_acceleration + total_review_volume / 100 * 0.3 AS s FROM day_trend WHERE avg_trend_score >= 10 AND total_review_volume >= 10"),
    "hotness_score")
def hot_movies(spark, sf):
    return detect.hot_movies(_trend_days(spark, sf)).select("movie_id", "window_start", "total_review_volume", "hotness_score", "rank")


@query(
    _rank_sql("breakout_score", "true", ", CASE WHEN avg_trend_score > 0 THEN max_trend_score / avg_trend_score ELSE 1.0 END AS surge_factor").format(src="SELECT *, 0.6 * trend_acceleration + 0.4 * trend_velocity AS s FROM day_trend WHERE trend_acceleration > 0.5 AND trend_velocity > 0.2 AND total_review_volume >= 3"),
    "breakout_score surge_factor")
def breakout_movies(spark, sf):
    return detect.breakout_movies(_trend_days(spark, sf)).select("movie_id", "window_start", "total_review_volume", "breakout_score", "surge_factor", "rank")


@query(
    _rank_sql("decline_score", "true", ", abs(v) AS momentum_loss").format(
        src="SELECT *, 0.7 * abs(v) + 0.3 * abs(trend_acceleration) AS s FROM (SELECT *, coalesce((avg_trend_score - lag(avg_trend_score) OVER w) / (lag(avg_trend_score) OVER w + 1), 0.0) AS v FROM day_trend WINDOW w AS (PARTITION BY movie_id ORDER BY window_start)) WHERE v < -0.1 AND avg_trend_score > 5 AND total_review_volume >= 2"
    ),
    "decline_score momentum_loss")
def declining_movies(spark, sf):
    df = rolling.movie_velocity(_trend_days(spark, sf), "avg_trend_score")
    return detect.declining_movies(df, "avg_trend_score_velocity").select("movie_id", "window_start", "total_review_volume", "decline_score", "momentum_loss", "rank")


@query("SELECT hour, rank, movie_id, coalesce(title, 'Unknown') AS title, trending_score, popularity, vote_count FROM hour_top LEFT JOIN (SELECT movie_id, arg_max(title, (event_time, title)) AS title FROM metadata GROUP BY 1) USING (movie_id)", "trending_score popularity")
def trending_topn(spark, sf):
    return detect.trending_topn(fx.ratings(spark, sf), titles=detect.latest_titles(fx.metadata(spark, sf)))


@query("SELECT movie_id, hour, 0.5 * popularity + 0.5 * vote_count AS trending_score FROM hour_state", "trending_score")
def hourly_trend(spark, sf):
    return detect.hourly_trend(fx.ratings(spark, sf)).select("movie_id", "hour", "trending_score")


@query(
    """SELECT movie_id, date_trunc('hour', window_start) AS date_hour, count(*) AS window_count, avg(avg_popularity) AS avg_popularity, avg(avg_vote_average) AS avg_vote_average, max(v) AS max_popularity_velocity, CAST(sum(n) AS BIGINT) AS total_update_count
    FROM (SELECT movie_id, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, avg(popularity) AS avg_popularity, avg(vote_average) AS avg_vote_average, count(*) AS n, CASE WHEN avg(popularity) > 0 THEN (max(popularity) - min(popularity)) / avg(popularity) ELSE 0.0 END AS v FROM ratings GROUP BY ALL) GROUP BY ALL""",
    "avg_popularity avg_vote_average max_popularity_velocity")
def hourly_stats_rollup(spark, sf):
    return windows.hourly_stats_rollup(windows.popularity_windows(fx.titled_ratings(spark, sf)))


@query(
    """SELECT movie_id, date_trunc('hour', window_start) AS date_hour, count(*) AS window_count, CAST(sum(n) AS BIGINT) AS total_review_count, sum(a * n) / sum(n) AS avg_sentiment_compound, CAST(sum(p) AS BIGINT) AS total_positive_count, CAST(sum(g) AS BIGINT) AS total_negative_count, CAST(sum(u) AS BIGINT) AS total_neutral_count
    FROM (SELECT movie_id, time_bucket(INTERVAL 5 MINUTE, created_at) AS window_start, avg(c) AS a, count(*) AS n, count(*) FILTER (c >= 0.05) AS p, count(*) FILTER (c <= -0.05) AS g, count(*) FILTER (abs(c) < 0.05) AS u FROM (SELECT *, s / sqrt(s * s + 15) AS c FROM scored) GROUP BY ALL) GROUP BY ALL""",
    "avg_sentiment_compound",
)
def hourly_sentiment_rollup(spark, sf):
    df = sentiment.compound_score(fx.reviews(spark, sf), "content", fx.LEXICON).withColumnRenamed("created_at", "event_time")
    return windows.hourly_sentiment_rollup(windows.sentiment_windows(df))


# ---- serving --------------------------------------------------------------------------------------------------------


@query(
    """SELECT movie_id, window_start, avg_rating, CASE WHEN window_start >= TIMESTAMP '2024-01-15' THEN 'speed' ELSE 'batch' END AS origin FROM day_ratings WHERE window_start < TIMESTAMP '2024-01-15' OR rating_count > 1""",
    "avg_rating",
)
def merge_views(spark, sf):
    df = windows.rating_windows(fx.ratings(spark, sf), DAY)
    batch, speed = df.select("movie_id", "window_start", "avg_rating", F.lit("batch").alias("origin")), df.where("rating_count > 1").select("movie_id", "window_start", "avg_rating", F.lit("speed").alias("origin"))
    return serving.merge_views(batch, speed, dt.datetime(2024, 1, 15), ["movie_id", "window_start"], "window_start")


def _documents(spark, sf):
    stats = state.hourly_velocity(windows.latest_by_hour(fx.ratings(spark, sf)))
    top = state.hourly_velocity(detect.trending_topn(fx.ratings(spark, sf)), "trending_score", "velocity", "acceleration")
    return views.speed_documents(_hour_sentiment(spark, sf), stats, top, fx.EVENTS_AS_OF)


_HOURS = """, hv AS (SELECT *, CASE WHEN prev IS NULL OR prev = -1 THEN 0.0 ELSE (vote_average - prev) / (prev + 1) END AS rating_velocity FROM (SELECT *, lag(vote_average) OVER (PARTITION BY movie_id ORDER BY hour) AS prev FROM hour_state)),
tv AS (SELECT *, coalesce(velocity - lag(velocity) OVER (PARTITION BY movie_id ORDER BY hour), 0.0) AS acceleration FROM (SELECT *, CASE WHEN prev IS NULL OR prev = -1 THEN 0.0 ELSE (trending_score - prev) / (prev + 1) END AS velocity
  FROM (SELECT *, lag(trending_score) OVER (PARTITION BY movie_id ORDER BY hour) AS prev FROM hour_top)))"""


@query()
def speed_documents(spark, sf):
    """Every column of the documents, payloads laid flat; -1 or an empty text where a document has no such payload."""
    flat = [F.col(f"{p}.{c}").alias(f"{p}_{c}") for p, cs in (("sentiment", "avg_sentiment review_count positive_count negative_count neutral_count"), ("stats", "vote_average vote_count popularity rating_velocity"), ("trending", "title rank trending_score velocity acceleration")) for c in cs.split()]
    return _documents(spark, sf).select("movie_id", "hour", "event_ts", "data_type", *flat, "updated_at").na.fill(-1).na.fill("")


ORACLES["speed_documents"] = f"""{fx.WITH}{_HOURS}
SELECT movie_id, hour, event_ts, data_type, coalesce(round(sentiment_avg_sentiment, 9) + 0.0, -1) AS sentiment_avg_sentiment, coalesce(sentiment_review_count, -1) AS sentiment_review_count, coalesce(sentiment_positive_count, -1) AS sentiment_positive_count, coalesce(sentiment_negative_count, -1) AS sentiment_negative_count, coalesce(sentiment_neutral_count, -1) AS sentiment_neutral_count,
  coalesce(round(stats_vote_average, 9) + 0.0, -1) AS stats_vote_average, coalesce(stats_vote_count, -1) AS stats_vote_count, coalesce(round(stats_popularity, 9) + 0.0, -1) AS stats_popularity, coalesce(round(stats_rating_velocity, 9) + 0.0, -1) AS stats_rating_velocity,
  coalesce(trending_title, '') AS trending_title, coalesce(trending_rank, -1) AS trending_rank, coalesce(round(trending_trending_score, 9) + 0.0, -1) AS trending_trending_score, coalesce(round(trending_velocity, 9) + 0.0, -1) AS trending_velocity, coalesce(round(trending_acceleration, 9) + 0.0, -1) AS trending_acceleration, TIMESTAMP '2024-01-31' AS updated_at
FROM (SELECT movie_id, hour, window_start AS event_ts, 'sentiment' AS data_type, avg_sentiment AS sentiment_avg_sentiment, review_count AS sentiment_review_count, positive_count AS sentiment_positive_count, negative_count AS sentiment_negative_count, neutral_count AS sentiment_neutral_count FROM hour_sentiment
  UNION ALL BY NAME SELECT movie_id, hour, hour AS event_ts, 'stats' AS data_type, vote_average AS stats_vote_average, vote_count AS stats_vote_count, popularity AS stats_popularity, rating_velocity AS stats_rating_velocity FROM hv
  UNION ALL BY NAME SELECT movie_id, hour, hour AS event_ts, 'trending' AS data_type, 'Unknown' AS trending_title, rank AS trending_rank, trending_score AS trending_trending_score, velocity AS trending_velocity, acceleration AS trending_acceleration FROM tv)"""


@query(
    """SELECT movie_id, a.x AS avg_sentiment, b.x AS vote_average, c.x AS trending_score, greatest(a.h, b.h, c.h) AS last_updated FROM (SELECT movie_id, arg_max(avg_sentiment, hour) AS x, max(hour) AS h FROM hour_sentiment GROUP BY 1) a
    FULL JOIN (SELECT movie_id, arg_max(vote_average, hour) AS x, max(hour) AS h FROM hour_state GROUP BY 1) b USING (movie_id) FULL JOIN (SELECT movie_id, arg_max(trending_score, hour) AS x, max(hour) AS h FROM hour_top GROUP BY 1) c USING (movie_id)""",
    "avg_sentiment vote_average trending_score")
def merged_latest(spark, sf):
    return serving.merged_latest(_documents(spark, sf)).select("movie_id", "sentiment.avg_sentiment", "stats.vote_average", "trending.trending_score", "last_updated")


@query("SELECT movie_id, arg_max(vote_average, hour) AS vote_average, arg_max(vote_count, hour) AS vote_count, max(hour) AS hour FROM hour_state WHERE movie_id IN (1, 5, 9) GROUP BY 1", "vote_average")
def movie_detail(spark, sf):
    return serving.movie_detail(windows.latest_by_hour(fx.ratings(spark, sf)), [1, 5, 9]).select("movie_id", "vote_average", "vote_count", "hour")


@query(
    """SELECT *, CASE WHEN overall_score >= 0.05 THEN 'positive' WHEN overall_score <= -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM (SELECT movie_id, sum(avg_sentiment * review_count) / sum(review_count) AS overall_score, CAST(sum(positive_count) AS BIGINT) AS positive_count,
    CAST(sum(negative_count) AS BIGINT) AS negative_count, CAST(sum(neutral_count) AS BIGINT) AS neutral_count, CAST(sum(review_count) AS BIGINT) AS total_reviews, min(hour) AS first_hour, max(hour) AS last_hour, arg_max(avg_sentiment, hour) - arg_min(avg_sentiment, hour) AS velocity FROM hour_sentiment GROUP BY 1)""",
    "overall_score velocity",
)
def movie_sentiment_summary(spark, sf):
    return serving.movie_sentiment_summary(_hour_sentiment(spark, sf), fx.EVENTS_AS_OF, None)


@query("SELECT movie_id, CAST(hour AS DATE) AS date, sum(avg_sentiment * review_count) / sum(review_count) AS avg_sentiment, CAST(sum(review_count) AS BIGINT) AS review_count FROM hour_sentiment GROUP BY ALL", "avg_sentiment")
def daily_sentiment(spark, sf):
    return serving.daily_sentiment(_hour_sentiment(spark, sf))


@query(
    """SELECT CAST(row_number() OVER (ORDER BY s DESC, movie_id) AS INTEGER) AS rank, movie_id, title, s AS trending_score FROM (SELECT movie_id, title, s FROM (SELECT movie_id, max(trending_score) AS s FROM hour_top WHERE hour >= TIMESTAMP '2024-01-30' GROUP BY 1)
    JOIN movies USING (movie_id) WHERE list_contains(genres, 'F') ORDER BY s DESC, movie_id LIMIT 20)""",
    "trending_score")
def trending_list(spark, sf):
    return serving.trending_list(detect.trending_topn(fx.ratings(spark, sf)).drop("title"), fx.movies(spark, sf), fx.EVENTS_AS_OF, 24, "F", 20)


@query(
    """SELECT genre, year, CAST(total_movies AS BIGINT) AS total_movies, avg_rating, avg_popularity, CASE WHEN avg_popularity > lag(avg_popularity) OVER (ORDER BY year) THEN 'up' WHEN avg_popularity < lag(avg_popularity) OVER (ORDER BY year) THEN 'down' ELSE 'stable' END AS direction
    FROM (SELECT 'F' AS genre, CAST(year(release_date) AS INTEGER) AS year, count(*) AS total_movies, avg(vote_average) AS avg_rating, avg(popularity) AS avg_popularity FROM movies WHERE list_contains(genres, 'F') GROUP BY 2)""",
    "avg_rating avg_popularity",
)
def genre_summary(spark, sf):
    return serving.genre_summary(gold.genre_analytics(fx.movies(spark, sf), as_of=fx.EVENTS_AS_OF), "F")


@query("SELECT movie_id, title, vote_average, popularity FROM movies WHERE list_contains(genres, 'F') ORDER BY vote_average DESC, popularity DESC, movie_id LIMIT 5", "vote_average popularity")
def genre_top_movies(spark, sf):
    return serving.genre_top_movies(fx.movies(spark, sf), "F")


_DAILY = "SELECT CAST(event_time AS DATE) AS date, avg(popularity) AS value, count(*) AS points FROM ratings WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-31' GROUP BY 1"


@query(_DAILY, "value")
def metric_trend(spark, sf):
    return serving.metric_trend(fx.ratings(spark, sf), "popularity", fx.EVENTS_AS_OF, 30)


@query(
    f"SELECT *, CASE WHEN change_rate > 0.01 THEN 'up' WHEN change_rate < -0.01 THEN 'down' ELSE 'stable' END AS trend FROM (SELECT avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value, regr_slope(value, epoch(date) / 86400) AS change_rate FROM ({_DAILY}))",
    "avg_value min_value max_value change_rate",
)
def trend_summary(spark, sf):
    return serving.trend_summary(serving.metric_trend(fx.ratings(spark, sf), "popularity", fx.EVENTS_AS_OF, 30))


@query(
    """SELECT movie_id, title, popularity, vote_average, release_date, 3 AS page, (SELECT count(*) FROM movies WHERE contains(title, '1') AND list_contains(genres, 'O') AND year(release_date) >= 1996 AND vote_average <= 8) AS total
    FROM (SELECT * FROM movies WHERE contains(title, '1') AND list_contains(genres, 'O') AND year(release_date) >= 1996 AND vote_average <= 8 ORDER BY vote_average DESC, movie_id LIMIT 20 OFFSET 40)""",
    "popularity vote_average",
)
def search(spark, sf):
    return serving.search(fx.movies(spark, sf), "1", "O", (1996, None), (None, 8.0), "rating", 20, 40)


@query("SELECT * FROM hour_sentiment WHERE movie_id = 7 AND hour >= TIMESTAMP '2024-01-31' - INTERVAL 800 HOUR", "avg_sentiment")
def sentiment_history(spark, sf):
    return serving.sentiment_history(_hour_sentiment(spark, sf), 7, fx.EVENTS_AS_OF, 800)


@query("SELECT hour, rank, movie_id, trending_score FROM hour_top WHERE hour >= TIMESTAMP '2024-01-10' AND hour < TIMESTAMP '2024-01-11'", "trending_score")
def trending_of_window(spark, sf):
    return serving.trending_of_window(detect.trending_topn(fx.ratings(spark, sf)), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11)).select("hour", "rank", "movie_id", "trending_score")


@query("SELECT * FROM hour_state ORDER BY last_updated DESC, movie_id LIMIT 25", "vote_average popularity")
def latest_stats(spark, sf):
    return serving.latest_stats(windows.latest_by_hour(fx.ratings(spark, sf)), 25)


@query(
    """SELECT layer, last_update, CAST(epoch(TIMESTAMP '2024-01-31') - epoch(date_trunc('second', last_update)) AS BIGINT) AS lag_seconds FROM (SELECT 'ratings' AS layer, max(event_time) AS last_update FROM ratings UNION ALL SELECT 'movies', CAST(max(release_date) AS TIMESTAMP) FROM movies)"""
)
def freshness(spark, sf):
    return serving.freshness({"ratings": (fx.ratings(spark, sf), "event_time"), "movies": (fx.movies(spark, sf), "release_date")}, fx.EVENTS_AS_OF)


@query("SELECT count(*) AS total_movies, CAST(sum(vote_count) AS BIGINT) AS total_votes, avg(vote_average) AS avg_rating, avg(popularity) AS avg_popularity FROM movies", "avg_rating avg_popularity")
def dashboard(spark, sf):
    return serving.dashboard(fx.movies(spark, sf))


@query("SELECT genre, count(*) AS movies, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM movies) AS share FROM (SELECT unnest(genres) AS genre FROM movies) GROUP BY 1", "share")
def genre_distribution(spark, sf):
    return serving.genre_distribution(fx.movies(spark, sf))


# ---- tables, quality, lifetimes -------------------------------------------------------------------------------------


@query(
    """SELECT movie_id, window_start, CASE WHEN rating_count > 1 THEN 2.0 ELSE 1.0 END AS version FROM day_ratings"""
)
def upsert_by_key(spark, sf):
    df = windows.rating_windows(fx.ratings(spark, sf), DAY)
    new = df.where("rating_count > 1").select("movie_id", "window_start", F.explode(F.array(F.lit(1.5), F.lit(2.0))).alias("version"))
    return views.merged_by_key(df.select("movie_id", "window_start", F.lit(1.0).alias("version")), new, ["movie_id", "window_start"], "version")


@query(f"SELECT *, 'trending_scores' AS view_type, TIMESTAMP '2024-01-31' AS computed_at FROM ({_TREND})", "trend_score velocity popularity")
def batch_view_export(spark, sf):
    """Exported by key into a versioned table, twice, and read back with every column. Gold is computed and written once."""
    root = f"{shared_folder(spark)}/views/{uuid.uuid4().hex}"
    df = gold.trending_scores(fx.movies(spark, sf), fx.AS_OF, stamp=fx.EVENTS_AS_OF)
    df.write.parquet(f"{root}/gold")
    df = spark.read.schema(df.schema).parquet(f"{root}/gold")
    for _ in range(2):
        table = views.batch_view_table(spark, root, "trending_scores")
        table.upsert(views.tag_batch_view(df, "trending_scores"))
    return table.read()


@query("SELECT CAST(year(max(release_date)) AS INTEGER) AS partition_year, CAST(month(max(release_date)) AS INTEGER) AS partition_month FROM movies")
def latest_partition(spark, sf):
    m = fx.movies(spark, sf).select(F.year("release_date").alias("partition_year"), F.month("release_date").alias("partition_month"))
    return layers.latest_partition(m, ["partition_year", "partition_month"])


@query("SELECT movie_id FROM movies ORDER BY popularity DESC, movie_id LIMIT 50")
def sample_ids(spark, sf):
    return layers.sample_ids(fx.movies(spark, sf), "movie_id", "popularity", 50)


@query("SELECT DISTINCT CAST(date_trunc('month', release_date) AS DATE) AS partition_date FROM movies WHERE date_trunc('month', release_date) < DATE '2001-08-02' - 730")
def expired_partitions(spark, sf):
    m = fx.movies(spark, sf).select(F.year("release_date").alias("partition_year"), F.month("release_date").alias("partition_month"))
    return layers.expired_partitions(m, "silver", fx.AS_OF)


@query("SELECT 'movies' AS \"table\", count(*) AS rows FROM movies UNION ALL SELECT 'reviews', count(*) FROM reviews UNION ALL SELECT 'ratings', count(*) FROM ratings")
def row_counts(spark, sf):
    return layers.row_counts({"movies": fx.movies(spark, sf), "reviews": fx.reviews(spark, sf), "ratings": fx.ratings(spark, sf)})


@query("SELECT movie_id, vote_count, event_time FROM ratings WHERE event_time >= TIMESTAMP '2024-01-29'")
def expire(spark, sf):
    return views.expire(fx.ratings(spark, sf), "event_time", 48, fx.EVENTS_AS_OF).select("movie_id", "vote_count", "event_time")


@query("SELECT count(*) FILTER (event_time >= TIMESTAMP '2024-01-29') AS kept, count(*) FILTER (event_time < TIMESTAMP '2024-01-29') AS deleted FROM ratings")
def expired_count(spark, sf):
    return views.expired_count(fx.ratings(spark, sf), "event_time", 48, fx.EVENTS_AS_OF)


@query("SELECT count(*) AS expiring FROM ratings WHERE event_time >= TIMESTAMP '2024-01-29' AND event_time < TIMESTAMP '2024-01-29 06:00:00'")
def expiring_soon(spark, sf):
    return views.expiring_soon(fx.ratings(spark, sf), "event_time", 48, fx.EVENTS_AS_OF, 6)


@query(
    """SELECT "table", rows, bytes, ttl, CASE WHEN bytes <= 1000000 THEN ttl ELSE greatest(6.0, ttl * 1000000.0 / bytes) END AS suggested, 100 - CASE WHEN "table" = 'ratings' THEN 50 ELSE 0 END - CASE WHEN bytes > 2147483648 THEN 15 ELSE 0 END AS score
    FROM (SELECT 'ratings' AS "table", count(*) AS rows, count(*) * 100 AS bytes, 48.0 AS ttl FROM ratings UNION ALL SELECT 'movies', count(*), count(*) * 200, 72.0 FROM movies)""",
    "ttl suggested",
)
def table_health(spark, sf):
    counts = layers.row_counts({"ratings": fx.ratings(spark, sf), "movies": fx.movies(spark, sf)})
    t = counts.withColumns({"ttl": F.when(F.col("table") == "ratings", 48.0).otherwise(72.0), "bytes": F.col("rows") * F.when(F.col("table") == "ratings", 100).otherwise(200)})
    t = t.withColumns({"ttl_hours": F.col("ttl").cast("int"), "actual_ttl_hours": F.lit(72)})
    return views.health_report(t).select("table", "rows", "bytes", "ttl", views.suggested_ttl(F.col("ttl"), F.col("bytes"), 1_000_000).alias("suggested"), "score")


@query("SELECT 'rows' AS metric_name, TIMESTAMP '2024-01-31' AS timestamp, CAST(count(*) AS DOUBLE) AS value, '24' AS window_hours FROM ratings")
def metric_rows(spark, sf):
    n = fx.ratings(spark, sf).agg(F.count("*").alias("value"))
    return views.metric_rows(n, "rows", fx.EVENTS_AS_OF, window_hours=24).withColumn("window_hours", F.col("tags")["window_hours"]).drop("tags")


@query(
    """SELECT * FROM (VALUES ('not_null:title'), ('range:vote_average'), ('range:popularity'), ('unique:movie_id'), ('type:movie_id')) v(expectation)
    JOIN (SELECT avg(CASE WHEN title IS NOT NULL THEN 1.0 ELSE 0 END) AS a, avg(CASE WHEN vote_average BETWEEN 0 AND 10 THEN 1.0 ELSE 0 END) AS b, avg(CASE WHEN popularity >= 100 THEN 1.0 ELSE 0 END) AS c, CAST(count(*) - count(DISTINCT movie_id) AS DOUBLE) AS d FROM movies) ON true"""
)
def quality_suite(spark, sf):
    e = expectations
    suite = [e.not_null("title"), e.between("vote_average", 0, 10), e.between("popularity", 100, None, 0.5), e.unique("movie_id"), e.has_type("movie_id", "bigint")]
    return e.run_suite(fx.movies(spark, sf), suite, "movies", "b1").select("expectation", "observed", "success")


ORACLES["quality_suite"] = f"""{fx.WITH}, x AS (SELECT avg(CASE WHEN title IS NOT NULL THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN vote_average BETWEEN 0 AND 10 THEN 1.0 ELSE 0.0 END) AS b,
  avg(CASE WHEN popularity >= 100 THEN 1.0 ELSE 0.0 END) AS c, CAST(count(*) - count(DISTINCT movie_id) AS DOUBLE) AS d FROM movies)
SELECT 'not_null:title' AS expectation, round(a, 9) + 0.0 AS observed, a >= 1 AS success FROM x UNION ALL SELECT 'range:vote_average', round(b, 9) + 0.0, b >= 1 FROM x
UNION ALL SELECT 'range:popularity', round(c, 9) + 0.0, c >= 0.5 FROM x UNION ALL SELECT 'unique:movie_id', d, d = 0 FROM x UNION ALL SELECT 'type:movie_id', 1.0, true"""


@query("SELECT movie_id, CASE WHEN movie_id % 7 = 0 THEN 'WARNING' ELSE 'OK' END AS quality_flag FROM movies")
def quality_flag(spark, sf):
    m = fx.movies(spark, sf).withColumn("release_date", F.when(F.col("movie_id") % 7 != 0, F.col("release_date")))
    return m.select("movie_id", scalar.quality_flag("title", "release_date").alias("quality_flag"))


@query("SELECT CAST(event_id AS INTEGER) AS movie_id, value AS vote_average, CASE WHEN k % 10 = 0 THEN 'vote_count: missing' WHEN k % 10 = 1 THEN 'vote_count: not int' ELSE '' END AS errors FROM ev", "vote_average")
def normalise_events(spark, sf):
    e = fx.table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    votes = F.when(F.col("k") % 10 == 1, "many").when(F.col("k") % 10 != 0, F.col("k").cast("string"))
    raw = e.select(F.col("event_id").cast("string").alias("movie_id"), F.col("value").cast("string").alias("vote_average"), votes.alias("vote_count"))
    good, bad = streams.normalise_events(raw, "ratings")
    a = good.select("movie_id", "vote_average", F.lit("").alias("errors"))
    return a.unionByName(bad.select(F.col("movie_id").cast("int").alias("movie_id"), F.col("vote_average").cast("double").alias("vote_average"), F.array_join("errors", ";").alias("errors")))


@query("""SELECT 'ratings' AS topic, CAST(movie_id AS VARCHAR) AS key, '{"movie_id":' || movie_id || ',"vote_count":' || vote_count || ',"timestamp":' || epoch_us(event_time) // 1000 || '}' AS value, 'rating' AS event_type FROM ratings""")
def event_envelope(spark, sf):
    r = fx.ratings(spark, sf).select("movie_id", "vote_count", F.unix_millis("event_time").alias("timestamp"))
    env = streams.to_event_envelope(r, "ratings", "movie_id", "rating")
    return env.select("topic", "key", "value", F.get("headers", 0)["value"].cast("string").alias("event_type"))


@query("SELECT user_id AS movie_id, event_id AS vote_count, epoch_us(ts) // 1000 AS timestamp FROM events")
def decode_framed(spark, sf):
    e = fx.table(spark, sf, "events")
    body = F.to_json(F.struct(F.col("user_id").alias("movie_id"), F.col("event_id").alias("vote_count"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")))
    framed = e.select(F.concat(F.lit(bytearray(5)), body.cast("binary")).alias("value"))
    return streams.decode(framed, "ratings", header=5).select(F.col("movie_id").cast("long"), F.col("vote_count").cast("long"), "timestamp")


# ---- streams run to their end (no SQL oracle but for the closed windows) --------------------------------------------


def _table_stream(spark, sf, name: str, schema: T.StructType) -> DataFrame:
    """A given table, one file or a folder of them, as a stream; by a pattern, as a path of its own would have to be a folder."""
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def _event_stream(spark, sf):
    schema = T.StructType.fromDDL("event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    df = _table_stream(spark, sf, "events", schema)
    return df.select(F.col("user_id").alias("movie_id"), F.least(F.col("value") / 20, F.lit(10.0)).alias("vote_average"), F.get_json_object("props", "$.k").cast("int").alias("vote_count"), F.col("value").alias("popularity"), F.col("ts").alias("event_time"))


def _run_to_table(spark, df: DataFrame, mode: str = "append") -> DataFrame:
    """The rows that a stream has written when all that is there is read."""
    path = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"
    streams.write_stream(df, "parquet", f"{path}/check", mode, None, path=f"{path}/out").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


@query("SELECT * FROM day_ratings WHERE window_end <= (SELECT max(event_time) FROM ratings) - INTERVAL 10 MINUTE", "avg_rating min_rating max_rating stddev_rating rating_velocity")
def stream_rating_windows(spark, sf):
    return _run_to_table(spark, windows.rating_windows(_event_stream(spark, sf), DAY))


@query("SELECT movie_id, hour, vote_count, popularity FROM hour_state WHERE hour + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM ratings) - INTERVAL 10 MINUTE", "popularity")
def stream_hourly_state(spark, sf):
    return _run_to_table(spark, windows.latest_by_hour(_event_stream(spark, sf))).select("movie_id", "hour", "vote_count", "popularity")


def _review_stream(spark, sf):
    """The documents as a stream of reviews."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    df = _table_stream(spark, sf, "documents", schema)
    return df.select((F.col("doc_id") % 50).alias("movie_id"), F.col("text").alias("content"), F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("event_time"))


@query("SELECT * FROM hour_sentiment WHERE window_end <= (SELECT max(created_at) FROM reviews) - INTERVAL 10 MINUTE", "avg_sentiment")
def stream_sentiment_windows(spark, sf):
    scored = sentiment.compound_score(_review_stream(spark, sf), "content", fx.LEXICON)
    return _run_to_table(spark, windows.sentiment_windows(scored, duration="1 hour"))


@query("SELECT movie_id, hour, 0.5 * popularity + 0.5 * vote_count AS trending_score FROM hour_state WHERE hour + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM ratings) - INTERVAL 10 MINUTE", "trending_score")
def stream_hourly_trend(spark, sf):
    return _run_to_table(spark, detect.hourly_trend(_event_stream(spark, sf))).select("movie_id", "hour", "trending_score")


# ---- layers, written and read again ---------------------------------------------------------------------------------


@query(
    """SELECT 'bronze' AS layer, 'movies' AS dataset, count(*) AS rows, count(DISTINCT movie_id) AS ids, 0 AS failed, true AS columns_ok FROM movies UNION ALL SELECT 'silver', 'movies', count(*), count(DISTINCT movie_id), CASE WHEN avg(CASE WHEN movie_id % 7 = 0 THEN 0.0 ELSE 1.0 END) >= 0.95 THEN 0 ELSE 1 END, true FROM movies
    UNION ALL SELECT 'gold', 'genre_analytics', count(*), count(*), 0, true FROM (SELECT DISTINCT g, year(d) AS y, month(d) AS m FROM (SELECT unnest(CASE WHEN movie_id % 5 = 0 THEN [] WHEN movie_id % 2 = 0 THEN ['Action', 'Unknown'] ELSE ['Drama', 'Unknown'] END) AS g,
    CASE WHEN movie_id % 7 <> 0 THEN release_date END AS d FROM movies))"""
)
def layer_roundtrip(spark, sf):
    """Bronze, Silver and Gold written as partitioned tables and read back: rows, ids, failed expectations and columns."""
    root = f"{shared_folder(spark)}/lake/{uuid.uuid4().hex}"
    raw = fx.bronze_movies(spark, sf).drop("extraction_timestamp", "raw_data")
    early, late = raw.where("vote_count % 2 = 0"), raw.where("vote_count % 2 = 1")
    layers.ingest_bronze([early, late], "id", fx.EXTRACTED - dt.timedelta(hours=1), root, "movies")
    bronze = layers.read_layer(spark, root, "bronze", "movies")
    layers.write_layer(silver.silver_movies(bronze, fx.EXTRACTED), root, "silver", "movies")
    movies = layers.read_layer(spark, root, "silver", "movies")
    # a stage that runs twice leaves one copy
    for _ in range(2):
        layers.write_layer(gold.genre_analytics(movies, as_of=fx.EXTRACTED), root, "gold", "genre_analytics")
    genres = layers.read_layer(spark, root, "gold", "genre_analytics")
    out = None
    for layer, name, df, ids, suite, needed in (
        ("bronze", "movies", bronze, ["id"], "bronze_movies", {"id", "title", "raw_data", "extraction_timestamp", "partition_hour"}),
        ("silver", "movies", movies, ["movie_id"], "silver_movies", {"movie_id", "genres", "quality_flag", "processed_timestamp", "partition_genre"}),
        ("gold", "genre_analytics", genres, ["genre", "year", "month"], "gold_genre_analytics", {"genre", "total_movies", "avg_rating", "computed_at", "partition_year"}),
    ):
        # every expectation runs; that of release dates fails, as the source leaves out one in seven
        failed = expectations.run_suite(df, expectations.SUITES[suite], suite).agg(F.count_if(~F.col("success")).cast("int").alias("failed"))
        n = df.agg(F.count("*").alias("rows"), F.count_distinct(F.struct(*ids)).alias("ids"))
        one = n.crossJoin(failed).select(F.lit(layer).alias("layer"), F.lit(name).alias("dataset"), "rows", "ids", "failed", F.lit(needed <= set(df.columns)).alias("columns_ok"))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    """SELECT movie_id, arg_max(vote_average, hour) AS vote_average, arg_max(vote_count, hour) AS vote_count, max(hour) AS hour, arg_max(origin, hour) AS origin FROM (
    SELECT *, 'batch' AS origin FROM hour_state WHERE hour < TIMESTAMP '2024-01-15' UNION ALL SELECT *, 'speed' FROM hour_state WHERE hour >= TIMESTAMP '2024-01-15' AND vote_count > 10) GROUP BY 1""",
    "vote_average",
)
def movie_detail_merged(spark, sf):
    """The latest row of every movie over the merged batch and speed views."""
    state = windows.latest_by_hour(fx.ratings(spark, sf)).select("movie_id", "hour", "vote_average", "vote_count")
    merged = serving.merge_views(state.withColumn("origin", F.lit("batch")), state.where("vote_count > 10").withColumn("origin", F.lit("speed")), dt.datetime(2024, 1, 15), ["movie_id", "hour"], "hour")
    return serving.merged_rows(merged)


@query("""SELECT movie_id, event_time, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end FROM ratings""")
def standard_window(spark, sf):
    return windows.standard_window(fx.ratings(spark, sf).select("movie_id", "event_time"))


@query("SELECT count(*) FILTER (hour >= TIMESTAMP '2024-01-29') AS kept, count(*) FILTER (hour < TIMESTAMP '2024-01-29') AS deleted, count(*) FILTER (hour >= TIMESTAMP '2024-01-29') AS left_over, count(*) AS written FROM hour_state")
def purge(spark, sf):
    """A speed view written by key, then rewritten without what has outlived its time."""
    root = f"{shared_folder(spark)}/views/{uuid.uuid4().hex}"
    state = windows.latest_by_hour(fx.ratings(spark, sf)).select("movie_id", "hour", "vote_average", "vote_count", "popularity", "last_updated")
    views.write_speed_view(state, "movie_stats", root, "last_updated")
    written = views.write_speed_views({"movie_stats": (state, "last_updated")}, root)["movie_stats"]
    counts = views.purge(spark, f"{root}/movie_stats", "hour", 48, fx.EVENTS_AS_OF)
    left = spark.read.parquet(f"{root}/movie_stats").agg(F.count("*").alias("left_over"))
    return left.select(F.lit(counts["kept"]).cast("long").alias("kept"), F.lit(counts["deleted"]).cast("long").alias("deleted"), "left_over", F.lit(written).cast("long").alias("written"))
