"""Explicit schemas of every dataset, keys of the serving views and their lifetimes."""

from __future__ import annotations

from pyspark.sql import types as T

_META = "extraction_timestamp string, partition_year int, partition_month int, partition_day int, partition_hour int"


_NAMED = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}
_PERSON = T.StructType([T.StructField("order", T.IntegerType()), T.StructField("person_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("character", T.StringType())])
_CREW = T.StructType([T.StructField("person_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("job", T.StringType())])
_NAMED |= {"strings": T.ArrayType(T.StringType()), "longs": T.ArrayType(T.LongType()), "cast": T.ArrayType(_PERSON), "crew": T.ArrayType(_CREW)}


def _of(fields: str) -> T.StructType:
    """A schema from "name type, name type ..."; no session is needed."""
    return T.StructType([T.StructField(n, _NAMED[t]) for n, t in (f.split() for f in fields.split(","))])


BRONZE = {
    "movies": _of(
        "id long, title string, original_title string, overview string, release_date string, adult boolean, popularity double, vote_average double, vote_count long, "
        f"poster_path string, backdrop_path string, original_language string, genre_ids longs, raw_data string, {_META}"
    ),
    "reviews": _of(f"id string, movie_id long, author string, content string, created_at string, raw_data string, {_META}"),
    "credits": _of(
        f"movie_id long, cast cast, crew crew, raw_data string, {_META}"
    ),
}
SILVER = {
    "movies": _of(
        "movie_id int, title string, original_title string, overview string, release_date date, adult boolean, popularity double, vote_average double, vote_count int, poster_path string, "
        "backdrop_path string, original_language string, processed_timestamp timestamp, genres strings, quality_flag string, partition_year int, partition_month int, partition_genre string"
    ),
    "reviews": _of(
        "review_id string, movie_id int, author string, content string, review_date date, processed_timestamp timestamp, sentiment_score double, sentiment_label string, partition_year int, partition_month int"
    ),
    "credits": _of(
        "movie_id int, cast cast, crew crew, processed_timestamp timestamp, partition_year int, partition_month int"
    ),
}
STREAMS = {
    "reviews": _of("review_id string, movie_id int, author string, content string, rating double, created_at long, url string"),
    "ratings": _of("movie_id int, vote_average double, vote_count int, popularity double, timestamp long"),
    "metadata": _of("movie_id int, title string, release_date string, genres strings, runtime int, budget long, revenue long, timestamp long, event_type string"),
    "trending": _of("movie_id long, title string, trend_score double, popularity_delta double, rating_velocity double, review_volume long, time_window string, timestamp long"),
}

#: partition columns of the written layers
PARTITIONS = {
    ("bronze", "*"): ["partition_year", "partition_month", "partition_day", "partition_hour"],
    ("silver", "movies"): ["partition_year", "partition_month", "partition_genre"],
    ("silver", "*"): ["partition_year", "partition_month"],
    ("gold", "*"): ["partition_year", "partition_month"],
}

#: natural keys of batch views, by view_type
BATCH_VIEW_KEYS = {
    "genre_analytics": ["view_type", "genre", "year", "month"],
    "trending_scores": ["view_type", "movie_id", "window"],
    "temporal_analysis": ["view_type", "year"],
}
#: primary keys of the speed views
SPEED_VIEW_KEYS = {
    "review_sentiments": ["movie_id", "hour", "window_start"],
    "movie_stats": ["movie_id", "hour"],
    "trending_movies": ["hour", "rank", "movie_id"],
    "movie_ratings_by_window": ["movie_id", "window_start"],
    "breakout_movies": ["movie_id", "window_start"],
    "declining_movies": ["movie_id", "window_start"],
    "movie_stats_hourly": ["date_hour", "movie_id"],
    "sentiment_hourly": ["date_hour", "movie_id"],
    "speed_layer_metrics": ["metric_name", "timestamp"],
}
#: hours that rows of a table live
TTL_HOURS = {
    "review_sentiments": 48,
    "movie_stats": 48,
    "trending_movies": 48,
    "movie_ratings_by_window": 48,
    "breakout_movies": 48,
    "declining_movies": 48,
    "latest_movie_stats": 48,
    "top_trending_movies": 48,
    "recent_sentiments": 6,
    "movie_stats_hourly": 168,
    "sentiment_hourly": 168,
    "speed_layer_metrics": 72,
}
#: days that a layer is kept
LAYER_DAYS = {"bronze": 90, "silver": 730, "gold": 1826}
