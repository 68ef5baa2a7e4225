"""Queries of what runs or is stored: counts on the way, progress of streams, keyed state, versioned and bucketed tables."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import expectations
from lakemill.plans import fixtures as fx
from lakemill.plans import gold, serving, silver
from lakemill.plans.queries import _HOURS, _scored, ORACLES, query
from lakemill.session import shared_folder
from lakemill.sources import layers, streams, views
from lakemill.sources.metrics import StageCounts, StreamMetrics
from lakemill.sources.tables import KeyedTable
from lakemill.streaming import state, windows


def _root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"


def _silver_counts(spark: SparkSession, sf: str) -> StageCounts:
    """Silver movies of the last 4 hours and a half of extractions, written with a count at each stage, in one run."""
    counts = StageCounts()
    bronze = silver.lookback(fx.bronze_movies(spark, sf), "extraction_timestamp", fx.EXTRACTED, 4)
    df = silver.silver_movies(counts.at("looked_back", bronze), fx.EXTRACTED, 4)
    df = counts.at("latest", df, warnings=F.count_if(F.col("quality_flag") == "WARNING"))
    layers.write_layer(df, _root(spark), "silver", "movies")
    return counts


@query("SELECT 'looked_back' AS stage, 2 * count(*) AS rows FROM movies UNION ALL SELECT 'latest', count(*) FROM movies")
def stage_counts(spark, sf):
    return _silver_counts(spark, sf).table(spark)


@query(
    """SELECT m AS metric_name, TIMESTAMP '2024-01-31' AS timestamp, CAST(v AS DOUBLE) AS value, 'silver' AS job FROM (SELECT 'looked_back_rows' AS m, 2 * count(*) AS v FROM movies UNION ALL SELECT 'latest_rows', count(*) FROM movies
    UNION ALL SELECT 'latest_warnings', count(*) FROM movies WHERE movie_id % 7 = 0)"""
)
def stage_metrics(spark, sf):
    return _silver_counts(spark, sf).metrics(spark, fx.EVENTS_AS_OF, job="silver").withColumn("job", F.col("tags")["job"]).drop("tags")


def _rating_slices(spark: SparkSession, sf: str, parts: int = 3, rows_a_file: int = 500_000) -> DataFrame:
    """A stream of all ratings in slices of rising event time, one micro-batch each, of as many files as its rows ask for.

    Files are taken by their time stamps, so slices of one number of files, written one after the other, are the batches.
    """
    path, rows = _root(spark), fx.ratings(spark, sf)
    bounds = rows.agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    step = (bounds["b"] - bounds["a"]) / parts
    cuts = [bounds["a"] + i * step for i in range(1, parts)]
    at = reduce(lambda x, y: x + y, [(F.col("event_time") >= F.lit(c)).cast("int") for c in cuts])
    sizes = {r["at"]: r["n"] for r in rows.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()}
    # the smallest slice must fill as many files as the others: a task without rows writes none
    files = max(1, min(-(-max(sizes.values()) // rows_a_file), min(sizes.get(i, 0) for i in range(parts)) // 1000))
    for i in range(parts):
        rows.where(at == i).repartition(files).write.mode("append").parquet(path)
    return streams.read_stream(spark, "parquet", rows.schema, path, maxFilesPerTrigger=str(files))


@query(
    """SELECT 'input_rows' AS metric_name, CAST(count(*) AS DOUBLE) AS value FROM ratings UNION ALL SELECT 'watermark_seconds', floor(epoch_ms(max(event_time)) / 1000.0 - 600) FROM ratings UNION ALL SELECT 'state_rows_dropped_late', 0.0
    UNION ALL SELECT m, 1.0 FROM (VALUES ('batch_duration_ms'), ('processed_rows_per_second'), ('watermark_lag_seconds'), ('state_rows')) v(m)"""
)
def stream_progress_metrics(spark, sf):
    """Metric rows of a stream that reads all ratings: totals and the last watermark; of measured values only that they are there."""
    listener = StreamMetrics()
    spark.streams.addListener(listener)
    try:
        q = streams.write_stream(windows.rating_windows(_rating_slices(spark, sf), "1 day"), "noop", _root(spark), "append", None)
        q.awaitTermination()
        listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    rows = listener.drain(spark).where(F.col("tags")["run"] == str(q.runId))
    m, v = F.col("metric_name"), F.col("value")
    value = F.when(m.isin("input_rows", "state_rows_dropped_late"), F.sum(v)).when(m == "watermark_seconds", F.floor(F.max(v)).cast("double")).otherwise(F.max((v > 0).cast("double")))
    return rows.where(~m.isin("input_rows_per_second", "state_memory_bytes")).groupBy("metric_name").agg(value.alias("value"))


@query(
    """SELECT movie_id, last_vote_count, last_updated, expired FROM (SELECT movie_id, CAST(arg_max(vote_count, (event_time, vote_count)) AS BIGINT) AS last_vote_count, max(event_time) AS last_updated FROM ratings GROUP BY 1), (VALUES (false), (true)) e(expired)
    WHERE NOT expired OR epoch_us(last_updated) // 1000 + 172800000 <= (SELECT epoch_us(max(event_time)) // 1000 - 600000 FROM ratings)"""
)
def stream_movie_state(spark, sf):
    """The last votes of each movie, and once more, as expired, those silent for 48 hours: all ratings in one micro-batch."""
    path = _root(spark)
    rows = fx.ratings(spark, sf)
    rows.write.parquet(f"{path}/in")
    table = KeyedTable(spark, f"{path}/out", ["movie_id", "expired"], "last_updated")
    df = state.movie_state_stream(streams.read_stream(spark, "parquet", rows.schema, f"{path}/in"))
    streams.table_stream(df, table, "movie_state", f"{path}/check", mode="update", trigger=None).awaitTermination()
    return table.read().select("movie_id", "last_vote_count", "last_updated", "expired")


@query()
def hourly_velocity(spark, sf):
    return state.hourly_velocity(windows.latest_by_hour(fx.ratings(spark, sf)))


@query()
def stream_hourly_velocity(spark, sf):
    """The same by keyed state, over micro-batches of rising time, put by key into a versioned table."""
    path = _root(spark)
    table = KeyedTable(spark, f"{path}/out", ["movie_id", "hour"], "last_updated")
    df = state.hourly_velocity_stream(_rating_slices(spark, sf), lifetime="60 days")
    streams.table_stream(df, table, "hours", f"{path}/check", mode="update", trigger=None).awaitTermination()
    return table.read().select("movie_id", "hour", "vote_average", F.col("vote_count").cast("int").alias("vote_count"), "popularity", "last_updated", "rating_velocity")


for _name in ("hourly_velocity", "stream_hourly_velocity"):
    ORACLES[_name] = f"""{fx.WITH}{_HOURS}
SELECT movie_id, hour, round(vote_average, 9) + 0.0 AS vote_average, vote_count, round(popularity, 9) + 0.0 AS popularity, last_updated, round(rating_velocity, 9) + 0.0 AS rating_velocity FROM hv"""


@query("SELECT hour, rank, movie_id, trending_score FROM hour_top", "trending_score")
def stream_trending_topn(spark, sf):
    """The hours' lists, made anew with each of three micro-batches of rising time."""
    path = _root(spark)
    state.trending_topn_stream(_rating_slices(spark, sf), path, f"{path}/check", trigger=None).awaitTermination()
    return state.hour_tables(spark, path)[1].read().select("hour", "rank", "movie_id", "trending_score")


@query("SELECT movie_id, count(*) AS ratings, CAST(sum(vote_count) AS BIGINT) AS votes, max(popularity) AS top, max(event_time) AS last FROM ratings GROUP BY 1", "top")
def stream_running_totals(spark, sf):
    """Totals that add up over micro-batches; every batch is offered twice and counted once."""
    path = _root(spark)
    table = KeyedTable(spark, f"{path}/out", ["movie_id"], "last")

    def total(b: DataFrame) -> DataFrame:
        return b.groupBy("movie_id").agg(F.count("*").alias("ratings"), F.sum("vote_count").alias("votes"), F.max("popularity").alias("top"), F.max("event_time").alias("last"))

    def put(batch: DataFrame, number: int) -> None:
        for _ in range(2):
            table.add(total(batch), {"ratings": "sum", "votes": "sum", "top": "max"}, ("totals", number))

    _rating_slices(spark, sf).writeStream.foreachBatch(put).option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start().awaitTermination()
    return table.read().select("movie_id", "ratings", "votes", "top", "last")


@query(
    """SELECT movie_id, hour, vote_count, last_updated FROM hour_state WHERE hour >= TIMESTAMP '2024-01-29'"""
)
def versioned_speed_view(spark, sf):
    """A speed view, partitioned by day, written in two commits and purged of what has outlived its 48 hours."""
    hours = windows.latest_by_hour(fx.ratings(spark, sf)).select("movie_id", "hour", "vote_count", "last_updated", F.to_date("hour").alias("day"))
    table = views.speed_view_table(spark, _root(spark), "movie_stats", "last_updated", ["day"])
    table.upsert(hours.where("movie_id % 2 = 0"))
    table.upsert(hours.where("movie_id % 2 = 1 or hour >= timestamp '2024-01-20'"))
    table.purge("hour", 48, fx.EVENTS_AS_OF)
    return table.read().drop("day")


@query(places=11)
def bucketed_genre_analytics(spark, sf):
    """Genre analytics over Silver in buckets of movie_id: the reviews' means and the join move no row."""
    name, root = f"t{uuid.uuid4().hex}", _root(spark)
    movies = layers.write_bucketed(fx.movies(spark, sf), f"{name}_movies", f"{root}/movies", "movie_id", 8)
    reviews = layers.write_bucketed(_scored(spark, sf).select("movie_id", "sentiment_score"), f"{name}_reviews", f"{root}/reviews", "movie_id", 8)
    return gold.genre_analytics(movies, reviews, fx.EVENTS_AS_OF).drop("computed_at", "partition_year", "partition_month")


ORACLES["bucketed_genre_analytics"] = ORACLES["genre_analytics"]


_FILTER = "contains(title, '1') AND list_contains(genres, 'O') AND year(release_date) >= 1996 AND vote_average <= 8"


@query(f"SELECT movie_id, title, popularity, vote_average, release_date, (SELECT count(*) FROM movies WHERE {_FILTER}) AS total FROM movies WHERE {_FILTER} ORDER BY vote_average DESC, movie_id LIMIT 60", "popularity vote_average")
def search_after(spark, sf):
    """Three pages of 20, each sought from the last row of the one before."""
    out, after = None, None
    for _ in range(3):
        page = serving.search_after(fx.movies(spark, sf), after, "rating", 20, text="1", genre="O", years=(1996, None), ratings=(None, 8.0))
        out = page if out is None else out.unionByName(page)
        last = page.tail(1)
        if not last:
            break
        after = (last[0]["vote_average"], last[0]["movie_id"])
    return out


@query(
    """SELECT 'not_null:title' AS expectation, 1.0 AS observed, true AS success FROM movies UNION SELECT 'range:vote_average', avg(CASE WHEN vote_average BETWEEN 0 AND 6 THEN 1.0 ELSE 0.0 END), avg(CASE WHEN vote_average BETWEEN 0 AND 6 THEN 1.0 ELSE 0.0 END) >= 0.5 FROM movies
    UNION SELECT 'range:popularity', avg(CASE WHEN popularity >= 100 THEN 1.0 ELSE 0.0 END), avg(CASE WHEN popularity >= 100 THEN 1.0 ELSE 0.0 END) >= 0.5 FROM movies""",
    "observed",
)
def incremental_quality(spark, sf):
    """A suite over movies, year by year: each half of the years is checked by itself, and the stored results merge."""
    e = expectations
    suite = [e.not_null("title"), e.between("vote_average", 0, 6, 0.5), e.between("popularity", 100, None, 0.5), e.unique("movie_id")]
    df = fx.movies(spark, sf).withColumn("year", F.year("release_date"))
    table = KeyedTable(spark, _root(spark), ["suite", "part", "rule"], "rows")
    for half in (0, 1):
        table.upsert(e.partial_results(df.where(F.col("year") % 2 == half), suite, ["year"], "movies"))
    return e.merged_results(table.read()).where("expectation not like 'unique:%'").select("expectation", "observed", "success")


@query("SELECT user_id AS movie_id, CASE WHEN event_id % 3 = 2 THEN -1 ELSE event_id END AS vote_count, epoch_us(ts) // 1000 AS timestamp, CASE WHEN event_id % 3 = 2 THEN value ELSE -1 END AS popularity, CAST(7 + event_id % 3 AS BIGINT) AS schema_id FROM events WHERE event_id % 5 <> 0 UNION ALL SELECT -1, -1, -1, -1, 99 FROM events WHERE event_id % 5 = 0", "popularity")
def decode_registered(spark, sf):
    """Framed messages of three writer schemas on one topic, and of a number that nobody registered; -1 where a field is null."""
    rows = fx.table(spark, sf, "events").select("event_id", F.col("user_id").alias("movie_id"), "value", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"))
    old = F.to_json(F.struct("movie_id", F.col("event_id").alias("vote_count"), "timestamp"))
    more = F.to_json(F.struct("movie_id", F.col("event_id").alias("vote_count"), "timestamp", F.lit("x").alias("unknown_field")))
    other = F.to_json(F.struct("movie_id", F.col("value").alias("popularity"), "timestamp"))
    body = F.when(F.col("event_id") % 3 == 0, old).when(F.col("event_id") % 3 == 1, more).otherwise(other)
    number = F.when(F.col("event_id") % 5 == 0, 99).otherwise((7 + F.col("event_id") % 3).cast("int"))
    framed = rows.select(F.concat(F.lit(bytearray(1)), F.unhex(F.lpad(F.hex(number), 8, "0")), body.cast("binary")).alias("value"))
    kinds = streams.STREAMS["ratings"]
    writers = {7: "movie_id int, vote_count int, timestamp long", 8: "movie_id int, vote_count int, timestamp long, unknown_field string", 9: "movie_id int, popularity float, timestamp long"}
    writers = {k: type(kinds).fromDDL(v.replace("float", "double")) for k, v in writers.items()}
    good, bad = streams.decode_registered(framed, "ratings", writers, "json")
    good = good.select(F.col("movie_id").cast("long"), F.col("vote_count").cast("long"), "timestamp", "popularity", "schema_id")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("movie_id", "long"), ("vote_count", "long"), ("timestamp", "long"), ("popularity", "double"))]
    return good.unionByName(bad.select(*none, "schema_id")).na.fill(-1)
