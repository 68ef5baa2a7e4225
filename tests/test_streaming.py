"""Streams run over files until all is read, and must equal their batch twins."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.functions.scalar import stable_mean
from lakemill.plans import fixtures as fx
from lakemill.sources import streams
from lakemill.streaming import detect, state, windows

SCHEMA = T.StructType([T.StructField("movie_id", T.IntegerType()), T.StructField("vote_average", T.DoubleType()), T.StructField("vote_count", T.IntegerType()), T.StructField("popularity", T.DoubleType()), T.StructField("event_time", T.TimestampType())])
T0 = dt.datetime(2024, 1, 1)


def put(spark, path, rows):
    """One file a call, newer by its time stamp than those before."""
    old = set(glob.glob(f"{path}/*.parquet"))
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    for f in set(glob.glob(f"{path}/*.parquet")) - old:
        os.utime(f, (1_700_000_000 + 10 * len(old),) * 2)


def run(spark, df, tmp_path, mode="append", name="out"):
    q = streams.write_stream(df, "memory", f"{tmp_path}/check_{name}", mode, None, name)
    q.awaitTermination()
    return spark.sql(f"select * from {name}")


def source(spark, path, **options):
    return streams.read_stream(spark, "parquet", SCHEMA, path, maxFilesPerTrigger="1", **options)


def test_windows_equal_batch_where_closed(spark, sf, tmp_path):
    e = fx.ratings(spark, sf).withColumns({"movie_id": F.col("movie_id").cast("int")}).select(*SCHEMA.names)
    e.coalesce(1).write.parquet(f"{tmp_path}/in")
    got = run(spark, windows.rating_windows(source(spark, f"{tmp_path}/in"), "1 day"), tmp_path, name="closed")
    end = e.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    want = windows.rating_windows(e, "1 day").where(F.col("window_end") <= F.lit(end))
    key = lambda df: sorted((r["movie_id"], r["window_start"], r["rating_count"], round(r["avg_rating"], 9)) for r in df.collect())
    assert key(got) == key(want)


def test_late_rows_are_dropped(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0)])
    # rows are held against the watermark of the batch before, so two batches move it on
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0 + dt.timedelta(hours=2))])
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0 + dt.timedelta(hours=3))])
    put(spark, f"{tmp_path}/in", [(1, 9.0, 1, 1.0, T0 + dt.timedelta(minutes=1))])
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0 + dt.timedelta(hours=9))])
    got = run(spark, windows.time_windows(source(spark, f"{tmp_path}/in"), "event_time", "5 minutes", keys=["movie_id"]), tmp_path, name="late")
    assert sorted((r["window_start"], r["record_count"]) for r in got.collect()) == [(T0 + dt.timedelta(hours=h), 1) for h in (0, 2, 3)]


def test_sessions_and_chained(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, float(m), T0 + dt.timedelta(minutes=m)) for m in (0, 10, 20, 90)] + [(1, 5.0, 1, 1.0, T0 + dt.timedelta(hours=20))])
    got = run(spark, windows.session_windows(source(spark, f"{tmp_path}/in"), "event_time", "30 minutes", ["movie_id"]), tmp_path, name="sess")
    assert sorted(r["record_count"] for r in got.collect()) == [1, 3]
    got = run(spark, windows.chained_rollup(source(spark, f"{tmp_path}/in"), "popularity"), tmp_path, name="chain")
    assert sorted((r["window_start"].hour, r["window_count"]) for r in got.collect()) == [(0, 3), (1, 1)]


def test_stream_join_equals_batch(spark, tmp_path):
    put(spark, f"{tmp_path}/a", [(1, 5.0, i, 1.0, T0 + dt.timedelta(minutes=3 * i)) for i in range(10)])
    put(spark, f"{tmp_path}/b", [(1, 5.0, i, 1.0, T0 + dt.timedelta(minutes=7 * i)) for i in range(5)])
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b").select("movie_id", F.col("vote_count").alias("other"), "event_time")
    got = run(spark, windows.interval_join(source(spark, f"{tmp_path}/a"), source(spark, f"{tmp_path}/b").select("movie_id", F.col("vote_count").alias("other"), "event_time")), tmp_path, name="joined")
    pairs = lambda df: sorted((r["vote_count"], r["other"]) for r in df.collect())
    want = sorted((i, j) for i in range(10) for j in range(5) if abs(3 * i - 7 * j) <= 5)
    assert pairs(got) == want == pairs(windows.interval_join(a, b)) == pairs(windows.interval_join_batch(a, b))


def test_duplicates_within_watermark(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0), (1, 5.0, 1, 1.0, T0)])
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0), (2, 5.0, 1, 1.0, T0)])
    assert run(spark, windows.without_duplicates(source(spark, f"{tmp_path}/in"), ["movie_id"]), tmp_path, name="dups").count() == 2


def test_velocity_stream_equals_lag(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0), (2, 5.0, 1, -1.0, T0), (1, 5.0, 1, 3.0, T0 + dt.timedelta(minutes=1))])
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 7.0, T0 + dt.timedelta(minutes=2)), (2, 5.0, 1, 4.0, T0 + dt.timedelta(minutes=2))])
    got = run(spark, state.velocity_stream(source(spark, f"{tmp_path}/in"), "movie_id", "popularity"), tmp_path, name="vel")
    out = sorted((r["movie_id"], r["event_time"], r["velocity"], r["acceleration"]) for r in got.collect())
    assert [(m, v, a) for m, _, v, a in out] == [(1, 0.0, 0.0), (1, 1.0, 1.0), (1, 1.0, 0.0), (2, 0.0, 0.0), (2, 0.0, 0.0)]


def test_movie_state_stream(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 10, 1.0, T0)])
    put(spark, f"{tmp_path}/in", [(1, 5.0, 15, 1.0, T0 + dt.timedelta(minutes=1)), (1, 5.0, 12, 1.0, T0)])
    got = run(spark, state.movie_state_stream(source(spark, f"{tmp_path}/in")), tmp_path, "update", "st")
    assert sorted((r["last_vote_count"], r["vote_delta"]) for r in got.collect()) == [(10, 0), (15, 5)]


def test_cumulative_hour_table(spark, tmp_path):
    path = f"{tmp_path}/hours"
    rows = lambda *r: spark.createDataFrame(r, "movie_id int, hour timestamp, vote_average double, vote_count int, popularity double, last_updated timestamp")
    a = rows((1, T0, 5.0, 20, 50.0, T0), (2, T0, 5.0, 30, 60.0, T0))
    for _ in range(2):  # a batch run again changes nothing
        state.put_hour_state(a, path)
    state.put_hour_state(rows((1, T0, 5.0, 99, 90.0, T0 + dt.timedelta(minutes=5)), (2, T0, 1.0, 1, 1.0, T0 - dt.timedelta(minutes=5))), path)
    top = state.hour_top_list(spark.read.parquet(path))
    assert sorted((r["rank"], r["movie_id"]) for r in top.collect()) == [(1, 1), (2, 2)]


def test_upsert_stream(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0)])
    put(spark, f"{tmp_path}/in", [(1, 6.0, 2, 1.0, T0 + dt.timedelta(minutes=1))])
    streams.upsert_stream(source(spark, f"{tmp_path}/in"), f"{tmp_path}/view", ["movie_id"], "event_time", f"{tmp_path}/c", trigger=None).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/view").select("movie_id", "vote_count").collect()] == [(1, 2)]
    assert streams.stop_all(spark) == 0


def test_key_value_and_avro_schema(spark):
    df = spark.createDataFrame([(7, "x")], "movie_id int, title string")
    r = streams.key_value(df, "movie_id").first()
    assert (r["key"], json.loads(r["value"])) == ("7", {"movie_id": 7, "title": "x"})
    assert json.loads(streams.avro_schema(SCHEMA.__class__(SCHEMA.fields[:2]), "n"))["fields"][0]["name"] == "movie_id"
    env = streams.to_event_envelope(df, "t", "movie_id", "rating", "timestamp '1970-01-01 00:00:01'").first()
    assert json.loads(env["value"])["timestamp"] == 1000


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception):
        streams.read_stream(spark, "kafka", subscribe="x", **{"kafka.bootstrap.servers": "localhost:1"})


def test_equal_days_tie_whatever_order_their_events_come_in(spark):
    values = (0.1, 0.2, 0.3, 60.7, 70.9)
    rows = [(m, "t", v, 2.0, 2.0, 50, dt.datetime(2024, 1, 1, 0, i)) for m, vs in ((1, values), (2, values[::-1]), (3, values[2:] + values[:2])) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "movie_id long, title string, trend_score double, popularity_delta double, rating_velocity double, review_volume long, event_time timestamp")
    for split in (1, 4):
        got = windows.trend_velocity(df.repartition(split, "event_time"), "1 day")
        assert got.select("avg_trend_score", "trend_velocity").distinct().count() == 1
        assert [r["movie_id"] for r in detect.breakout_movies(got).orderBy("rank").collect()] == [1, 2, 3]


def test_stable_mean_of_odd_values(spark):
    rows = [("none", None), ("some", None), ("some", 2.0), ("inf", float("inf")), ("inf", 1.0), ("large", 1e300), ("large", 3e300), ("nan", float("nan"))]
    got = {r["k"]: r["m"] for r in spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(stable_mean("x").alias("m")).collect()}
    assert got["none"] is None and got["some"] == 2.0 and got["inf"] == float("inf") and got["large"] == 2e300 and got["nan"] != got["nan"]
