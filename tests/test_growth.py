"""What a task reads or holds, and how often work is done, as tables grow."""

import datetime as dt
import glob
import itertools
import random

import pandas as pd
from pyspark.sql import functions as F

from lakemill.plans import gold, table_queries
from lakemill.sources import layers
from lakemill.sources.tables import KeyedTable
from lakemill.streaming import state


def test_a_large_partition_of_a_layer_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 40_000, 1, 8).select("id", F.md5(F.col("id").cast("string")).alias("x"), *[F.lit(1).alias(f"partition_{c}") for c in ("year", "month", "day", "hour")])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        layers.write_layer(df, str(tmp_path), "bronze", "movies")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/bronze/movies/**/*.parquet", recursive=True)) > 1
    assert layers.read_layer(spark, str(tmp_path), "bronze", "movies").agg(F.count_distinct("id")).first()[0] == 40_000


def test_similar_movies_ranks_sets_and_not_targets(spark):
    r = random.Random(3)
    rows = [(i, float(r.randint(0, 9)), r.sample("abcde", r.randint(1, 3))) for i in range(60)]
    m = spark.createDataFrame(rows, "movie_id long, popularity double, features array<string>")
    got = gold.similar_movies(m, m.where("movie_id % 3 = 0"), 4)
    want = []
    for t, _, f in rows[::3]:
        near = sorted((-len({*f} & {*g}) / len({*f} | {*g}), -p, i) for i, p, g in rows if i != t and {*f} & {*g})[:4]
        want += [(t, n + 1, i, round(-s, 9), -p) for n, (s, p, i) in enumerate(near)]
    assert sorted((x.target, x["rank"], x.movie_id, round(x.similarity, 9), x.popularity) for x in got.collect()) == want
    assert "windowspecdefinition(target" not in got._jdf.queryExecution().analyzed().toString()


def test_collaboration_edges_deals_pairs_to_more_tasks(spark):
    r = random.Random(5)
    movies = [(m, [(i, p) for i, p in enumerate(r.sample(range(20), 6))]) for m in range(30)]
    credits = spark.createDataFrame(movies, "movie_id long, cast array<struct<order int, person_id long>>")
    got = gold.collaboration_edges(credits, rows=10)
    want: dict = {}
    for _, cast in movies:
        for pair in itertools.combinations(sorted(p for _, p in cast), 2):
            want[pair] = want.get(pair, 0) + 1
    assert {(x.a, x.b): x.movies for x in got.collect()} == want
    assert got.rdd.getNumPartitions() == 30 * 15 // 10


def test_an_upsert_without_partitions_runs_its_source_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def once(x):
        seen.add(1)
        return x

    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], "v")
    assert table.upsert(spark.range(0, 20_000, 1, 4).select(F.col("id").alias("k"), once("id").alias("v"))) == 20_000
    assert seen.value < 30_000


def test_slices_of_several_files_are_batches_of_rising_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(table_queries, "_root", lambda _: f"{tmp_path}/in")
    spans = []
    df = table_queries._rating_slices(spark, "/root/testdata/sf0.01", rows_a_file=1500)
    put = lambda b, _: spans.append(b.agg(F.min("event_time"), F.max("event_time"), F.count("*")).first())
    df.writeStream.foreachBatch(put).option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    assert len(glob.glob(f"{tmp_path}/in/*.parquet")) == 9
    assert len(spans) == 3 and sum(s[2] for s in spans) == 10_000
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


class _Store:
    """A handle and its one map, which count how often they are asked."""

    def __init__(self):
        self.map, self.timers, self.calls = {}, set(), 0

    def getMapState(self, *_):
        return self

    def __getattr__(self, name):
        self.calls += 1
        return {
            "iterator": lambda: iter(list(self.map.items())), "keys": lambda: iter(list(self.map)), "containsKey": lambda k: k in self.map, "getValue": self.map.get, "updateValue": self.map.__setitem__, "removeKey": self.map.pop,
            "registerTimer": self.timers.add, "deleteTimer": self.timers.discard, "listTimers": lambda: iter(list(self.timers)),
        }[name]

    def getCurrentWatermarkInMs(self):
        return 0


def test_hourly_velocity_asks_the_store_once_a_changed_hour(spark):
    store, op = _Store(), state._HourVelocity("event_time", 48 * state.HOUR_MS)
    op.init(store)
    for part in (range(50), range(40, 90)):
        rows = pd.DataFrame({"event_time": [pd.Timestamp(dt.datetime(2024, 1, 1)) + pd.Timedelta(hours=i) for i in part], "vote_count": 1, "popularity": 1.0, "vote_average": [float(i % 7) for i in part]})
        out = pd.concat(op.handleInputRows((1,), iter([rows]), store))
    assert len(out) == 40 and len(store.map) == 90 and store.calls <= 90 + 4 and len(store.timers) == 1
