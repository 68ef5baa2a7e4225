"""Keyed state with lifetimes, hourly velocity, listener metrics, counts on the way and versioned tables."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F
from test_streaming import T0, put, source

from lakemill.sources import streams
from lakemill.sources.metrics import METRIC, StageCounts, StreamMetrics, write_counted
from lakemill.sources.tables import Conflict, KeyedTable
from lakemill.streaming import state, windows

HOUR = dt.timedelta(hours=1)


def run_rows(spark, df, tmp_path, name, mode="update"):
    q = streams.write_stream(df, "memory", f"{tmp_path}/check_{name}", mode, None, name)
    q.awaitTermination()
    return spark.sql(f"select * from {name}").collect()


# ---- lifetimes ------------------------------------------------------------------------------------------------------


def test_state_of_a_silent_movie_goes_after_its_lifetime(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 10, 1.0, T0), (2, 5.0, 7, 1.0, T0)])
    put(spark, f"{tmp_path}/in", [(2, 5.0, 9, 1.0, T0 + 10 * HOUR)])
    put(spark, f"{tmp_path}/in", [(2, 5.0, 12, 1.0, T0 + 20 * HOUR)])
    # movie 1 was silent for its lifetime, so it starts anew
    put(spark, f"{tmp_path}/in", [(1, 5.0, 30, 1.0, T0 + 21 * HOUR)])
    got = run_rows(spark, state.movie_state_stream(source(spark, f"{tmp_path}/in"), lifetime="12 hours"), tmp_path, "life")
    assert sorted((r["movie_id"], r["last_updated"], r["last_vote_count"], r["vote_delta"], r["expired"]) for r in got) == [
        (1, T0, 10, 0, False), (1, T0, 10, 0, True), (1, T0 + 21 * HOUR, 30, 0, False),
        (2, T0, 7, 0, False), (2, T0 + 10 * HOUR, 9, 2, False), (2, T0 + 20 * HOUR, 12, 3, False),
    ]
    held = spark.read.format("statestore").option("stateVarName", "latest").load(f"{tmp_path}/check_life")
    assert held.count() == 2  # movies 1 (anew) and 2; nothing of the first life is left


def test_state_by_the_processing_clock(spark, tmp_path):
    got = []
    for votes, hours in ((10, 0), (15, 1)):
        # the second run comes more than a second after the first: the state is gone, so the difference is 0 again
        put(spark, f"{tmp_path}/in", [(1, 5.0, votes, 1.0, T0 + hours * HOUR)])
        df = state.movie_state_stream(source(spark, f"{tmp_path}/in"), lifetime="1 second", clock="processing")
        w = df.writeStream.foreachBatch(lambda b, _: got.extend(b.collect())).outputMode("update").option("checkpointLocation", f"{tmp_path}/c")
        w.trigger(once=True).start().awaitTermination(60)
    assert [(r["last_vote_count"], r["vote_delta"], r["expired"]) for r in got] == [(10, 0, False), (15, 0, False)]
    with pytest.raises(ValueError):
        state.movie_state_stream(source(spark, f"{tmp_path}/in"), clock="wall")


def rate(movie, hours, rating, votes=1, minutes=0):
    return (movie, rating, votes, 1.0, T0 + hours * HOUR + dt.timedelta(minutes=minutes))


BATCHES = [
    [rate(1, 0, 5.0), rate(1, 0, 6.0, 2, 5), rate(2, 0, 4.0), rate(1, 1, 7.0)],
    # a later row of the same hour, a late hour between two others, and a new movie
    [rate(1, 1, 8.0, 2, 30), rate(2, 3, 9.0), rate(3, 2, -1.0)],
    [rate(2, 1, 2.0, 1, 59), rate(1, 4, 1.0), rate(3, 4, 5.0), rate(1, 0, 9.0, 9, 1)],
]


def test_hourly_velocity_of_a_stream_equals_the_batch(spark, tmp_path):
    for b in BATCHES:
        put(spark, f"{tmp_path}/in", b)
    table = KeyedTable(spark, f"{tmp_path}/hours", ["movie_id", "hour"], "last_updated")
    streams.table_stream(state.hourly_velocity_stream(source(spark, f"{tmp_path}/in"), watermark="1 day"), table, "hours", f"{tmp_path}/c", mode="update", trigger=None).awaitTermination()
    want = state.hourly_velocity(windows.latest_by_hour(spark.read.parquet(f"{tmp_path}/in")))
    key = lambda df: sorted((r["movie_id"], r["hour"], r["vote_average"], r["vote_count"], r["rating_velocity"], r["last_updated"]) for r in df.collect())
    assert key(table.read()) == key(want)
    assert {(r["movie_id"], r["hour"]): r["rating_velocity"] for r in table.read().collect()}[2, T0 + 3 * HOUR] == (9.0 - 2.0) / 3.0


def test_hours_are_forgotten_after_their_lifetime(spark, tmp_path):
    for h in (0, 1, 30, 31, 60):
        put(spark, f"{tmp_path}/in", [rate(1, h, 5.0 + h)])
    streams.write_stream(state.hourly_velocity_stream(source(spark, f"{tmp_path}/in"), lifetime="6 hours"), "noop", f"{tmp_path}/c", "update", None).awaitTermination()
    held = spark.read.format("statestore").option("stateVarName", "hours").load(f"{tmp_path}/c")
    assert [r[0] for r in held.selectExpr("user_map_key.hour").collect()] == [int((T0 + 60 * HOUR - dt.datetime(1970, 1, 1)).total_seconds() * 1000)]


# ---- versioned tables -----------------------------------------------------------------------------------------------

ROW = "id int, n int, p string"


def keyed(spark, tmp_path, keys=("id",), by=("p",)):
    return KeyedTable(spark, f"{tmp_path}/table", list(keys), "n", list(by))


def content(table, version=None):
    return sorted((tuple(r) for r in table.read(version).select("id", "n", "p").collect()), key=str)


def test_versions_partitions_and_pruning(spark, tmp_path):
    t = keyed(spark, tmp_path)
    rows = lambda *r: spark.createDataFrame(r, ROW)
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.upsert(rows((1, 1, "a/b"), (2, 1, "b"), (3, 1, None), (1, 0, "a/b"))) == 3
    first = {k: p["folder"] for k, p in t.manifest().parts.items()}
    assert t.upsert(rows((1, 2, "b"))) == 2  # moves, so its old partition is touched too, and vanishes
    assert content(t) == [(1, 2, "b"), (2, 1, "b"), (3, 1, None)] and content(t, 1) == [(1, 1, "a/b"), (2, 1, "b"), (3, 1, None)]
    # the untouched partition is where it was
    assert sum(p["folder"] == first.get(k) for k, p in t.manifest().parts.items()) == 1
    assert [r["id"] for r in t.pruned(p=None).collect()] == [3] and len(t.pruned(p="b").inputFiles()) >= 1
    assert set(t.pruned(p="b").inputFiles()).isdisjoint(t.pruned(p=None).inputFiles())
    # a wider row adds a column, null in rows from before
    t.upsert(rows((4, 1, "c")).withColumn("x", F.lit(7)))
    assert sorted((r["id"], r["x"]) for r in t.read().collect() if r["x"]) == [(4, 7)] and t.read().count() == 4


def test_a_reader_keeps_its_version_while_the_table_is_replaced(spark, tmp_path):
    t = keyed(spark, tmp_path, by=())
    t.upsert(spark.range(50).selectExpr("cast(id as int) id", "1 n", "'a' p"))
    reader = t.read()
    assert reader.agg(F.sum("n")).first()[0] == 50
    for n in (2, 3):
        t.upsert(spark.range(50).selectExpr("cast(id as int) id", f"{n} n", "'a' p"))
        # planned before, run after: the old rows, none missing
        assert reader.agg(F.sum("n")).first()[0] == 50 and t.read().agg(F.sum("n")).first()[0] == 50 * n
    assert t.vacuum(24) == 0 and reader.count() == 50
    assert t.vacuum(-1) == 2 and t.read().count() == 50 and t._versions() == [3]


class Killed(Exception):
    pass


@pytest.mark.parametrize("before", [True, False])
def test_a_writer_that_dies_leaves_a_whole_table(spark, tmp_path, monkeypatch, before):
    """Killed before the commit nothing has changed; killed after it, the batch is known when it is run again."""
    t = keyed(spark, tmp_path)
    rows = lambda *r: spark.createDataFrame(r, ROW)
    t.add(rows((1, 10, "a"), (2, 5, "b")), {"n": "sum"}, ("s", 0))
    commit = KeyedTable._commit

    def dies(self, m):
        if not before:
            commit(self, m)
        raise Killed

    monkeypatch.setattr(KeyedTable, "_commit", dies)
    with pytest.raises(Killed):
        t.add(rows((1, 1, "a"), (3, 1, "b")), {"n": "sum"}, ("s", 1))
    monkeypatch.setattr(KeyedTable, "_commit", commit)
    assert content(t) == ([(1, 10, "a"), (2, 5, "b")] if before else [(1, 11, "a"), (2, 5, "b"), (3, 1, "b")])
    again = keyed(spark, tmp_path)
    for _ in range(2):
        again.add(rows((1, 1, "a"), (3, 1, "b")), {"n": "sum"}, ("s", 1))
    assert content(again) == [(1, 11, "a"), (2, 5, "b"), (3, 1, "b")]
    # what the dead writer staged is not named by any version
    assert again.vacuum(-1) >= (2 if before else 1) and content(again) == [(1, 11, "a"), (2, 5, "b"), (3, 1, "b")]


def test_two_writers_of_one_version_conflict(spark, tmp_path):
    a, b = keyed(spark, tmp_path), keyed(spark, tmp_path)
    rows = spark.createDataFrame([(1, 1, "a")], ROW)
    a.upsert(rows)
    m = b.manifest()
    a.upsert(rows.withColumn("n", F.lit(2)))
    m.version += 1
    with pytest.raises(Conflict):
        b._commit(m)
    assert content(a) == [(1, 2, "a")]


def test_purge_rewrites_only_what_loses_rows(spark, tmp_path):
    t = KeyedTable(spark, f"{tmp_path}/life", ["id"], "at", ["p"])
    hours = lambda h: T0 - h * HOUR
    t.upsert(spark.createDataFrame([(1, hours(1), "new"), (2, hours(100), "old"), (3, hours(100), "mixed"), (4, hours(2), "mixed"), (5, None, "none")], "id int, at timestamp, p string"))
    before = {k: p["folder"] for k, p in t.manifest().parts.items()}
    assert t.purge("at", 48, T0) == {"kept": 3, "deleted": 2}
    assert sorted(r["id"] for r in t.read().collect()) == [1, 4, 5]
    after = {k: p["folder"] for k, p in t.manifest().parts.items()}
    assert len(after) == 3 and sum(before[k] == f for k, f in after.items()) == 2
    assert t.purge("at", 48, T0) == {"kept": 3, "deleted": 0} and t.manifest().version == 2
    # the partitions are those that a later write meets
    t.upsert(spark.createDataFrame([(4, hours(0), "new")], "id int, at timestamp, p string"))
    assert sorted((r["id"], r["p"]) for r in t.read().collect()) == [(1, "new"), (4, "new"), (5, "none")]


def test_a_stream_that_adds_up_counts_a_replayed_batch_once(spark, tmp_path):
    for i in range(3):
        put(spark, f"{tmp_path}/in", [rate(1, i, 5.0), rate(2, i, 5.0), rate(1, i, 6.0, 2, 1)])
    table = KeyedTable(spark, f"{tmp_path}/counts", ["movie_id"], "last")
    total = lambda b: b.groupBy("movie_id").agg(F.count("*").alias("ratings"), F.max("event_time").alias("last"))
    start = lambda: streams.table_stream(source(spark, f"{tmp_path}/in"), table, "totals", f"{tmp_path}/c", {"ratings": "sum"}, total, trigger=None).awaitTermination()
    start()
    want = [(1, 6, T0 + 2 * HOUR + dt.timedelta(minutes=1)), (2, 3, T0 + 2 * HOUR)]
    assert sorted(tuple(r) for r in table.read().select("movie_id", "ratings", "last").collect()) == want
    # the driver was lost before the checkpoint knew of the last two batches: both run again
    for n in (1, 2):
        for f in (f"{n}", f".{n}.crc"):
            if os.path.exists(f"{tmp_path}/c/commits/{f}"):
                os.remove(f"{tmp_path}/c/commits/{f}")
    start()
    assert sorted(tuple(r) for r in table.read().select("movie_id", "ratings", "last").collect()) == want
    assert table.manifest().batches == {"totals": 2}
    # a stream of another name with its own checkpoint adds to the same table
    streams.table_stream(source(spark, f"{tmp_path}/in"), table, "second", f"{tmp_path}/c2", {"ratings": "sum"}, total, trigger=None).awaitTermination()
    assert {r["movie_id"]: r["ratings"] for r in table.read().collect()} == {1: 12, 2: 6}
    shutil.rmtree(f"{tmp_path}/c2")


# ---- counts and metrics ---------------------------------------------------------------------------------------------


def counting_source(spark, n):
    """A source of n rows that counts, in an accumulator, how many rows were ever made."""
    made = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for b in batches:
            made.add(len(b))
            yield b

    return spark.range(n).mapInPandas(pass_on, "id long"), made


def _lists(spark, root):
    return sorted((r["hour"], r["rank"], r["movie_id"], r["trending_score"]) for r in state.hour_tables(spark, root)[1].read().collect())


def test_top_lists_follow_late_rows_and_shrink(spark, tmp_path):
    day = dt.timedelta(days=1)
    put(spark, f"{tmp_path}/in", [(1, 5.0, 20, 40.0, T0), (2, 5.0, 20, 60.0, T0), (3, 5.0, 5, 90.0, T0), (1, 5.0, 20, 20.0, T0 + day), (None, 5.0, 20, 20.0, T0)])
    run = lambda: state.trending_topn_stream(source(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check", n=2, trigger=None).awaitTermination()
    run()
    next_day = (T0 + day, 1, 1, 20.0)
    assert _lists(spark, f"{tmp_path}/out") == [(T0, 1, 2, 40.0), (T0, 2, 1, 30.0), next_day]
    # a day late: 3 enters, 2 falls below the least popularity; an older row of 1 changes nothing
    minute = dt.timedelta(minutes=1)
    put(spark, f"{tmp_path}/in", [(3, 5.0, 20, 80.0, T0 + minute), (2, 5.0, 20, 1.0, T0 + minute), (1, 5.0, 99, 99.0, T0 - minute)])
    run()
    assert _lists(spark, f"{tmp_path}/out") == [(T0 - dt.timedelta(hours=1), 1, 1, 99.0), (T0, 1, 3, 50.0), (T0, 2, 1, 30.0), next_day]
    # nothing of the day is left in the list
    put(spark, f"{tmp_path}/in", [(1, 5.0, 1, 1.0, T0 + day + minute)])
    run()
    assert next_day[0] not in {r[0] for r in _lists(spark, f"{tmp_path}/out")}


def test_top_lists_are_made_when_the_driver_died_after_the_state(spark, tmp_path, monkeypatch):
    put(spark, f"{tmp_path}/in", [(1, 5.0, 20, 40.0, T0), (2, 5.0, 20, 60.0, T0)])
    run = lambda: state.trending_topn_stream(source(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/check", trigger=None).awaitTermination()

    def dies(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "replace", dies)
        with pytest.raises(Exception, match="lost"):
            run()
    hours, top = state.hour_tables(spark, f"{tmp_path}/out")
    assert hours.manifest().version == 1 and not top.exists()
    run()
    assert hours.manifest().version == 1 and _lists(spark, f"{tmp_path}/out") == [(T0, 1, 2, 40.0), (T0, 2, 1, 30.0)]


def test_replaced_partitions_lose_their_old_rows(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/lists", ["p", "k"], "", ["p"])
    rows = lambda *r: spark.createDataFrame(r, "p string, k int")
    table.replace(rows(("a", 1), ("a", 2), ("b", 1), (None, 1)))
    table.replace(rows(("a", 3)), table.partitions(rows((None, 0))))
    assert sorted((r["p"], r["k"]) for r in table.read().collect()) == [("a", 3), ("b", 1)]
    assert table.replace(rows(("c", 1)), batch=("s", 0)) == 1 and table.replace(rows(("c", 2)), batch=("s", 0)) == 0


def test_counts_come_from_the_run_that_writes(spark, tmp_path):
    src, made = counting_source(spark, 1000)
    counts = StageCounts()
    df = counts.at("read", src, largest=F.max("id"))
    df = counts.at("even", df.where("id % 2 = 0"))
    df = counts.at("groups", df.groupBy((F.col("id") % 10).alias("g")).count())
    df.write.parquet(f"{tmp_path}/out")
    assert counts.rows() == {"read": 1000, "even": 500, "groups": 5} and made.value == 1000
    assert counts.values()["read"]["largest"] == 999
    m = {r["metric_name"]: (r["value"], r["tags"]) for r in counts.metrics(spark, T0, job="silver", run=7).collect()}
    assert m["even_rows"] == (500.0, {"job": "silver", "run": "7"}) and len(m) == 4
    with pytest.raises(ValueError):
        counts.at("read", src)


def test_written_tables_are_counted_while_they_are_written(spark, tmp_path):
    a, made = counting_source(spark, 40)
    got = write_counted({"a": a, "none": spark.range(0)}, lambda n, df: df.write.parquet(f"{tmp_path}/{n}"))
    assert got == {"a": 40, "none": 0} and made.value == 40


def test_listener_turns_progress_into_metric_rows(spark, tmp_path):
    listener = StreamMetrics()
    spark.streams.addListener(listener)
    try:
        for h in (0, 2, 4):
            put(spark, f"{tmp_path}/in", [rate(1, h, 5.0), rate(2, h, 6.0)])
        q = streams.write_stream(windows.rating_windows(source(spark, f"{tmp_path}/in")), "noop", f"{tmp_path}/c", "append", None, "metered")
        q.awaitTermination()
        assert listener.wait(q)
        rows = listener.drain(spark).where("tags['query'] = 'metered'")
        assert rows.schema == spark.createDataFrame([], METRIC).schema
        m = {}
        for r in rows.orderBy(F.expr("cast(tags['batch'] as int)")).collect():
            m.setdefault(r["metric_name"], []).append(r["value"])
        assert sum(m["input_rows"]) == 6 and all(v > 0 for v in m["batch_duration_ms"]) and max(m["processed_rows_per_second"]) > 0
        epoch = (T0 - dt.datetime(1970, 1, 1)).total_seconds()
        # 10 minutes behind the latest event; the lag is what a batch is ahead of the watermark it began with
        assert m["watermark_seconds"][-1] == epoch + 4 * 3600 - 600 and m["watermark_lag_seconds"] == [7800.0, 7800.0]
        assert max(m["state_rows"]) >= 2 and listener.drain(spark).where("tags['query'] = 'metered'").count() == 0
    finally:
        spark.streams.removeListener(listener)
