"""Hand-computed cases of the batch operators: ties, nulls, empty tables, boundary values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemill.functions import scalar, sentiment
from lakemill.operators import dedup, expectations as ex, rank, rolling
from lakemill.plans import gold, serving, silver
from lakemill.schemas import BRONZE
from lakemill.sources import layers, streams, views


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_word_score(spark):
    df = spark.createDataFrame([("great good bad movie",), ("great!",), ("",), (None,), ("terrible",), ("one two three four five six seven eight nine ten good",)], "t string")
    got = [r[0] for r in df.select(sentiment.word_score("t")).collect()]
    assert got == [1.0, 0.0, 0.0, 0.0, -1.0, pytest.approx(10 / 11)]
    sentiment.register_sql(spark)
    assert spark.sql("select sentiment_score('bad'), sentiment_label('bad'), sentiment_score(''), sentiment_label('good')").first() == (-1.0, "negative", 0.0, "positive")


def test_compound_score(spark):
    df = spark.createDataFrame([("good bad good",), (" ",), (None,)], "t string")
    got = [r[0] for r in sentiment.compound_score(df, "t", {"good": 2.0, "bad": -1.0}).select("sentiment").collect()]
    assert got[0].compound == pytest.approx(3 / (9 + 15) ** 0.5) and got[0].positive == pytest.approx(6 / 8) and got[0].negative == pytest.approx(2 / 8)
    assert tuple(got[1]) == tuple(got[2]) == (0, 0, 0, 0)


def test_genres_and_dates(spark):
    df = spark.createDataFrame([([28, 1], "2024-02-03"), ([], ""), (None, None)], "g array<long>, d string")
    out = df.select(scalar.map_genres("g"), scalar.first_or(scalar.map_genres("g")), scalar.safe_date("d")).collect()
    assert [tuple(r) for r in out] == [(["Action", "Unknown"], "Action", dt.date(2024, 2, 3)), ([], "Unknown", None), ([], "Unknown", None)]


def test_global_percent_rank_equals_window(spark):
    data = [(i % 3, float(i * 7919 % 101)) for i in range(500)] + [(0, None), (1, None)]
    df = spark.createDataFrame(data, "k int, v double")
    from pyspark.sql import Window

    for keys, asc in (([], True), ([], False), (["k"], True), (["k"], False)):
        order = F.col("v") if asc else (-F.col("v")).asc_nulls_first()
        want = df.withColumn("p", F.percent_rank().over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order)))
        got = rank.global_percent_rank(df, "v", keys, asc, "p", ranges=7)
        assert [(a, b, pytest.approx(c)) for a, b, c in rows(want, "k", "v", "p")] == rows(got, "k", "v", "p")
    one = rank.global_percent_rank(df.limit(1), "v", out="p").first()
    assert one["p"] == 0.0
    assert rank.global_percent_rank(df.limit(0), "v", out="p").count() == 0


def test_velocity_and_zscore(spark):
    df = spark.createDataFrame([(1, t, v) for t, v in enumerate([1.0, 3.0, -1.0, 5.0])], "movie_id int, window_start int, m double")
    got = rolling.movie_velocity(df, "m").orderBy("window_start").collect()
    assert [r["m_velocity"] for r in got] == [0.0, 1.0, -1.0, 0.0]  # previous -1 divides by zero
    assert [r["m_acceleration"] for r in got] == [0.0, 1.0, -2.0, 1.0]
    flat = spark.createDataFrame([(1, t, 2.0) for t in range(3)], "movie_id int, window_start int, m double")
    assert {tuple(r) for r in rolling.movie_anomalies(flat, "m").select("m_zscore", "is_anomaly").collect()} == {(0.0, False)}


def test_top_k_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1)], "g string, id int, m int")
    assert rank.top_k(df, ["g"], "m", 1).count() == 2
    assert rank.top_k(df, ["g"], "m", 1, "row_number", [F.col("id")]).count() == 1


def test_latest_and_union(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None)], "id int, t int, x string")
    assert rows(dedup.latest_by(df, ["id"], "t"), "id", "x") == [(1, "b"), (2, None)]
    assert rows(dedup.union_latest([df.where("t=1"), df.where("t=2")], "id"), "id", "x") == [(1, "b"), (2, None)]


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, 11.0), (2, "b", None)], "id int, s string, v double")
    suite = [ex.columns_are("id", "s", "v"), ex.not_null("s"), ex.not_null("s", 0.6), ex.unique("id"), ex.between("v", 0, 10), ex.between("v", 0, 10, 0.5), ex.has_type("id", "int"), ex.in_set("s", "a", "b"), ex.not_null("gone")]
    res = ex.run_suite(df, suite, "x")
    assert {r["expectation"]: r["success"] for r in res.where("expectation not in ('not_null:s', 'range:v')").collect()} == {"columns:id,s,v": True, "unique:id": False, "type:id": True, "in_set:s": True, "not_null:gone": False}
    assert sorted(r["success"] for r in res.where("expectation in ('not_null:s', 'range:v')").collect()) == [False, False, True, True]
    s = ex.summarise(res).first()
    assert (s["evaluated"], s["successful"], s["success"]) == (9, 5, False)
    with pytest.raises(ex.QualityError):
        ex.enforce(res, "gold")
    good = ex.run_suite(df.where("v = 5"), [ex.not_null("s")])
    assert ex.enforce(good, "bronze")["success"]
    assert ex.enforce(ex.run_suite(df.limit(0), [ex.not_null("s"), ex.unique("id")]), "bronze")["success"]


def _bronze(spark, **over):
    base = dict(id=1, title="t", original_title="t", overview="", release_date="2024-01-05", adult=False, popularity=1.0, vote_average=5.0, vote_count=3, poster_path=None, backdrop_path=None, original_language="en", genre_ids=[18], raw_data="{}", extraction_timestamp="2024-01-10T10:00:00Z", partition_year=2024, partition_month=1, partition_day=10, partition_hour=10)
    return [tuple((base | over)[f.name] for f in BRONZE["movies"].fields)]


def test_silver_movies(spark):
    data = _bronze(spark) + _bronze(spark, extraction_timestamp="2024-01-10T11:00:00Z", title=None) + _bronze(spark, id=2, release_date="", genre_ids=[]) + _bronze(spark, id=3, extraction_timestamp="2024-01-09T11:00:00Z")
    out = silver.silver_movies(spark.createDataFrame(data, BRONZE["movies"]), dt.datetime(2024, 1, 10, 12), 4)
    assert rows(out, "movie_id", "quality_flag", "partition_genre", "partition_month") == [(1, "WARNING", "Drama", 1), (2, "WARNING", "Unknown", 1)]
    pruned = silver.lookback(spark.createDataFrame(data, BRONZE["movies"]), "extraction_timestamp", dt.datetime(2024, 1, 10, 12), 4, partitioned=True)
    assert pruned.count() == 3


def test_trending_release_day_is_null(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 10), 5.0, 3), (2, "b", dt.date(2024, 1, 1), 9.0, 9), (3, "c", dt.date(2024, 1, 12), 1.0, 4)], "movie_id int, title string, release_date date, popularity double, vote_count int")
    out = {(r["movie_id"], r["window"]): (r["trend_score"], r["velocity"]) for r in gold.trending_scores(df, dt.date(2024, 1, 10)).collect()}
    assert out[1, "7d"][1] is None and out[3, "7d"] == (100.0, -2.0) and out[2, "30d"] == (0.0, 1.0) and (2, "7d") not in out


def test_year_over_year_uses_the_last_existing_year(spark):
    df = spark.createDataFrame([(2000, 2), (2003, 3)], "year int, n int")
    assert [r["yoy_change"] for r in rolling.year_over_year(df, "n").orderBy("year").collect()] == [None, 50.0]


def test_layers_roundtrip_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("Drama", 2024, 1, 5), ("War", 2023, 2, 6)], "genre string, partition_year int, partition_month int, n int")
    for _ in range(2):
        layers.write_layer(df, str(tmp_path), "gold", "genre_analytics")
    assert layers.read_layer(spark, str(tmp_path), "gold", "genre_analytics").count() == 2
    layers.write_layer(df.where("partition_year = 2024").withColumn("n", F.lit(9)), str(tmp_path), "gold", "genre_analytics")
    got = layers.read_layer(spark, str(tmp_path), "gold", "genre_analytics")
    assert rows(got, "genre", "n") == [("Drama", 9), ("War", 6)]
    assert layers.latest_partition(got, ["partition_year", "partition_month"]).first() == (2024, 1)
    p = got.select(layers.path_parts("_metadata.file_path").alias("p")).where("p.partitions['partition_year'] = '2024'").first()["p"]
    assert (p.layer, p.dataset, p.partitions["partition_month"]) == ("gold", "genre_analytics", "1")
    assert views.table_sizes(got).first()["rows"] == 2


def test_ingest_bronze(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, title string")
    b = spark.createDataFrame([(2, "z")], "id int, title string")
    layers.ingest_bronze([a, b], "id", dt.datetime(2024, 1, 2, 3), str(tmp_path), "movies")
    got = layers.read_layer(spark, str(tmp_path), "bronze", "movies")
    assert rows(got, "id", "title", "raw_data") == [(1, "x", '{"id":1,"title":"x"}'), (2, "z", '{"id":2,"title":"z"}')]


def test_upsert_is_last_writer_wins(spark, tmp_path):
    path = f"{tmp_path}/view"
    a = spark.createDataFrame([(1, 1, "a", "p"), (2, 1, "b", "q")], "id int, t int, x string, part string")
    views.upsert_by_key(path, a, ["id"], "t", ["part"])
    b = spark.createDataFrame([(1, 2, "c", "p"), (1, 3, "d", "p")], "id int, t int, x string, part string")
    for _ in range(2):
        views.upsert_by_key(path, b, ["id"], "t", ["part"])
    assert rows(spark.read.parquet(path), "id", "x") == [(1, "d"), (2, "b")]


def test_export_and_unknown_view(spark, tmp_path):
    good = spark.createDataFrame([(2000, 3, dt.datetime(2024, 1, 1), 2000, 1)], "year int, total_movies int, computed_at timestamp, partition_year int, partition_month int")
    assert views.export_batch_views({"temporal_analysis": good, "nope": good}, str(tmp_path))["temporal_analysis"] == "ok"
    with pytest.raises(ValueError):
        views.tag_batch_view(good, "nope")


def test_normalise_events(spark):
    raw = spark.createDataFrame([("1", "t", '["a"]', None), (None, "u", "oops", "yes"), ("x", None, None, "true")], "movie_id string, title string, genres string, adult string")
    good, bad = streams.normalise_events(raw, "metadata")
    r = good.collect()
    assert len(r) == 1 and r[0]["genres"] == ["a"] and r[0]["adult"] is False and r[0]["video"] is False
    assert sorted(tuple(x["errors"]) for x in bad.collect()) == [("movie_id: missing",), ("movie_id: not int", "title: missing")]


def test_search_rejects_bad_pages(spark):
    with pytest.raises(ValueError):
        serving.search(spark.range(1), limit=0)


def test_merge_prefers_speed(spark):
    cut = dt.datetime(2024, 1, 2)
    b = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "b"), (1, dt.datetime(2024, 1, 3), "b")], "id int, t timestamp, o string")
    s = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "s"), (1, dt.datetime(2024, 1, 2), "s")], "id int, t timestamp, o string")
    assert rows(serving.merge_views(b, s, cut, ["id", "t"], "t"), "t", "o") == [(dt.datetime(2024, 1, 1), "b"), (dt.datetime(2024, 1, 2), "s")]


def test_health_and_ttl(spark):
    t = spark.createDataFrame([("a", 48, 48, 10, 100), ("b", 48, 24, None, None), ("c", 48, 48, 1, 3 * 1024**3)], "table string, ttl_hours int, actual_ttl_hours int, rows long, bytes long")
    assert [(r["score"], r["healthy"]) for r in views.health_report(t).orderBy("table").collect()] == [(100, True), (20, False), (85, True)]
    assert [r[0] for r in t.select(views.suggested_ttl(F.col("ttl_hours"), F.col("bytes"), 1e9, 6)).where("bytes is not null").collect()][0] == 48.0
    assert views.ttl_registry(spark).count() >= 9


def test_budget_and_edges(spark):
    m = spark.createDataFrame([(["a"], 10.0, 20.0), (["a", "b"], 0.0, 5.0)], "genres array<string>, budget double, revenue double")
    assert rows(gold.budget_analysis(m), "genre", "movies", "return_ratio") == [("a", 1, 2.0)]
    c = spark.createDataFrame([(1, [(0, 3), (1, 5), (2, 3)]), (2, [(0, 5), (1, 3)])], "movie_id int, cast array<struct<order:int,person_id:long>>")
    assert rows(gold.collaboration_edges(c), "a", "b", "movies") == [(3, 5, 2)]


def test_edges_of_long_casts(spark):
    lists = {1: list(range(130)), 2: list(range(100, 170)), 3: [7, 7, 3], 4: [5]}
    c = spark.createDataFrame([(m, [(i, p) for i, p in enumerate(ps)]) for m, ps in lists.items()], "movie_id int, cast array<struct<order:int,person_id:long>>")
    want = {}
    for ps in lists.values():
        for a in set(ps):
            for b in set(ps):
                if a < b:
                    want[a, b] = want.get((a, b), 0) + 1
    got = [(r["a"], r["b"], r["movies"]) for r in gold.collaboration_edges(c).collect()]
    assert len(got) == len(want) and all(want[a, b] == n for a, b, n in got)


def test_upsert_follows_rows_that_change_their_partition(spark, tmp_path):
    path = f"{tmp_path}/moving"
    put = lambda rows: views.upsert_by_key(path, spark.createDataFrame(rows, "id int, t int, part string"), ["id"], "t", ["part"])
    put([(1, 1, "p"), (2, 1, "q"), (3, 1, "q")])
    put([(1, 2, "q")])
    assert sorted((r["id"], r["t"], r["part"]) for r in spark.read.parquet(path).collect()) == [(1, 2, "q"), (2, 1, "q"), (3, 1, "q")]


def test_replacement_that_ended_half_way_is_recovered(spark, tmp_path):
    path = f"{tmp_path}/view"
    df = spark.createDataFrame([(1, 1)], "id int, t int")
    assert views.upsert_by_key(path, df, ["id"], "t") == 1
    (tmp_path / "view").rename(tmp_path / "view__old")
    assert views.upsert_by_key(path, spark.createDataFrame([(2, 1)], "id int, t int"), ["id"], "t") == 2
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2] and not (tmp_path / "view__old").exists()


def test_expired_partitions_are_removed(spark, tmp_path):
    import datetime as dt

    from lakemill.sources import layers

    df = spark.createDataFrame([(1, 2020, 1), (2, 2024, 1)], "id int, partition_year int, partition_month int")
    layers.write_layer(df, str(tmp_path), "silver", "reviews")
    assert [layers.drop_expired(spark, str(tmp_path), "silver", "reviews", dt.date(2024, 2, 1)) for _ in range(2)] == [1, 0]
    assert [r["id"] for r in spark.read.parquet(f"{tmp_path}/silver/reviews").collect()] == [2]


def test_stated_word_lists_and_lifetimes():
    from lakemill.functions import sentiment
    from lakemill.schemas import TTL_HOURS

    assert {"superb", "fail", "failed", "trash"} <= {*sentiment.POSITIVE, *sentiment.NEGATIVE} and len(sentiment.POSITIVE) == len(sentiment.NEGATIVE) == 17
    assert not {"enjoyed", "mediocre", "ugly", "worse"} & {*sentiment.POSITIVE, *sentiment.NEGATIVE}
    assert len(TTL_HOURS) == 12 and TTL_HOURS["recent_sentiments"] == 6
