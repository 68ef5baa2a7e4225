"""Bucketed tables, pages by key, quality results that merge, registered schemas and layouts that a purge keeps."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from lakemill.operators import expectations as ex
from lakemill.plans import fixtures as fx
from lakemill.plans import gold, serving
from lakemill.schemas import STREAMS
from lakemill.sources import layers, streams, views


def below_joins(plan: str) -> str:
    """The lines of a formatted tree from its first join on."""
    lines = plan.split("\n\n")[0].splitlines()
    at = next(i for i, line in enumerate(lines) if "Join" in line)
    return "\n".join(lines[at:])


def test_bucketed_tables_join_and_group_without_an_exchange(spark, sf, tmp_path):
    n = f"b{uuid.uuid4().hex}"
    movies = layers.write_bucketed(fx.movies(spark, sf), f"{n}m", f"{tmp_path}/m", "movie_id", 4)
    reviews = layers.write_bucketed(fx.reviews(spark, sf).select("movie_id", F.length("content").cast("double").alias("sentiment_score")), f"{n}r", f"{tmp_path}/r", "movie_id", 4, compact=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = gold.genre_analytics(movies, reviews, dt.datetime(2024, 1, 1))
        tree = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in below_joins(tree) and "SortMergeJoin" in tree
        plain = gold.genre_analytics(fx.movies(spark, sf), spark.table(f"{n}r").repartition(3), dt.datetime(2024, 1, 1))
        assert "Exchange" in below_joins(plain._jdf.queryExecution().executedPlan().toString())
        key = lambda d: sorted((r["genre"], str(r["year"]), r["month"], r["total_movies"], round(r["avg_sentiment"] or 0, 6)) for r in d.collect())
        assert key(df) == key(plain) and len(key(df)) > 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("m", "r"):
            spark.sql(f"drop table {n}{t}")


def test_pages_by_key_equal_pages_by_offset(spark):
    rows = [(i, f"film {i}", None if i % 9 == 0 else float(i * 7 % 5), float(i % 4), dt.date(2000 + i % 3, 1, 1), ["a"] if i % 2 else ["b"]) for i in range(120)]
    df = spark.createDataFrame(rows, "movie_id int, title string, popularity double, vote_average double, release_date date, genres array<string>").repartition(4)
    for sort_by, col in serving.SORT_COLUMNS.items():
        after, got = None, []
        while page := serving.search_after(df, after, sort_by, 7, genre="a").collect():
            assert {r["total"] for r in page} == {60}
            got += [r["movie_id"] for r in page]
            after = (page[-1][col], page[-1]["movie_id"])
        want = [r["movie_id"] for r in df.where(F.array_contains("genres", "a")).orderBy(F.desc(col), "movie_id").collect()]
        assert got == want
        assert [r["movie_id"] for r in serving.search(df, None, "a", sort_by=sort_by, limit=7, offset=14).collect()] == want[14:21]
    assert serving.search_after(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        serving.search_after(df, limit=101)


SUITE = [ex.not_null("s"), ex.not_null("s", 0.5), ex.between("v", 0, 10), ex.between("v", 0, None, 0.9), ex.in_set("s", "a", "b"), ex.unique("id"), ex.has_type("id", "int")]


def test_results_of_partitions_merge_to_those_of_the_whole(spark):
    rows = [(i, "abc"[i % 3] if i % 7 else None, float(i % 12) if i % 5 else None, i % 4 if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, s string, v double, day int")
    parts = [ex.partial_results(df.where(c), SUITE, ["day"]) for c in ("day < 2", "day >= 2", "day is null")]
    merged = {r["rule"]: r for r in ex.merged_results(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()}
    # a list, as two expectations may have one name
    whole = [(r["expectation"], round(r["observed"], 9), r["success"]) for r in ex.run_suite(df, [e for e in SUITE if e.kind not in ("unique", "type")]).collect()]
    assert [(merged[i]["expectation"], round(merged[i]["observed"], 9), merged[i]["success"]) for i in range(5)] == whole
    assert merged[5]["success"] and merged[5]["observed"] <= merged[5]["error"] < 15 and 0 == merged[0]["error"]
    # a partition that holds another's ids is seen when they merge, though each is unique in itself
    twice = parts[0].unionByName(ex.partial_results(df.where("day < 2").withColumn("day", F.lit(9)), SUITE, ["day"]))
    bad = next(r for r in ex.merged_results(twice).collect() if r["rule"] == 5)
    n = df.where("day < 2").count()
    assert not bad["success"] and abs(bad["observed"] - n) <= bad["error"]
    assert ex.merged_results(ex.partial_results(df.limit(0), SUITE, ["day"])).collect() == []


def framed(spark, *messages):
    return spark.createDataFrame([(bytearray(m),) for m in messages], "value binary")


def test_messages_are_read_by_the_schema_they_name(spark):
    head = lambda n: b"\x00" + n.to_bytes(4, "big")
    schema = type(STREAMS["ratings"])
    writers = {1: schema.fromDDL("movie_id int, vote_count int"), 300: schema.fromDDL("movie_id long, vote_average double, extra string")}
    df = framed(spark, head(1) + b'{"movie_id":5,"vote_count":3}', head(300) + b'{"movie_id":6,"vote_average":7.5,"extra":"x"}', head(2) + b"{}", b"\x01abcdefg", b"", b"ab")
    good, bad = streams.decode_registered(df, "ratings", writers, "json")
    assert sorted((r["movie_id"], r["vote_count"], r["vote_average"], r["schema_id"]) for r in good.collect()) == [(5, 3, None, 1), (6, None, 7.5, 300)]
    assert good.columns == [*STREAMS["ratings"].names, "kafka_timestamp", "schema_id"]
    assert sorted(str(r["schema_id"]) for r in bad.collect()) == ["2", "None", "None", "None"] and "value" in bad.columns


def test_avro_messages_of_several_writers(spark):
    from pyspark.errors import AnalysisException
    from pyspark.sql.avro.functions import to_avro

    old = type(STREAMS["ratings"]).fromDDL("movie_id int, vote_count int")
    body = to_avro(F.struct(F.lit(5).alias("movie_id"), F.lit(3).alias("vote_count")), streams.avro_schema(old, "ratings"))
    try:
        df = spark.range(1).select(F.concat(F.unhex(F.lit("0000000001")), body).alias("value"))
    except AnalysisException as e:
        if "AVRO_NOT_LOADED" not in str(e):
            raise
        pytest.skip("the spark-avro package is not loaded in this session")
    good, _ = streams.decode_registered(df, "ratings", {1: old})
    assert [(r["movie_id"], r["vote_count"], r["vote_average"]) for r in good.collect()] == [(5, 3, None)]


def test_a_purge_keeps_the_folders_of_a_plain_table(spark, tmp_path):
    path, t0 = f"{tmp_path}/plain", dt.datetime(2024, 1, 10)
    rows = spark.createDataFrame([(1, t0, "a", 1), (2, t0 - dt.timedelta(days=9), "a", 2), (3, t0, "b", 1)], "id int, at timestamp, p string, q int")
    views.upsert_by_key(path, rows, ["id", "p", "q"], "at", ["p", "q"])
    assert views.purge(spark, path, "at", 48, t0) == {"kept": 2, "deleted": 1}
    assert views.folder_columns(spark.read.parquet(path), path) == ["p", "q"] and (tmp_path / "plain" / "p=a" / "q=1").exists()
    views.upsert_by_key(path, rows.where("id = 3").withColumn("at", F.lit(t0 + dt.timedelta(days=1))), ["id", "p", "q"], "at", ["p", "q"])
    assert sorted((r["id"], r["p"], r["q"]) for r in spark.read.parquet(path).collect()) == [(1, "a", 1), (3, "b", 1)]


def test_reviews_are_normalised(spark):
    raw = spark.createDataFrame([("r1", "5", "good", "7.5", "1700000000000"), ("r2", "x", "good", None, None), (None, "6", None, None, "soon")], "review_id string, movie_id string, content string, rating string, created_at string")
    good, bad = streams.normalise_events(raw, "reviews")
    assert [(r["review_id"], r["movie_id"], r["content"], r["rating"], r["created_at"], r["author"]) for r in good.collect()] == [("r1", 5, "good", 7.5, 1700000000000, None)]
    assert sorted(tuple(sorted(r["errors"])) for r in bad.collect()) == [("content: missing", "created_at: not bigint", "review_id: missing"), ("movie_id: not int",)]
