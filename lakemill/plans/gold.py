"""Gold layer: genre analytics, trending scores, temporal analysis and the optional analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.operators.rank import global_percent_rank
from lakemill.operators.rolling import year_over_year


def movie_sentiment(reviews: DataFrame, score: str = "sentiment_score") -> DataFrame:
    """movie_id, avg_sentiment."""
    return reviews.groupBy("movie_id").agg(F.avg(score).alias("avg_sentiment"))


def genre_analytics(movies: DataFrame, reviews: DataFrame | None = None, as_of: dt.datetime | None = None) -> DataFrame:
    """Per genre, year and month: counts, rating, votes, popularity; with reviews also the mean of movie sentiments.

    Sentiment is joined per movie before the explosion, so that one aggregation over the genres gives everything.
    """
    df = movies
    aggs = [F.count("*").alias("total_movies"), F.avg("vote_average").alias("avg_rating"), F.sum("vote_count").alias("total_votes"), F.avg("popularity").alias("avg_popularity"), F.max("vote_average").alias("max_rating"), F.min("vote_average").alias("min_rating")]
    if reviews is not None:
        df = df.join(movie_sentiment(reviews), "movie_id", "left")
        aggs.append(F.avg("avg_sentiment").alias("avg_sentiment"))
    df = df.select("*", F.explode("genres").alias("genre")).groupBy("genre", F.year("release_date").alias("year"), F.month("release_date").alias("month")).agg(*aggs)
    return _stamped(df, as_of, F.col("year"), F.col("month"))


def trending_scores(movies: DataFrame, as_of: dt.date, windows: tuple[int, ...] = (7, 30, 90), higher_is_better: bool = False, stamp: dt.datetime | None = None) -> DataFrame:
    """Per release window: percent rank of popularity * 100 (0 for the most popular unless higher_is_better) and vote velocity.

    One scan: each movie is exploded into the windows that hold it. Velocity is null on the release day.
    """
    age = F.datediff(F.lit(as_of), "release_date")
    velocity = F.try_divide(F.col("vote_count").cast("double"), age.cast("double"))
    tags = F.filter(F.array(*[F.when(F.col("release_date") >= F.date_sub(F.lit(as_of), d), F.lit(f"{d}d")) for d in windows]), lambda x: x.isNotNull())
    df = movies.withColumn("velocity", velocity).withColumn("window", F.explode(tags))
    df = global_percent_rank(df, "popularity", ["window"], ascending=higher_is_better, out="_rank")
    df = df.select("movie_id", "title", "window", (F.col("_rank") * 100).alias("trend_score"), "velocity", "popularity")
    return _stamped(df, stamp, F.lit(as_of.year), F.lit(as_of.month))


def temporal_analysis(movies: DataFrame, stamp: dt.datetime | None = None) -> DataFrame:
    """Per release year: counts, means and the change of total_movies against the year before it in the data."""
    df = movies.groupBy(F.year("release_date").alias("year")).agg(F.count("*").alias("total_movies"), F.avg("vote_average").alias("avg_rating"), F.avg("popularity").alias("avg_popularity"), F.sum("vote_count").alias("total_votes"))
    df = year_over_year(df, "total_movies")
    return _stamped(df, stamp, F.col("year"), F.lit(1))


def _stamped(df: DataFrame, as_of, year, month) -> DataFrame:
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumns({"computed_at": stamp, "partition_year": year.cast("int"), "partition_month": month.cast("int")})


# ---- analyses that the data allows but nobody had written yet -------------------------------------------------------


def seasonal_pattern(movies: DataFrame) -> DataFrame:
    """Per calendar month over all years: counts and means."""
    return movies.groupBy(F.month("release_date").alias("month")).agg(F.count("*").alias("total_movies"), F.avg("popularity").alias("avg_popularity"), F.avg("vote_average").alias("avg_rating"))


def sentiment_by_tier(movies: DataFrame, reviews: DataFrame, cuts: tuple[float, float] = (100.0, 300.0)) -> DataFrame:
    """Mean sentiment per genre, year and popularity tier (low, mid, high)."""
    tier = F.when(F.col("popularity") < cuts[0], "low").when(F.col("popularity") < cuts[1], "mid").otherwise("high")
    df = movies.join(movie_sentiment(reviews), "movie_id").select(F.explode("genres").alias("genre"), F.year("release_date").alias("year"), tier.alias("tier"), "avg_sentiment")
    return df.groupBy("genre", "year", "tier").agg(F.avg("avg_sentiment").alias("avg_sentiment"), F.count("*").alias("movies"))


def budget_analysis(movies: DataFrame) -> DataFrame:
    """Per genre: sums of budget and revenue and their ratio; rows without a budget do not count."""
    df = movies.where(F.col("budget") > 0).select(F.explode("genres").alias("genre"), "budget", "revenue")
    df = df.groupBy("genre").agg(F.count("*").alias("movies"), F.sum("budget").alias("budget"), F.sum("revenue").alias("revenue"))
    return df.withColumn("return_ratio", F.try_divide(F.col("revenue").cast("double"), F.col("budget").cast("double")))


def similar_movies(movies: DataFrame, targets: DataFrame, k: int = 5) -> DataFrame:
    """For each movie_id of targets the k movies with the largest Jaccard overlap of features, then popularity.

    features is an array of strings. Feature sets are compared as sets: movies with equal sets meet once, as one set,
    so a feature shared by many movies costs its distinct sets and not its movies. Of equal sets the targets have one
    list, of which each leaves out itself, so rows are ranked once a set and not once a target. movie_id is a key of movies.
    """
    sets = movies.select("movie_id", "popularity", F.array_sort(F.array_distinct("features")).alias("fs"))
    want = targets.select("movie_id").join(sets, "movie_id").select(F.col("movie_id").alias("target"), "fs")
    kinds = sets.select("fs").distinct().select("fs", F.explode("fs").alias("f"))
    near = want.select("fs").distinct().select(F.col("fs").alias("ts"), F.explode("fs").alias("f")).join(kinds, "f").groupBy("ts", "fs").agg(F.count("*").alias("n"))
    near = near.select("ts", "fs", (F.col("n") / (F.size("ts") + F.size("fs") - F.col("n"))).alias("similarity"))
    # of each set only its k + 1 most popular movies can be among a target's k, and of all these only the first k + 1
    best = sets.where("movie_id is not null").withColumn("r", F.row_number().over(Window.partitionBy("fs").orderBy(F.desc("popularity"), "movie_id"))).where(F.col("r") <= k + 1)
    w = Window.partitionBy("ts").orderBy(F.desc("similarity"), F.desc("popularity"), "movie_id")
    first = near.join(best, "fs").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    lists = first.groupBy("ts").agg(F.array_sort(F.collect_list(F.struct("r", "movie_id", "similarity", "popularity"))).alias("list"))
    own = F.slice(F.filter("list", lambda x: x["movie_id"] != F.col("target")), 1, k)
    out = want.withColumnRenamed("fs", "ts").join(lists, "ts").select("target", F.posexplode(own).alias("i", "m"))
    return out.select("target", (F.col("i") + 1).alias("rank"), "m.movie_id", "m.similarity", "m.popularity")


def demand_forecast(points: DataFrame, key: str, x: str, y: str, ahead: float) -> DataFrame:
    """Linear trend per key, extrapolated `ahead` beyond the last x: slope, intercept, forecast (null for one point)."""
    df = points.groupBy(key).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.max(x).alias("last_x"))
    return df.withColumn("forecast", F.col("intercept") + F.col("slope") * (F.col("last_x") + ahead))


def collaboration_edges(credits: DataFrame, block: int = 50, rows: int = 1_000_000) -> DataFrame:
    """a, b, movies: how many movies two people share.

    The distinct people of a movie are numbered in rising order as rows and gathered by block, so no row holds more than
    `block` people. The pairs of a block are made from its own array, and each pair of a movie's blocks meets in a row
    of its own, which gives at most block^2 pairs whatever the list's length. The pairs are counted first: both the
    movies and the pairs are dealt to tasks of about `rows` pairs each, so tasks grow in number and not in size.
    """
    known, size = credits.where("movie_id is not null"), F.size("cast").cast("double")
    total = known.agg(F.sum(F.when(size > 1, size * (size - 1) / 2)).alias("n")).first()["n"] or 0
    tasks = int(min(max(total // rows, credits.sparkSession.sparkContext.defaultParallelism), 20_000))
    person = F.explode(F.transform("cast", lambda x: x["person_id"])).alias("person")
    people = known.select("movie_id", person).where("person is not null").repartition(tasks, "movie_id").distinct()
    w = Window.partitionBy("movie_id").orderBy("person")
    at = F.floor((F.row_number().over(w) - 1) / block).cast("int")
    blocks = people.withColumn("at", at).groupBy("movie_id", "at").agg(F.array_sort(F.collect_list("person")).alias("ids"))
    # each block with itself: in sorted order a is before b
    own = F.flatten(F.transform("ids", lambda a, i: F.transform(F.slice("ids", i + 2, block), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    inner = blocks.where(F.size("ids") > 1).select(F.explode(own).alias("p"))
    # and with each earlier block of the list
    one = blocks.where("at > 0").select("movie_id", F.col("ids").alias("ys"), F.explode(F.sequence(F.lit(0), F.col("at") - 1)).alias("at"))
    both = one.join(blocks.where(F.size("ids") == block).select("movie_id", "at", F.col("ids").alias("xs")), ["movie_id", "at"])
    cross = F.flatten(F.transform("xs", lambda a: F.transform("ys", lambda b: F.struct(a.alias("a"), b.alias("b")))))
    pairs = inner.unionByName(both.select(F.explode(cross).alias("p"))).select("p.a", "p.b")
    return pairs.repartition(tasks, "a", "b").groupBy("a", "b").agg(F.count("*").alias("movies"))
