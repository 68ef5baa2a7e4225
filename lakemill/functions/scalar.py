"""Scalar column functions: safe dates, genres, weighted scores, throughput and latency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: genre ids of the public catalogue
GENRES = {
    28: "Action",
    12: "Adventure",
    16: "Animation",
    35: "Comedy",
    80: "Crime",
    99: "Documentary",
    18: "Drama",
    10751: "Family",
    14: "Fantasy",
    36: "History",
    27: "Horror",
    10402: "Music",
    9648: "Mystery",
    10749: "Romance",
    878: "Science Fiction",
    10770: "TV Movie",
    53: "Thriller",
    10752: "War",
    37: "Western",
}


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_date(x: Column | str) -> Column:
    """The date of a string, null where it is none (an empty string would raise under ANSI)."""
    return c(x).try_cast("date")


def safe_timestamp(x: Column | str) -> Column:
    return c(x).try_cast("timestamp")


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds as a timestamp of whole seconds, cut towards 1970."""
    return F.timestamp_seconds((c(ms) / 1000).cast("long"))


def map_genres(ids: Column | str, names: dict[int, str] | None = None, default: str = "Unknown") -> Column:
    """Genre names of an array of ids; unknown ids get the default, a null array becomes empty."""
    table = F.create_map(*[x for k, v in (names or GENRES).items() for x in (F.lit(k).cast("long"), F.lit(v))])
    return F.coalesce(F.transform(c(ids), lambda i: F.coalesce(F.try_element_at(table, i.cast("long")), F.lit(default))), F.array().cast("array<string>"))


def first_or(x: Column | str, default: str = "Unknown") -> Column:
    """The first element of an array, or the default if there is none."""
    return F.coalesce(F.get(c(x), 0), F.lit(default))


def quality_flag(*required: Column | str) -> Column:
    """WARNING if any of the columns is null, else OK."""
    return F.when(reduce(lambda a, b: a | b, [c(x).isNull() for x in required]), "WARNING").otherwise("OK")


def partition_year_month(d: Column | str, fallback: Column | str) -> tuple[Column, Column]:
    """Year and month of d, or of the fallback where d is null."""
    return F.coalesce(F.year(c(d)), F.year(c(fallback))), F.coalesce(F.month(c(d)), F.month(c(fallback)))


def weighted(*parts: tuple[float, Column | str]) -> Column:
    """Sum of weight * coalesce(column, 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(c(x).cast("double"), F.lit(0.0)) * w for w, x in parts])


def stable_mean(x: Column | str) -> Column:
    """avg of doubles that is the same whatever order rows arrive and partial sums merge in, so that equal groups tie.

    The multiple of 2^-20 nearest to each value adds up without rounding (sums below 2^33), and the rests are so small
    that the rounding of their sum is lost in that of the total. Larger values add up as they come.
    """
    v = c(x).cast("double")
    near = F.rint(v * 1048576.0) / 1048576.0
    small = F.abs(v) < 8589934592.0
    total = F.sum(F.when(small, near).otherwise(v)) + F.sum(F.when(v.isNotNull(), F.when(small, v - near).otherwise(0.0)))
    return F.try_divide(total, F.count(v))


def ratio(a: Column | str, b: Column | str, when: Column | None = None, default: float = 0.0) -> Column:
    """a / b where b (and the condition) allows, else the default."""
    q = F.try_divide(c(a).cast("double"), c(b).cast("double"))
    return F.coalesce(q if when is None else F.when(when, q), F.lit(default))


def trend_score(velocity: Column | str, acceleration: Column | str, volume: Column | str) -> Column:
    return weighted((0.4, velocity), (0.3, acceleration), (0.3, F.try_divide(c(volume).cast("double"), F.lit(100.0))))


def sentiment_band(x: Column | str, edge: float = 0.05) -> Column:
    """positive from edge on, negative from -edge on, else neutral."""
    return F.when(c(x) >= edge, "positive").when(c(x) <= -edge, "negative").otherwise("neutral")


def time_features(df: DataFrame, ts: str) -> DataFrame:
    """df with hour_of_day, day_of_week, day_of_year and week_of_year of ts."""
    return df.withColumns({"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts), "day_of_year": F.dayofyear(ts), "week_of_year": F.weekofyear(ts)})


def throughput(df: DataFrame, start: str, end: str, count_col: str) -> DataFrame:
    """df with window_seconds and records_per_second."""
    secs = F.unix_timestamp(end) - F.unix_timestamp(start)
    return df.withColumns({"window_seconds": secs, "records_per_second": F.try_divide(F.col(count_col).cast("double"), secs.cast("double"))})


def latency(df: DataFrame, event_ts: str, proc_ts: str) -> DataFrame:
    """df with latency_seconds and latency_minutes of processing against event time."""
    secs = F.unix_timestamp(proc_ts) - F.unix_timestamp(event_ts)
    return df.withColumns({"latency_seconds": secs, "latency_minutes": secs / 60.0})
