"""Window analytics over ordered groups: velocity, acceleration, moving averages, rolling z-scores, year over year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def velocity(df: DataFrame, metric: str, keys: list[str], order: list[str]) -> DataFrame:
    """df with prev_m, m_velocity = (m - prev) / (prev + 1) and m_acceleration, the change of velocity.

    0 without a row before; 0 where prev is -1.
    """
    w, prev, vel = _w(keys, order), f"prev_{metric}", f"{metric}_velocity"
    df = df.withColumn(prev, F.lag(metric).over(w))
    df = df.withColumn(vel, F.coalesce(F.try_divide((F.col(metric) - F.col(prev)).cast("double"), (F.col(prev) + 1).cast("double")), F.lit(0.0)))
    df = df.withColumn(f"prev_{vel}", F.lag(vel).over(w))
    return df.withColumn(f"{metric}_acceleration", F.coalesce(F.col(vel) - F.col(f"prev_{vel}"), F.lit(0.0)))


def per_second_velocity(df: DataFrame, metric: str, keys: list[str], ts: str, out: str = "velocity") -> DataFrame:
    """Change of metric per second since the row before; null for the first row and for no time passed."""
    w = _w(keys, [ts])
    secs = (F.unix_micros(F.col(ts)) - F.unix_micros(F.lag(ts).over(w))) / F.lit(1e6)
    return df.withColumn(out, F.try_divide(F.col(metric) - F.lag(metric).over(w), secs))


def moving_averages(df: DataFrame, metric: str, keys: list[str], order: list[str], sizes: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    """df with m_ma_n, the mean of the last n rows, for each n."""
    return df.withColumns({f"{metric}_ma_{n}": F.avg(metric).over(_w(keys, order).rowsBetween(-(n - 1), 0)) for n in sizes})


def zscore_anomalies(df: DataFrame, metric: str, keys: list[str], order: list[str], threshold: float = 2.0, size: int = 10) -> DataFrame:
    """df with m_zscore against the last `size` rows (this one included) and is_anomaly, |z| > threshold.

    z is 0 where the deviation is null or 0. |z| cannot exceed (n - 1) / sqrt(n) in a frame of n rows.
    """
    w = _w(keys, order).rowsBetween(-(size - 1), 0)
    sd = F.stddev_samp(metric).over(w)
    z = F.when(sd > 0, (F.col(metric) - F.avg(metric).over(w)) / sd).otherwise(0.0)
    df = df.withColumn(f"{metric}_zscore", z)
    return df.withColumn("is_anomaly", F.abs(f"{metric}_zscore") > threshold)


def year_over_year(df: DataFrame, metric: str, year: str = "year", keys: list[str] = (), out: str = "yoy_change") -> DataFrame:
    """Percentage change against the last existing year. df holds one row a year (and key), so the window is small."""
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(year)
    prev = F.lag(metric).over(w)
    return df.withColumn(out, F.try_divide((F.col(metric) - prev).cast("double"), prev.cast("double")) * 100)


def numeric_aggs(cols: list[str]) -> list[Column]:
    """count, avg, min, max, sum and stddev of each column, named column_function."""
    fns = {"count": F.count, "avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "stddev": F.stddev_samp}
    return [f(x).alias(f"{x}_{n}") for x in cols for n, f in fns.items()]


def bin_indicators(df: DataFrame, col: str, bins: list[tuple[float, float]]) -> DataFrame:
    """df with a 0/1 column for each half-open bin [lo, hi)."""
    return df.withColumns({bin_name(col, b): F.when((F.col(col) >= b[0]) & (F.col(col) < b[1]), 1).otherwise(0) for b in bins})


def bin_name(col: str, b: tuple[float, float]) -> str:
    return f"{col}_bin_{b[0]:g}_{b[1]:g}".replace(".", "p").replace("-", "m")


def histogram_counts(df: DataFrame, col: str, bins: list[tuple[float, float]], keys: list[str] = ()) -> DataFrame:
    """Rows in each half-open bin, per key."""
    aggs = [F.count_if((F.col(col) >= b[0]) & (F.col(col) < b[1])).alias(bin_name(col, b)) for b in bins]
    return df.groupBy(*keys).agg(*aggs)


def movie_velocity(df: DataFrame, metric: str, order: list[str] = ("window_start",)) -> DataFrame:
    """Preset: velocity by movie_id."""
    return velocity(df, metric, ["movie_id"], list(order))


def movie_anomalies(df: DataFrame, metric: str, order: list[str] = ("window_start",)) -> DataFrame:
    """Preset: anomalies by movie_id with threshold 2.5 over ten rows."""
    return zscore_anomalies(df, metric, ["movie_id"], list(order), 2.5, 10)
