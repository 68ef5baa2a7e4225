"""Ranks: percent rank at scale, top-k per group, numbered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percentile_rank(df: DataFrame, metric: str, keys: list[str] = (), order: Column | None = None, out: str | None = None) -> DataFrame:
    """percent_rank of metric within keys; without keys it is global_percent_rank, which needs no single task."""
    out = out or f"{metric}_percentile"
    if not keys:
        return global_percent_rank(df, metric, out=out)
    return df.withColumn(out, F.percent_rank().over(Window.partitionBy(*keys).orderBy(order if order is not None else F.col(metric))))


def global_percent_rank(df: DataFrame, metric: str, keys: list[str] = (), ascending: bool = True, out: str = "percent_rank", ranges: int = 256) -> DataFrame:
    """percent_rank of metric over all rows (or over the few large groups of keys), ties sharing a rank, nulls first.

    Rows shrink to distinct values with counts; approximate quantiles cut the values into ranges, counts are summed
    within a range, and only the ranges' totals meet in one place. Ranks are joined back by value. A value's range
    depends on the value alone, so a task that is run again gives the same.
    """
    keys = list(keys)
    counts = df.groupBy(*keys, metric).agg(F.count("*").alias("_n")).withColumn("_v", F.col(metric) if ascending else -F.col(metric))
    # the number of cuts below a value, by every step-th cut first and then by the step cuts behind those
    step = max(2, round(ranges**0.5))
    cuts = counts.agg(F.percentile_approx("_v", [i / ranges for i in range(1, ranges)]).alias("all"))
    cuts = cuts.select(F.struct("all", F.filter("all", lambda x, i: (i + 1) % step == 0).alias("coarse"))).scalar()
    below = lambda xs: F.size(F.filter(F.coalesce(xs, F.array()), lambda x: x < F.col("_v")))
    dealt = counts.withColumn("_cuts", cuts).withColumn("_p", below(F.col("_cuts.coarse")) * step)
    dealt = dealt.withColumn("_p", F.col("_p") + below(F.slice("_cuts.all", F.col("_p") + 1, step))).drop("_cuts")
    within = Window.partitionBy(*keys, "_p").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    part = dealt.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    totals = dealt.groupBy(*keys, "_p").agg(F.sum("_n").alias("_t"))
    every = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = every.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_start", F.coalesce(F.sum("_t").over(before), F.lit(0))).withColumn("_all", F.sum("_t").over(every)).drop("_t")
    rank = (F.col("_start") + F.col("_before")).cast("double")
    ranks = part.join(totals, [*keys, "_p"]).select(*keys, F.col(metric).alias("_m"), F.when(F.col("_all") > 1, rank / (F.col("_all") - 1)).otherwise(0.0).alias(out))
    on = F.col(f"l.{metric}").eqNullSafe(F.col("r._m"))
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return df.alias("l").join(ranks.alias("r"), on).select("l.*", f"r.{out}")


def top_k(df: DataFrame, keys: list[str], metric: str, k: int = 10, ties: str = "rank", tiebreak: list[Column] = (), out: str = "rank") -> DataFrame:
    """The k largest of each group. ties='rank' keeps all rows that tie at k; 'row_number' keeps exactly k."""
    w = Window.partitionBy(*keys).orderBy(F.col(metric).desc(), *tiebreak)
    f = F.rank() if ties == "rank" else F.row_number()
    return df.withColumn(out, f.over(w)).where(F.col(out) <= k)


def numbered(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """row_number within keys."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
