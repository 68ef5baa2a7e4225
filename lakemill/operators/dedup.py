"""Keep-latest dedup, as a window or as an aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; add enough order columns to leave no tie."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_by(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str] = ()) -> DataFrame:
    """As keep_latest by ts descending, as one aggregation with map-side combine: a hot key is one row a task."""
    rest = [x for x in df.columns if x not in keys]
    top = F.max_by(F.struct(*rest), F.struct(ts, *tiebreak)).alias("_r")
    return df.groupBy(*keys).agg(top).select(*keys, "_r.*").select(*df.columns)


def union_latest(frames: list[DataFrame], key: str) -> DataFrame:
    """All frames together, of each key the row of the last frame that has it."""
    tagged = [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)]
    out = tagged[0]
    for f in tagged[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return latest_by(out, [key], "_src").drop("_src")
