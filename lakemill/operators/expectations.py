"""Declarative data-quality suites, evaluated in one aggregation (and one more for uniqueness)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """A suite failed its severity policy."""


@dataclass(frozen=True)
class Expectation:
    """kind is columns, not_null, type, unique, range or in_set."""

    kind: str
    column: str = ""
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    type: str = ""
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column or ','.join(self.columns)}"


def columns_are(*names: str) -> Expectation:
    return Expectation("columns", columns=names)


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", column, mostly=mostly)


def has_type(column: str, type_: str) -> Expectation:
    return Expectation("type", column, type=type_)


def unique(*names: str) -> Expectation:
    return Expectation("unique", columns=names)


def between(column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0) -> Expectation:
    return Expectation("range", column, low=low, high=high, mostly=mostly)


def in_set(column: str, *values, mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", column, values=values, mostly=mostly)


def run_suite(df: DataFrame, suite: list[Expectation], name: str = "suite", batch: str = "") -> DataFrame:
    """One row an expectation: suite, batch, expectation, observed (share of rows that hold, or duplicates), success.

    Empty tables hold every share. Nulls are left out of range and set checks. A missing column fails.
    """
    spark = df.sparkSession
    shares, fixed, uniques = {}, [], []
    for i, e in enumerate(suite):
        if e.kind == "columns":
            ok = tuple(df.columns) == e.columns
            fixed.append((i, e.name, float(ok), ok))
        elif e.column and e.column not in df.columns or any(x not in df.columns for x in e.columns):
            fixed.append((i, e.name, 0.0, False))
        elif e.kind == "type":
            ok = df.schema[e.column].dataType.simpleString() == e.type
            fixed.append((i, e.name, float(ok), ok))
        elif e.kind == "unique":
            uniques.append((i, e))
        else:
            shares[f"e{i}"] = (i, e, F.avg(_holds(e).cast("double")))
    parts = []
    if shares:
        one = df.agg(*[F.coalesce(f, F.lit(1.0)).alias(k) for k, (_, _, f) in shares.items()])
        rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(e.name).alias("expectation"), F.col(k).alias("observed"), (F.col(k) >= e.mostly).alias("success")) for k, (i, e, _) in shares.items()])
        parts.append(one.select(F.explode(rows).alias("r")).select("r.*"))
    for i, e in uniques:
        dup = df.groupBy(*e.columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("double").alias("observed"))
        parts.append(dup.select(F.lit(i).alias("i"), F.lit(e.name).alias("expectation"), "observed", (F.col("observed") == 0).alias("success")))
    if fixed:
        parts.append(spark.createDataFrame(fixed, "i int, expectation string, observed double, success boolean"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(name).alias("suite"), F.lit(batch).alias("batch"), "expectation", "observed", "success")


def _holds(e: Expectation) -> Column:
    """Whether a row holds e; null where it is left out."""
    x = F.col(e.column)
    if e.kind == "not_null":
        return x.isNotNull()
    if e.kind == "in_set":
        return x.isin(*e.values)
    hold = (F.lit(True) if e.low is None else x >= e.low) & (F.lit(True) if e.high is None else x <= e.high)
    return F.when(x.isNotNull(), hold)


#: registers of the distinct sketches are 2**SKETCH_K; their relative standard error is about 1.04 / sqrt(2**SKETCH_K)
SKETCH_K = 14


def partial_results(df: DataFrame, suite: list[Expectation], partition_by: list[str], name: str = "suite") -> DataFrame:
    """suite, part, rule, expectation, mostly, rows, held, sketch: what each partition of df adds to a suite, one pass over df.

    Results of partitions merge (merged_results), so that a new partition is checked without reading the old ones. rows
    counts the rows that an expectation looks at; a unique expectation has a sketch of its keys instead of held. Column
    and type expectations have nothing to add up: check them where the table is written.
    """
    rules = [e for e in suite if e.kind not in ("columns", "type")]
    aggs = []
    for i, e in enumerate(rules):
        if e.kind == "unique":
            held, n = F.lit(None).cast("long"), F.count(F.lit(1))
            sketch = F.hll_sketch_agg(F.xxhash64(*e.columns), F.lit(SKETCH_K))
        else:
            held, n, sketch = F.count_if(_holds(e)), F.count(_holds(e)), F.lit(None).cast("binary")
        aggs.append(F.struct(F.lit(i).alias("rule"), F.lit(e.name).alias("expectation"), F.lit(float(e.mostly)).alias("mostly"), n.alias("rows"), held.alias("held"), sketch.alias("sketch")).alias(f"e{i}"))
    part = F.concat_ws("/", *[F.coalesce(F.concat(F.lit(f"{c}="), F.col(c).cast("string")), F.lit(f"{c} is null")) for c in partition_by])
    one = df.groupBy(part.alias("part")).agg(*aggs)
    return one.select(F.lit(name).alias("suite"), "part", F.explode(F.array(*[f"e{i}" for i in range(len(rules))])).alias("r")).select("suite", "part", "r.*")


def merged_results(partials: DataFrame) -> DataFrame:
    """suite, rule, expectation, observed, error, success of all partitions together.

    Shares are exact (error 0). observed of a unique expectation is the rows less the estimated distinct keys; error is
    three standard errors of that estimate, and it succeeds where observed lies within it: few duplicates can hide there.
    """
    sums = partials.groupBy("suite", "rule", "expectation").agg(F.max("mostly").alias("mostly"), F.sum("rows").alias("rows"), F.sum("held").alias("held"), F.hll_union_agg("sketch").alias("sketch"))
    unique_ = F.col("expectation").startswith("unique:")
    error = F.when(unique_, 3 * 1.04 / 2 ** (SKETCH_K / 2) * F.col("rows")).otherwise(0.0)
    spare = F.greatest(F.col("rows") - F.hll_sketch_estimate("sketch"), F.lit(0)).cast("double")
    share = F.when(F.col("rows") == 0, 1.0).otherwise(F.col("held") / F.col("rows"))
    df = sums.select("suite", "rule", "expectation", "mostly", F.when(unique_, spare).otherwise(share).alias("observed"), error.alias("error"))
    success = F.when(F.col("expectation").startswith("unique:"), F.col("observed") <= F.col("error")).otherwise(F.col("observed") >= F.col("mostly"))
    return df.select("suite", "rule", "expectation", "observed", "error", success.alias("success"))


def summarise(results: DataFrame) -> DataFrame:
    """suite, batch, evaluated, successful, unsuccessful, success_percent, success."""
    n, ok = F.count("*"), F.count_if("success")
    return results.groupBy("suite", "batch").agg(n.alias("evaluated"), ok.alias("successful"), (n - ok).alias("unsuccessful"), (ok / n * 100).alias("success_percent"), (n == ok).alias("success"))


def enforce(results: DataFrame, layer: str) -> dict:
    """The summary as a dict; raises for bronze and gold on any failure, for silver below 95 percent."""
    row = summarise(results).first().asDict()
    if row["success_percent"] < (95.0 if layer == "silver" else 100.0):
        raise QualityError(f"{layer} suite {row['suite']}: {row['unsuccessful']} of {row['evaluated']} expectations failed")
    return row


SUITES: dict[str, list[Expectation]] = {
    "bronze_movies": [not_null("id"), not_null("title"), has_type("id", "bigint"), not_null("extraction_timestamp"), unique("id", "extraction_timestamp")],
    "silver_movies": [unique("movie_id"), not_null("title", 0.95), not_null("release_date", 0.95), between("vote_average", 0, 10), between("vote_count", 0), between("popularity", 0)],
    "silver_reviews": [between("sentiment_score", -1, 1, 0.95)],
    "gold_genre_analytics": [not_null("total_movies"), not_null("avg_rating"), between("total_movies", 0), between("avg_rating", 0, 10)],
    "gold_trending_scores": [not_null("movie_id"), in_set("window", "7d", "30d", "90d"), between("trend_score", 0, 100)],
}
