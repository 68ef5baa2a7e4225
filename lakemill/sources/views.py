"""Keyed serving tables on Parquet: upsert, export, speed sync, expiry, health, metrics."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators.dedup import latest_by
from lakemill.schemas import BATCH_VIEW_KEYS, SPEED_VIEW_KEYS, TTL_HOURS
from lakemill.sources.tables import KeyedTable


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def merged_by_key(target: DataFrame, source: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """target with the rows of source put in by key; of equal keys in source the latest by order_by stays."""
    new = latest_by(source, keys, order_by, [c for c in source.columns if c not in keys and c != order_by and _orderable(source, c)])
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def _orderable(df: DataFrame, c: str) -> bool:
    return not df.schema[c].dataType.simpleString().startswith("map")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark._jsc.hadoopConfiguration()), p


def recover(spark: SparkSession, path: str) -> None:
    """Puts a table back that a replacement, ended half-way, has left under its old name."""
    old = f"{path.rstrip('/')}__old"
    fs, p = _fs(spark, path)
    if fs.exists(p(old)):
        if not fs.exists(p(path)):
            fs.rename(p(old), p(path))
        else:
            fs.delete(p(old), True)


def _replace(spark: SparkSession, staged: str, path: str) -> None:
    """The staged folder takes the table's place; until it has, the old one is there, or is found by recover()."""
    old = f"{path.rstrip('/')}__old"
    fs, p = _fs(spark, path)
    if fs.exists(p(path)) and not fs.rename(p(path), p(old)):
        raise OSError(f"cannot rename {path}")
    if not fs.rename(p(staged), p(path)):
        raise OSError(f"cannot rename {staged}; the table is in {old}")
    fs.delete(p(old), True)


def upsert_by_key(path: str, source: DataFrame, keys: list[str], order_by: str, partition_by: list[str] = ()) -> int:
    """Upserts source into the Parquet table at path; returns the rows written.

    Only partitions that source touches are read and rewritten. New files are staged beside the table first, since a
    table cannot be overwritten while it is read; the staged folder then takes its place by renaming. Where a partition
    column is not a key, a row may change its partition: the table's keys are then searched for the old places as well.
    """
    spark = source.sparkSession
    partition_by = list(partition_by)
    recover(spark, path)
    touched = None
    if _exists(spark, path):
        target = spark.read.parquet(path)
        if partition_by:
            touched = source.select(*partition_by)
            if not set(partition_by) <= set(keys):
                moving = target.join(source.select(*keys).distinct(), keys, "left_semi").select(*partition_by)
                touched = touched.unionByName(moving)
            touched = touched.distinct()
            target = target.join(touched, partition_by, "left_semi")
        merged = merged_by_key(target, source, keys, order_by)
    else:
        merged = latest_by(source, keys, order_by, [c for c in source.columns if c not in keys and c != order_by and _orderable(source, c)])
    staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
    merged.write.parquet(staged)
    out = spark.read.schema(merged.schema).parquet(staged)
    n = out.count()  # from the files' footers
    if partition_by:
        # partitions that lose their last row are not written, and so must be removed; few, as they are touched ones
        emptied = touched.join(out.select(*partition_by).distinct(), partition_by, "left_anti").collect() if touched is not None else []
        out.write.mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic").parquet(path)
        fs, p = _fs(spark, staged)
        for row in emptied:
            fs.delete(p("/".join([path.rstrip("/"), *(f"{c}={row[c]}" for c in partition_by)])), True)
        fs.delete(p(staged), True)
    else:
        _replace(spark, staged, path)
    return n


def purge(spark: SparkSession, path: str, ts: str, ttl_hours: float, as_of: dt.datetime) -> dict[str, int]:
    """Rewrites the table at path without the rows whose life has ended; returns the numbers kept and deleted."""
    recover(spark, path)
    df = spark.read.parquet(path)
    counts = expired_count(df, ts, ttl_hours, as_of).first().asDict()
    if counts["deleted"]:
        staged = f"{path.rstrip('/')}__staged_{uuid.uuid4().hex}"
        expire(df, ts, ttl_hours, as_of).write.partitionBy(*folder_columns(df, path)).parquet(staged)
        _replace(spark, staged, path)
    return counts


def folder_columns(df: DataFrame, path: str) -> list[str]:
    """The partition columns of the table at path, in the order of its folders, which a rewrite must keep."""
    files = df.inputFiles()
    below = files[0].split(path.rstrip("/").split("/")[-1], 1)[-1].split("/")[:-1] if files else []
    return [c for c in (x.split("=", 1)[0] for x in below if "=" in x) if c in df.columns]


def tag_batch_view(gold: DataFrame, view_type: str) -> DataFrame:
    """Gold rows without partition columns, tagged for serving. An unknown view_type is an error."""
    if view_type not in BATCH_VIEW_KEYS:
        raise ValueError(f"unknown view_type {view_type!r}")
    return gold.drop("partition_year", "partition_month").withColumn("view_type", F.lit(view_type))


def batch_view_table(spark: SparkSession, root: str, view_type: str) -> KeyedTable:
    """The versioned table of a batch view, keyed by its natural key; the row computed last stays."""
    return KeyedTable(spark, f"{root}/{view_type}", BATCH_VIEW_KEYS[view_type], "computed_at")


def speed_view_table(spark: SparkSession, root: str, view: str, order_by: str, partition_by: list[str] = ()) -> KeyedTable:
    """The versioned table of a speed view, by its primary key."""
    return KeyedTable(spark, f"{root}/{view}", SPEED_VIEW_KEYS[view], order_by, partition_by)


def export_batch_views(gold: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Upserts each Gold dataset into path/<view_type>; returns ok or the error of each, going on after a failure."""
    done = {}
    for view_type, df in gold.items():
        try:
            upsert_by_key(f"{path}/{view_type}", tag_batch_view(df, view_type), BATCH_VIEW_KEYS[view_type], "computed_at")
            done[view_type] = "ok"
        except Exception as e:  # reported to the caller, who decides
            done[view_type] = f"{type(e).__name__}: {e}"
    return done


def speed_documents(sentiments: DataFrame, stats: DataFrame, trending: DataFrame, updated_at: dt.datetime) -> DataFrame:
    """The three speed views as documents: movie_id, hour, event_ts, data_type, one payload struct, updated_at."""
    stamp = F.lit(updated_at).cast("timestamp").alias("updated_at")
    a = sentiments.select("movie_id", "hour", F.coalesce("window_start", "hour").alias("event_ts"), F.lit("sentiment").alias("data_type"), F.struct("avg_sentiment", "review_count", "positive_count", "negative_count", "neutral_count").alias("sentiment"), stamp)
    b = stats.select("movie_id", "hour", F.col("hour").alias("event_ts"), F.lit("stats").alias("data_type"), F.struct("vote_average", "vote_count", "popularity", "rating_velocity").alias("stats"), stamp)
    c = trending.select("movie_id", "hour", F.col("hour").alias("event_ts"), F.lit("trending").alias("data_type"), F.struct("title", "rank", "trending_score", "velocity", "acceleration").alias("trending"), stamp)
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


DOCUMENT_KEYS = ["movie_id", "hour", "event_ts", "data_type"]


def write_speed_view(rows: DataFrame, view: str, root: str, order_by: str) -> int:
    """Upserts rows into a speed view by its primary key; returns the rows written."""
    return upsert_by_key(f"{root}/{view}", rows, SPEED_VIEW_KEYS[view], order_by)


def write_speed_views(rows: dict[str, tuple[DataFrame, str]], root: str) -> dict[str, int]:
    """Upserts a batch of views, each given with the column that orders its rows; returns the rows written of each."""
    return {view: write_speed_view(df, view, root, order_by) for view, (df, order_by) in rows.items()}


def metric_rows(values: DataFrame, name: str, at: dt.datetime, **tags: object) -> DataFrame:
    """values (one column `value`) as metric rows with string tags."""
    pairs = [x for k, v in tags.items() for x in (F.lit(k), F.lit(str(v)))]
    return values.select(F.lit(name).alias("metric_name"), F.lit(at).cast("timestamp").alias("timestamp"), F.col("value").cast("double").alias("value"), F.create_map(*pairs).cast("map<string,string>").alias("tags"))


# ---- lifetimes ------------------------------------------------------------------------------------------------------


def expire(df: DataFrame, ts: str, ttl_hours: float, as_of: dt.datetime) -> DataFrame:
    """Rows that still live at as_of."""
    return df.where(F.col(ts) >= F.lit(as_of - dt.timedelta(hours=ttl_hours)))


def expired_count(df: DataFrame, ts: str, ttl_hours: float, as_of: dt.datetime) -> DataFrame:
    """kept, deleted: one row."""
    old = F.col(ts) < F.lit(as_of - dt.timedelta(hours=ttl_hours))
    return df.agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("deleted"))


def expiring_soon(df: DataFrame, ts: str, ttl_hours: float, as_of: dt.datetime, within_hours: float) -> DataFrame:
    """expiring: rows whose life ends in the next hours."""
    end = F.col(ts) + F.expr(f"interval {int(ttl_hours * 3600)} seconds")
    return df.agg(F.count_if((end >= F.lit(as_of)) & (end < F.lit(as_of + dt.timedelta(hours=within_hours)))).alias("expiring"))


def table_sizes(df: DataFrame) -> DataFrame:
    """rows, files, bytes of a file table, from rows' file metadata."""
    m = df.select("_metadata.file_path", "_metadata.file_size")
    return m.groupBy("file_path").agg(F.count("*").alias("rows"), F.first("file_size").alias("bytes")).agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def suggested_ttl(ttl_hours: Column, size_bytes: Column, target_bytes: float, floor_hours: float = 6) -> Column:
    """ttl * target / size, at least the floor; the ttl itself if the table is within the target."""
    return F.when(size_bytes <= target_bytes, ttl_hours.cast("double")).otherwise(F.greatest(F.lit(float(floor_hours)), ttl_hours * target_bytes / size_bytes))


def ttl_registry(spark: SparkSession, ttl: dict[str, int] = TTL_HOURS) -> DataFrame:
    """table, ttl_hours."""
    return spark.createDataFrame(sorted(ttl.items()), "table string, ttl_hours int")


def health_report(tables: DataFrame) -> DataFrame:
    """Score of each table: 100, less 50 for a ttl mismatch, 20 without a count, 10 without a size, 15 above 2 GB.

    tables: table, ttl_hours (expected), actual_ttl_hours, rows, bytes.
    """
    gone = F.when(F.coalesce(F.col("actual_ttl_hours") != F.col("ttl_hours"), F.lit(True)), 50).otherwise(0)
    gone = gone + F.when(F.col("rows").isNull(), 20).otherwise(0) + F.when(F.col("bytes").isNull(), 10).otherwise(0) + F.when(F.col("bytes") > 2 * 1024**3, 15).otherwise(0)
    return tables.withColumn("score", F.lit(100) - gone).withColumn("healthy", F.col("score") >= 80)
