"""Layered Parquet tables: paths, ingest, scans, writers, latest partition, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.schemas import LAYER_DAYS, PARTITIONS


def lake_path(root: str, layer: str, dataset: str) -> str:
    """root/layer/dataset; partitions are filters, not paths."""
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def path_parts(path: Column | str) -> Column:
    """Struct of root, layer, dataset and a map of partition values of a file's path."""
    p = F.col(path) if isinstance(path, str) else path
    pairs = F.regexp_extract_all(p, F.lit(r"/([^/=]+)=([^/]*)"), F.lit(1))
    values = F.regexp_extract_all(p, F.lit(r"/([^/=]+)=([^/]*)"), F.lit(2))
    part = lambda i: F.regexp_extract(p, r"^(.*?)/(bronze|silver|gold)/([^/]+)", i)
    return F.struct(part(1).alias("root"), part(2).alias("layer"), part(3).alias("dataset"), F.map_from_arrays(pairs, values).alias("partitions"))


def read_layer(spark: SparkSession, root: str, layer: str, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(lake_path(root, layer, dataset))


def with_ingest_metadata(rows: DataFrame, extracted_at: dt.datetime) -> DataFrame:
    """rows with raw_data (JSON of the source columns), extraction_timestamp (ISO, Z) and the four partition columns."""
    return rows.select(
        "*",
        F.to_json(F.struct("*")).alias("raw_data"),
        F.lit(extracted_at.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("extraction_timestamp"),
        F.lit(extracted_at.year).alias("partition_year"),
        F.lit(extracted_at.month).alias("partition_month"),
        F.lit(extracted_at.day).alias("partition_day"),
        F.lit(extracted_at.hour).alias("partition_hour"),
    )


def partition_columns(layer: str, dataset: str) -> list[str]:
    return PARTITIONS.get((layer, dataset)) or PARTITIONS[layer, "*"]


def write_layer(df: DataFrame, root: str, layer: str, dataset: str, append: bool = False) -> None:
    """Writes by the layer's partition columns. Without append the partitions that df touches are replaced, so a
    stage that runs twice leaves one copy. Rows are dealt by partition columns first, so that files stay few; a large
    partition, as one extraction's hour is, goes to several tasks of the advisory size and not to one."""
    keys = partition_columns(layer, dataset)
    out = df.hint("rebalance", *keys).write.partitionBy(*keys)
    if append:
        out.mode("append").parquet(lake_path(root, layer, dataset))
    else:
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(lake_path(root, layer, dataset))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, compact: bool = False) -> DataFrame:
    """df as a table of the catalog, in buckets of key, sorted within; returns the table.

    Tables of one number of buckets are joined and grouped by key without moving a row. Every task writes a file for each
    bucket it holds, which a hot key does not slow down; compact deals rows by key first, for one file a bucket.
    """
    out = df.repartition(buckets, key) if compact else df
    out.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def ingest_bronze(sources: list[DataFrame], key: str, extracted_at: dt.datetime, root: str, dataset: str) -> DataFrame:
    """Sources united, one row a key (the last source wins), metadata added, appended to Bronze; returns what was written."""
    from lakemill.operators.dedup import union_latest

    df = with_ingest_metadata(union_latest(sources, key), extracted_at)
    write_layer(df, root, "bronze", dataset, append=True)
    return df


def latest_partition(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: the largest combination of the partition columns; only partition values are read."""
    return df.agg(F.max(F.struct(*keys)).alias("p")).select("p.*")


def sample_ids(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first n ids by order descending, then key: a sampling feature with a fixed order."""
    return df.orderBy(F.desc(order), key).limit(n).select(key)


def expired_partitions(df: DataFrame, layer: str, as_of: dt.date, days: int | None = None) -> DataFrame:
    """Distinct partition dates of a layer older than its retention; day is 1 where the layer has no day column."""
    day = F.col("partition_day") if "partition_day" in df.columns else F.lit(1)
    d = F.make_date("partition_year", "partition_month", day)
    return df.select(d.alias("partition_date")).distinct().where(F.col("partition_date") < F.date_sub(F.lit(as_of), days or LAYER_DAYS[layer]))


def drop_expired(spark: SparkSession, root: str, layer: str, dataset: str, as_of: dt.date, days: int | None = None) -> int:
    """Deletes the folders of a layer's partitions older than its retention; returns how many. A second run deletes none."""
    path = lake_path(root, layer, dataset)
    df = spark.read.parquet(path)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    # as many rows as there are expired dates
    for row in expired_partitions(df, layer, as_of, days).collect():
        d = row["partition_date"]
        folder = f"{path}/partition_year={d.year}/partition_month={d.month}" + (f"/partition_day={d.day}" if "partition_day" in df.columns else "")
        gone += fs.delete(fs_path(folder), True)
    return gone


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows of each named table, in one plan."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
