"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.session import shared_folder

#: words of the decontamination and licence contracts, after lower-casing A-Z
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: what stands between them; splitting at it is several times faster than extracting words
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: list[str] = []


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder, which drop_written() deletes."""
    _WRITTEN.append(f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}")
    return _WRITTEN[-1]


#: Spark (4.1) deletes the shuffle files of a query when it ends, and not only when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: lineage is cut, lost executors lose nothing and no shuffle files stay."""
    spark = df.sparkSession
    path = fresh_path(spark, "tables")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> int:
    """Deletes the tables that this process has written so far, once no DataFrame made from them is needed; returns how many."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    n = 0
    while _WRITTEN:
        path = p(_WRITTEN.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the column's text form, modulo n (null stays null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def lower_ascii(col: Column) -> Column:
    """Lower-cases A-Z alone. lower() does the same on pure ASCII text and is much cheaper there."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, upper, upper.lower()))


def chunks(texts: list[str], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about `size` characters in all; a longer text stands alone."""
    a, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield a, i
            a, total = i, 0
        total += len(t)
    if a < len(texts):
        yield a, len(texts)


#: rows of a few dozen bytes each that may be sent to every executor
BROADCAST_ROWS = 500_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows are few enough; otherwise joins shuffle it. df is best written before."""
    return F.broadcast(df) if df.count() <= most else df


def free_name(names: list[str], base: str) -> str:
    """base, with underscores until no column has this name."""
    taken = {n.lower() for n in names}
    while base.lower() in taken:
        base += "_"
    return base
