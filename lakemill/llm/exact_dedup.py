"""Exact dedup by a stateful stream: keyed state on disk, without expiry, holds digest, smallest id and content locator.

A narrow row (digest, doc_id, locator) of every document streams into a keyed aggregation in the RocksDB state store.
Its state remembers, for each digest for ever, the row that stays and how many rows came: a later stream from the same
checkpoint goes on where the last one ended. The state is then read as a table. Wherever a digest was met again, the
whole texts are compared with the text that the locator names; texts that differ under one digest are told apart by
their bytes, so a clash of digests costs time and never a document.

Defined results: a null text counts as empty; texts are equal when they are identical after each run of blanks and
line ends becomes one space. The row with the smallest doc_id stays, any id before a null one, and of one id the first
by file and row; keep_id is null only where no row of the group has an id. Other columns, an empty table and very long
texts need nothing special.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import fresh_path, sized, written

BLANK = r"[\x20\x09-\x0D]+"
ROWS = "doc_id long, text_sha256 string, digest string, file string, at long"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a store is closed when its task ends: however many partitions there are, only those at work hold files and memory
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def normal_text() -> Column:
    return F.regexp_replace(F.coalesce("text", F.lit("")), BLANK, " ")


def located(docs: DataFrame, digest: Callable[[Column], Column] | None = None) -> DataFrame:
    """docs, a scan of files (doc_id, text), as doc_id, norm, text_sha256, digest and the locator: file and row in it."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normal_text().alias("norm"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    d = d.withColumn("text_sha256", F.sha2("norm", 256))
    return d.withColumn("digest", digest(F.col("norm")) if digest else F.col("text_sha256"))


def keeper() -> Column:
    """Of the rows of a digest, the one that stays."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "at")).alias("keep")


def remembered(rows: DataFrame) -> DataFrame:
    """The stateful step, for a stream (or a batch) of narrow rows: digest, keep, group_size."""
    return rows.groupBy("digest").agg(keeper(), F.count("*").alias("group_size"))


@contextmanager
def _disk_state(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def take_in(spark: SparkSession, folder: str, checkpoint: str, files_per_batch: int = 2000) -> int:
    """Streams the narrow rows in folder that the checkpoint has not seen into its state; returns the micro-batches run."""
    rows = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    with _disk_state(spark):
        q = remembered(rows).writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(q.recentProgress)


def state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, keep, group_size: what the state store of a checkpoint holds, read as a table."""
    return spark.read.format("statestore").load(checkpoint).select("key.digest", F.col("value.min").alias("keep"), F.col("value.count").alias("group_size"))


def clashes(content: DataFrame, known: DataFrame, rows_per_part: int = 1000) -> DataFrame:
    """Digests under which whole texts differ from the text that the state's locator names.

    A digest met once is left out. The rows of a large group are dealt to parts, and the located text goes to each of
    them; equal texts fold into one before they are shuffled, so that a part is decided by its smallest and largest text.
    """
    met = known.where("group_size > 1").select("digest", F.col("keep.file").alias("keep_file"), F.col("keep.at").alias("keep_at"), F.ceil(F.col("group_size") / rows_per_part).cast("int").alias("parts"))
    t = content.select("digest", "norm", "file", "at").join(sized(met, 100_000), "digest")
    own = F.pmod(F.xxhash64("file", "at"), F.col("parts")).cast("int")
    stays = (F.col("file") == F.col("keep_file")) & (F.col("at") == F.col("keep_at"))
    t = t.select("digest", "norm", F.explode(F.when(stays, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))).alias("part"))
    return t.groupBy("digest", "part").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).where("a != b").select("digest").distinct()


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] | None = None, files_per_batch: int = 2000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs, a scan of files with doc_id and text.

    digest: another digest of a text than SHA-256, whose clashes are then told apart.
    """
    spark = docs.sparkSession
    content = located(docs, digest)
    folder, checkpoint = fresh_path(spark, "tables"), fresh_path(spark, "streams")
    content.select("doc_id", "text_sha256", "digest", "file", "at").write.parquet(folder)
    take_in(spark, folder, checkpoint, files_per_batch)
    rows, known = spark.read.schema(ROWS).parquet(folder), written(state(spark, checkpoint))
    wrong = written(clashes(content, known))
    if wrong.isEmpty():
        return _ruled(rows.join(known, "digest"))
    wrong = sized(wrong)
    plain = rows.join(wrong, "digest", "left_anti").join(known, "digest")
    # equal bytes under a digest that clashes; texts fold into one row each before they are shuffled
    told = content.join(wrong, "digest", "left_semi")
    groups = told.groupBy("digest", "norm").agg(keeper(), F.count("*").alias("group_size"))
    return _ruled(plain).unionByName(_ruled(told.join(groups, ["digest", "norm"])))


def _ruled(rows: DataFrame) -> DataFrame:
    kept = (F.col("file") == F.col("keep.file")) & (F.col("at") == F.col("keep.at"))
    return rows.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
