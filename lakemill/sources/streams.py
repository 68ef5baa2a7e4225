"""Streaming sources, decoding, validation, envelopes and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakemill.functions.scalar import event_time
from lakemill.schemas import STREAMS
from lakemill.sources.tables import KeyedTable
from lakemill.sources.views import upsert_by_key


def read_stream(spark: SparkSession, fmt: str, schema: T.StructType | None = None, path: str | None = None, **options: str) -> DataFrame:
    """A stream of any source: kafka (subscribe, kafka.bootstrap.servers ...), rate, or files of parquet or json.

    Kafka defaults: startingOffsets latest, failOnDataLoss false.
    """
    if fmt == "kafka":
        options = {"startingOffsets": "latest", "failOnDataLoss": "false"} | options
    r = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def decode(df: DataFrame, kind: str, fmt: str = "json", header: int = 0) -> DataFrame:
    """value (binary) as the columns of the stream's schema, with the broker's time as kafka_timestamp.

    header: bytes in front of the payload (5 for registry-framed Avro). avro needs the spark-avro package.
    """
    body = F.expr(f"substring(value, {header + 1})") if header else F.col("value")
    if fmt == "avro":
        from pyspark.sql.avro.functions import from_avro

        data = from_avro(body, avro_schema(STREAMS[kind], kind))
    else:
        data = F.from_json(body.cast("string"), STREAMS[kind])
    when = F.col("timestamp") if "timestamp" in df.columns else F.lit(None).cast("timestamp")
    return df.select(data.alias("data"), when.alias("kafka_timestamp")).select("data.*", "kafka_timestamp")


def avro_schema(schema: T.StructType, name: str) -> str:
    """The Avro record of a flat schema, every field nullable."""
    import json

    base = {"string": "string", "int": "int", "bigint": "long", "double": "double", "boolean": "boolean"}

    def of(t: T.DataType):
        return {"type": "array", "items": of(t.elementType)} if isinstance(t, T.ArrayType) else base[t.simpleString()]

    return json.dumps({"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", of(f.dataType)], "default": None} for f in schema.fields]})


def schema_id(value: str = "value") -> Column:
    """The number in the registry's 5-byte header (a zero byte, then 4 bytes, most significant first); null without one."""
    v = F.col(value)
    return F.when((F.length(v) > 5) & (F.hex(F.substring(v, 1, 1)) == "00"), F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("long"))


def decode_registered(df: DataFrame, kind: str, writers: dict[int, T.StructType], fmt: str = "avro") -> tuple[DataFrame, DataFrame]:
    """(decoded, unknown) of framed messages that several writer schemas share a topic for.

    writers: registry number -> the schema that the message was written with. Each message is read with its own and
    resolved to the stream's: fields that the writer did not know are null, those that the stream does not know are left
    out, numbers are widened. avro leaves the resolution to the decoder (writer and reader schema; it needs the spark-avro
    package); json does it by name. Messages without a header or of an unknown number keep their columns.
    """
    reader, body = STREAMS[kind], F.expr("substring(value, 6)")

    def read(writer: T.StructType) -> Column:
        if fmt == "avro":
            from pyspark.sql.avro.functions import from_avro

            return from_avro(body, avro_schema(writer, kind), {"avroSchema": avro_schema(reader, kind)})
        data = F.from_json(body.cast("string"), writer)
        return F.when(data.isNotNull(), F.struct(*[(data[f.name].try_cast(f.dataType) if f.name in writer.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in reader.fields]))

    tagged = df.withColumn("_id", schema_id())
    data = F.coalesce(*[F.when(F.col("_id") == n, read(w)) for n, w in writers.items()])
    known = F.coalesce(F.col("_id").isin(*writers), F.lit(False))
    when = F.col("timestamp") if "timestamp" in df.columns else F.lit(None).cast("timestamp")
    decoded = tagged.where(known).select("_id", data.alias("data"), when.alias("kafka_timestamp")).select("data.*", "kafka_timestamp", F.col("_id").alias("schema_id"))
    return decoded, tagged.where(~known).withColumnRenamed("_id", "schema_id")


def with_event_time(df: DataFrame, ms: str = "timestamp") -> DataFrame:
    return df.withColumn("event_time", event_time(ms))


#: required fields of each kind of event
REQUIRED = {"reviews": ["review_id", "movie_id", "content"], "ratings": ["movie_id", "vote_average", "vote_count"], "metadata": ["movie_id", "title"]}
#: fields with a default
DEFAULTS = {"metadata": {"adult": ("boolean", "false"), "video": ("boolean", "false")}}


def normalise_events(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). df holds strings (e.g. parsed loosely); fields are cast to the stream's schema.

    A missing required field or one that does not cast is an error; quarantined rows keep their columns and an
    `errors` array. Defaults fill adult and video; a genres value that is no list becomes an empty list.
    """
    schema, cols, errors = STREAMS[kind], [], []
    for f in schema.fields:
        raw = F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        if isinstance(f.dataType, T.ArrayType):
            is_list = f.name in df.columns and isinstance(df.schema[f.name].dataType, T.ArrayType)
            value = F.array_compact(raw) if is_list else F.from_json(raw.cast("string"), f.dataType)
            value = F.coalesce(value, F.array().cast(f.dataType))
        else:
            value = raw.try_cast(f.dataType)
            errors.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if f.name in REQUIRED.get(kind, []):
            errors.append(F.when(raw.isNull(), F.lit(f"{f.name}: missing")))
        cols.append(value.alias(f.name))
    for name, (type_, default) in DEFAULTS.get(kind, {}).items():
        raw = F.col(name).try_cast(type_) if name in df.columns else F.lit(None).cast(type_)
        cols.append(F.coalesce(raw, F.lit(default).cast(type_)).alias(name))
    tagged = df.withColumn("errors", F.array_compact(F.array(*errors)))
    return tagged.where(F.size("errors") == 0).select(*cols), tagged.where(F.size("errors") > 0)


def to_event_envelope(df: DataFrame, topic: str, key: str, event_type: str, now: str = "current_timestamp()") -> DataFrame:
    """topic, key, value (JSON of the row, timestamp filled with now in ms), headers with the event type."""
    ms = F.unix_millis(F.expr(now).cast("timestamp"))
    df = df.withColumn("timestamp", F.coalesce("timestamp", ms) if "timestamp" in df.columns else ms)
    return df.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"), F.array(F.struct(F.lit("event_type").alias("key"), F.lit(event_type).cast("binary").alias("value"))).alias("headers"))


def key_value(df: DataFrame, key: str) -> DataFrame:
    """key and the whole row as JSON, for a message sink."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_stream(df: DataFrame, fmt: str, checkpoint: str, mode: str = "append", trigger: str | None = "30 seconds", name: str | None = None, **options: str) -> StreamingQuery:
    """Starts a query on any sink (kafka, parquet, json, console, memory); trigger None runs what is available and ends."""
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    if name:
        w = w.queryName(name)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def upsert_stream(df: DataFrame, path: str, keys: list[str], order_by: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append", trigger: str | None = "30 seconds", partition_by: list[str] = ()) -> StreamingQuery:
    """foreachBatch into a keyed table. Rows replace rows of their key, so a batch that is run again changes nothing."""

    def put(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                upsert_by_key(path, transform(batch) if transform else batch, keys, order_by, partition_by)
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def table_stream(df: DataFrame, table: KeyedTable, name: str, checkpoint: str, combine: dict[str, str] | None = None, transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append", trigger: str | None = "30 seconds", vacuum_hours: float = 24.0) -> StreamingQuery:
    """foreachBatch into a versioned table, each micro-batch once, however often it is run.

    name: the stream's name in the table's ledger; keep it with the checkpoint. The ledger is committed with the rows, so a
    batch that was written and is run again (the driver was lost before the checkpoint knew) is passed over, and one
    that was staged but not committed is written anew. Without combine rows replace rows of their key; with it (column
    -> sum, min, max) they add up, as for views that count for ever. Empty batches are skipped.
    """

    def put(batch: DataFrame, number: int) -> None:
        if table.seen((name, number)):
            return
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                rows = transform(batch) if transform else batch
                table.add(rows, combine, (name, number)) if combine else table.upsert(rows, (name, number))
                if number % 100 == 99:
                    table.vacuum(vacuum_hours)
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint).queryName(name)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def stop_all(spark: SparkSession) -> int:
    """Stops all active queries; returns how many."""
    active = list(spark.streams.active)
    for q in active:
        q.stop()
    return len(active)
