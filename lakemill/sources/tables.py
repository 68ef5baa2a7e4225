"""Keyed tables in versions: a commit is one small manifest, so readers always meet a whole table.

    path/_manifests/000000007.json   which folders make up version 7, and which stream batches it has taken in
    path/data/<uuid>/part=<md5>/     the rows of one partition, as written by one commit

A write stages only the partitions it touches, in a folder that no version names, and then commits a manifest that
names the new folders beside the old ones of all other partitions. Until then nothing has changed for anybody; a writer
that ends half-way leaves folders that nothing names and that vacuum() removes. A reader plans on the folders of one
manifest, which stay until they are vacuumed. The manifest also holds the last batch of each stream, so rows and ledger
change together and a batch that is run again, also one that adds up, is recognised.

One writer at a time: a second one that commits the same version is told so (Conflict) and changes nothing. Lists of
partitions pass through the driver; rows do not.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemill.operators.dedup import latest_by


class Conflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass
class Manifest:
    version: int
    schema: str
    parts: dict[str, dict]  # md5 of the partition's values -> folder, rows, values
    batches: dict[str, int] = field(default_factory=dict)
    committed_ms: int = 0
    writer: str = ""

    @property
    def folders(self) -> list[str]:
        return [p["folder"] for p in self.parts.values()]


class KeyedTable:
    """A table of one row a key. keys, order_by (the later row of a key stays) and partition_by are the writer's."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] = (), order_by: str = "", partition_by: list[str] = ()):
        self.spark, self.path, self.keys, self.order_by, self.partition_by = spark, path.rstrip("/"), list(keys), order_by, list(partition_by)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifests

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.path}/_manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())

    def _file(self, version: int) -> str:
        return f"{self.path}/_manifests/{version:09d}.json"

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest manifest, or that of a version; None if there is none yet."""
        found = self._versions()
        if not found:
            return None
        stream = self._fs.open(self._path(self._file(found[-1] if version is None else version)))
        try:
            return Manifest(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def exists(self) -> bool:
        return bool(self._versions())

    def _commit(self, m: Manifest) -> None:
        m.committed_ms, m.writer = int(time.time() * 1000), uuid.uuid4().hex
        temp, final = self._path(f"{self.path}/_manifests/.{m.writer}"), self._path(self._file(m.version))
        out = self._fs.create(temp, True)
        out.write(bytearray(json.dumps(m.__dict__).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(temp, final) or self.manifest(m.version).writer != m.writer:
            self._fs.delete(temp, False)
            raise Conflict(f"version {m.version} of {self.path} was committed by another writer")

    # ---- reading

    def read(self, version: int | None = None, only: list[str] | None = None) -> DataFrame:
        """The rows of the newest (or a given) version, of all partitions or those named by their md5. No table is an error."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no keyed table at {self.path}")
        return self._rows(m, m.folders if only is None else [m.parts[p]["folder"] for p in only if p in m.parts])

    def _rows(self, m: Manifest, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(m.schema))
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def pruned(self, **values: object) -> DataFrame:
        """The rows of the partitions with these values; folders of others are not even listed."""
        m = self.manifest()
        want = {c: None if v is None else str(v) for c, v in values.items()}
        return self.read(m.version, [k for k, p in m.parts.items() if all(p["values"].get(c) == v for c, v in want.items())])

    # ---- writing

    def _part(self) -> Column:
        """md5 of the partition's values; a null value is told apart from every text."""
        if not self.partition_by:
            return F.lit("all")
        return F.md5(F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in self.partition_by]))

    def _stage(self, rows: DataFrame) -> dict[str, dict]:
        """Writes rows by partition to a folder that no version names yet; returns it as parts of a manifest."""
        folder = f"data/{uuid.uuid4().hex}"
        out = rows.withColumn("part", self._part())
        out = out.hint("rebalance", "part") if self.partition_by else out
        out.write.partitionBy("part").parquet(f"{self.path}/{folder}")
        named = [n for n in (s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/{folder}"))) if n.startswith("part=")]
        if not named:
            return {}
        back = self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("part", T.StringType())])).option("basePath", f"{self.path}/{folder}").parquet(*[f"{self.path}/{folder}/{n}" for n in named])
        values = F.struct(*[F.first(F.col(c).cast("string")).alias(c) for c in self.partition_by]) if self.partition_by else F.lit(None)
        found = back.groupBy("part").agg(F.count("*").alias("rows"), values.alias("values")).collect()  # as many rows as partitions touched
        return {r["part"]: {"folder": f"{folder}/part={r['part']}", "rows": r["rows"], "values": r["values"].asDict() if r["values"] else {}} for r in found}

    def _touched(self, source: DataFrame, m: Manifest | None) -> list[str]:
        if not self.partition_by:
            return [] if source.isEmpty() else ["all"]
        parts = source.select(self._part().alias("part"))
        if m is not None and self.partition_by and not set(self.partition_by) <= set(self.keys):
            # a row may change its partition, so the places where its key stands now are touched as well
            here = self._rows(m, m.folders).join(source.select(*self.keys).distinct(), self.keys, "left_semi")
            parts = parts.unionByName(here.select(self._part().alias("part")))
        return [r["part"] for r in parts.distinct().collect()]

    def seen(self, batch: tuple[str, int] | None) -> bool:
        """Whether the newest version has taken in this (stream, batch id) or a later one of the stream."""
        m = self.manifest() if batch else None
        return m is not None and m.batches.get(batch[0], -1) >= batch[1]

    def partitions(self, rows: DataFrame) -> list[str]:
        """The md5 of each partition that rows belong to."""
        return self._touched(rows, None)

    def _write(self, source: DataFrame, merge, batch: tuple[str, int] | None, also: list[str] = (), known: bool = False) -> int:
        m = self.manifest()
        if batch and m is not None and m.batches.get(batch[0], -1) >= batch[1]:
            return 0
        if m is not None:
            source = self._fit(source, m)
        touched = sorted({*([] if known else self._touched(source, m)), *also})
        old = m.parts if m else {}
        target = self._rows(m, [old[p]["folder"] for p in touched if p in old]) if m else None
        rows = merge(target, source)
        staged = self._stage(rows)
        parts = {k: v for k, v in old.items() if k not in touched} | staged
        batches = dict(m.batches if m else {}) | ({batch[0]: batch[1]} if batch else {})
        self._commit(Manifest((m.version if m else 0) + 1, rows.schema.json(), parts, batches))
        return sum(p["rows"] for p in staged.values())

    def _fit(self, source: DataFrame, m: Manifest) -> DataFrame:
        """Columns that source shares with the table take the table's types."""
        types = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(m.schema)).fields}
        return source.select(*[F.col(c).cast(types[c]).alias(c) if c in types and source.schema[c].dataType != types[c] else F.col(c) for c in source.columns])

    def _ties(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in self.keys and c != self.order_by and "map<" not in df.schema[c].dataType.simpleString()]

    def upsert(self, source: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """Puts source in by key; returns the rows written (0 for a batch that was taken in before).

        Of equal keys in source the latest by order_by stays; it replaces the stored row.
        """

        def merge(target: DataFrame | None, new: DataFrame) -> DataFrame:
            new = latest_by(new, self.keys, self.order_by, self._ties(new))
            if target is None:
                return new
            return target.join(new.select(*self.keys), self.keys, "left_anti").unionByName(new, allowMissingColumns=True)

        return self._write(source, merge, batch)

    def add(self, source: DataFrame, combine: dict[str, str], batch: tuple[str, int] | None = None) -> int:
        """Adds source up with the stored rows by key: combine gives sum, min or max for columns; the others follow the
        later row by order_by. Give the batch: without it, rows that come twice count twice."""
        how = {"sum": F.sum, "min": F.min, "max": F.max}

        def merge(target: DataFrame | None, new: DataFrame) -> DataFrame:
            df = new if target is None else target.unionByName(new, allowMissingColumns=True)
            rest = [c for c in df.columns if c not in self.keys and c not in combine]
            aggs = [how[f](c).cast(df.schema[c].dataType).alias(c) for c, f in combine.items()]
            if rest:
                order = F.struct(self.order_by, *[c for c in self._ties(df) if c in rest]) if self.order_by else F.struct(*[c for c in self._ties(df) if c in rest])
                aggs.append(F.max_by(F.struct(*rest), order).alias("_rest"))
            return df.groupBy(*self.keys).agg(*aggs).select(*self.keys, *combine, *([f"_rest.{c}" for c in rest])).select(*df.columns)

        return self._write(source, merge, batch)

    def replace(self, source: DataFrame, also: list[str] = (), batch: tuple[str, int] | None = None, known: bool = False) -> int:
        """Puts source in the place of all rows of the partitions it has rows in, and of those in also (by their md5), which
        may so become empty; for lists that are made anew as a whole. Keys are the caller's: they are not compared.
        known: also holds every partition of source, which is then not run once more to find them."""
        return self._write(source, lambda _, new: new, batch, also, known)

    def purge(self, ts: str, ttl_hours: float, as_of: dt.datetime) -> dict[str, int]:
        """Commits a version without the rows whose life has ended; returns the numbers kept and deleted.

        Partitions that lose no row are not rewritten, and those that lose all are only no longer named. Rows without a time stay.
        """
        m = self.manifest()
        old = F.coalesce(F.col(ts) < F.lit(as_of - dt.timedelta(hours=ttl_hours)), F.lit(False))
        counts = self._rows(m, m.folders).groupBy(self._part().alias("part")).agg(F.count_if(old).alias("old"), F.count_if(~old).alias("kept")).collect()
        gone = {r["part"] for r in counts if r["old"]}
        out = {"kept": sum(r["kept"] for r in counts), "deleted": sum(r["old"] for r in counts)}
        if gone:
            shrunk = [r["part"] for r in counts if r["old"] and r["kept"]]
            staged = self._stage(self._rows(m, [m.parts[p]["folder"] for p in shrunk]).where(~old)) if shrunk else {}
            self._commit(Manifest(m.version + 1, m.schema, {k: v for k, v in m.parts.items() if k not in gone} | staged, m.batches))
        return out

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Removes versions older than that (never the newest), then folders that no version names; returns how many folders.

        Give more hours than the longest read takes: a reader keeps the folders of the version it began with.
        """
        before = int((time.time() - older_than_hours * 3600) * 1000)
        versions = self._versions()
        kept = []
        for v in versions:
            m = self.manifest(v)
            if v != versions[-1] and m.committed_ms < before:
                self._fs.delete(self._path(self._file(v)), False)
            else:
                kept.append(m)
        named, gone = {f for m in kept for f in m.folders}, 0
        data = self._path(f"{self.path}/data")
        for run in self._fs.listStatus(data) if self._fs.exists(data) else []:
            # a folder younger than that may belong to a writer at work
            if run.getModificationTime() < before:
                name, inside = run.getPath().getName(), list(self._fs.listStatus(run.getPath()))
                loose = [s for s in inside if f"data/{name}/{s.getPath().getName()}" not in named]
                gone += sum(s.getPath().getName().startswith("part=") for s in loose)
                for s in [run] if len(loose) == len(inside) else loose:
                    self._fs.delete(s.getPath(), True)
        return gone
