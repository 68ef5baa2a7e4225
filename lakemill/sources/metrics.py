"""Counts and metrics that are gathered while a plan or a stream runs, so that nothing is run twice for them."""

from __future__ import annotations

import datetime as dt
import threading
from collections import deque

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

METRIC = "metric_name string, timestamp timestamp, value double, tags map<string,string>"


class StageCounts:
    """Counts of the rows that pass named places of a plan, known when the plan has run once (to a writer, say).

    Put `at` below any number of stages and write the result: one job gives all counts. A place keeps filters above it
    from being pushed below it, so it belongs behind the filters that should reach the scan. A plan that runs again
    (another action) is not counted again; a failed run leaves no counts.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def at(self, stage: str, df: DataFrame, **more: Column) -> DataFrame:
        """df, whose rows are counted as `rows` when it runs; more: further aggregates to take on the way."""
        if stage in self._seen:
            raise ValueError(f"stage {stage!r} is counted already")
        self._seen[stage] = Observation()
        return df.observe(self._seen[stage], F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in more.items()])

    def values(self) -> dict[str, dict]:
        """stage -> its aggregates. Waits until the plan has run."""
        return {k: o.get for k, o in self._seen.items()}

    def rows(self) -> dict[str, int]:
        return {k: v["rows"] for k, v in self.values().items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """stage, rows: in the order of the places."""
        return spark.createDataFrame(list(self.rows().items()), "stage string, rows long")

    def metrics(self, spark: SparkSession, at: dt.datetime, **tags: object) -> DataFrame:
        """All numbers as metric rows, named <stage>_<aggregate>, with string tags."""
        label = {k: str(v) for k, v in tags.items()}
        data = [(f"{s}_{k}", at, float(v), label) for s, vals in self.values().items() for k, v in vals.items() if v is not None]
        return spark.createDataFrame(data, METRIC)


def write_counted(frames: dict[str, DataFrame], write) -> dict[str, int]:
    """Writes each named frame by write(name, df) and returns the rows of each, counted by the writing job itself."""
    counts = StageCounts()
    for name, df in frames.items():
        write(name, counts.at(name, df))
    return counts.rows()


def _progress_values(p) -> dict[str, float]:
    """The numbers of one progress event. Watermark and lag only from the moment that there is a watermark."""
    out = {
        "input_rows": float(p.numInputRows), "input_rows_per_second": float(p.inputRowsPerSecond or 0.0), "processed_rows_per_second": float(p.processedRowsPerSecond or 0.0),
        "batch_duration_ms": float(p.batchDuration), "state_rows": float(sum(s.numRowsTotal for s in p.stateOperators)), "state_rows_dropped_late": float(sum(s.numRowsDroppedByWatermark for s in p.stateOperators)),
        "state_memory_bytes": float(sum(s.memoryUsedBytes for s in p.stateOperators)),
    }
    times = {k: dt.datetime.fromisoformat(v.replace("Z", "+00:00")).timestamp() for k, v in (p.eventTime or {}).items() if k in ("max", "watermark")}
    if times.get("watermark", 0) > 0:
        out["watermark_seconds"] = times["watermark"]
        if "max" in times:
            out["watermark_lag_seconds"] = times["max"] - times["watermark"]
    return {k: v for k, v in out.items() if v == v and abs(v) != float("inf")}


class StreamMetrics(StreamingQueryListener):
    """Turns the progress of all streaming queries into metric rows: rate, batch latency, watermark lag, state.

        metrics = StreamMetrics(); spark.streams.addListener(metrics)

    Rows wait in memory, at most `most` of them, the oldest going first, until drain() hands them out (put them in the
    metrics table by metric_name, timestamp and tags). Tags: query, run, batch.
    """

    def __init__(self, most: int = 100_000) -> None:
        self._rows: deque = deque(maxlen=most)
        self._lock, self._ended, self._names = threading.Lock(), {}, {}

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        tags = {"query": p.name or str(p.id), "run": str(p.runId), "batch": str(p.batchId)}
        with self._lock:
            self._rows.extend((k, at, v, tags) for k, v in _progress_values(p).items())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 30.0) -> bool:
        """Whether all events of an ended query have come in; they follow its end by a little."""
        return self._end(str(query.runId)).wait(seconds)

    def drain(self, spark: SparkSession) -> DataFrame:
        """The metric rows since the last call."""
        with self._lock:
            rows, _ = list(self._rows), self._rows.clear()
        return spark.createDataFrame(rows, METRIC)
