"""Stateful streaming operators: per-key velocity and movie state, and cumulative hour tables and top lists for foreachBatch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lakemill.functions.scalar import weighted
from lakemill.operators.rank import numbered
from lakemill.operators.rolling import velocity
from lakemill.sources.tables import KeyedTable
from lakemill.sources.views import upsert_by_key
from lakemill.streaming.windows import latest_by_hour


def velocity_stream(df: DataFrame, key: str, metric: str, ts: str = "event_time", idle: str = "2 hours", watermark: str = "10 minutes") -> DataFrame:
    """key, ts, metric, prev, velocity, acceleration of every row, against the key's row before it in the stream.

    velocity is (m - prev) / (prev + 1), acceleration its change; 0 at a key's first row. Rows of a micro-batch are
    taken in order of ts; a row older than the key's last one is measured against it all the same. Two numbers a key
    are held in state; a key whose last row lies `idle` behind the watermark is let go, and starts anew after that.
    """
    types = dict(df.dtypes)
    ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        prev, vel = state.get if state.exists else (None, None)
        last = 0
        for b in sorted_batches(batches, ts):
            out = []
            for t, m in zip(b[ts], b[metric]):
                v = 0.0 if prev is None or prev == -1 else (m - prev) / (prev + 1)
                out.append((k[0], t, m, prev, v, 0.0 if vel is None else v - vel))
                prev, vel = m, v
                last = max(last, t.value // 1_000_000)
            yield pd.DataFrame(out, columns=[key, ts, metric, "prev", "velocity", "acceleration"])
        state.update((prev, vel))
        state.setTimeoutTimestamp(max(last + ms, state.getCurrentWatermarkMs() + 1))

    out = f"{key} {types[key]}, {ts} timestamp, {metric} double, prev double, velocity double, acceleration double"
    src = df.select(key, F.col(ts).cast("timestamp").alias(ts), F.col(metric).cast("double").alias(metric)).where(F.col(metric).isNotNull()).withWatermark(ts, watermark)
    return src.groupBy(key).applyInPandasWithState(step, out, "prev double, velocity double", "append", GroupStateTimeout.EventTimeTimeout)


def sorted_batches(batches: Iterator[pd.DataFrame], ts: str) -> Iterator[pd.DataFrame]:
    """A key's rows of one micro-batch in order of time; they are gathered, so a micro-batch should bound them."""
    frames = [b for b in batches if len(b)]
    if frames:
        yield pd.concat(frames).sort_values(ts, kind="stable")


def use_disk_state(spark: SparkSession) -> None:
    """Streams that this session starts from now on keep their state in RocksDB, which keyed processors with timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _ms(duration: str) -> int:
    return int(pd.Timedelta(duration).total_seconds() * 1000)


def _reset_timer(handle: StatefulProcessorHandle, at_ms: int) -> None:
    """at_ms becomes the key's only timer."""
    old = list(handle.listTimers())
    if at_ms not in old:
        handle.registerTimer(at_ms)
    for t in old:
        if t != at_ms:
            handle.deleteTimer(t)


class _MovieState(StatefulProcessor):
    """Votes and time of a movie's latest rating; forgotten when the watermark has passed it by a lifetime."""

    def __init__(self, ts: str, life_ms: int, clock: str):
        self.ts, self.life_ms, self.clock = ts, life_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("latest", "votes long, seen long", self.life_ms if self.clock == "processing" else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        votes, seen = self.state.get() if self.state.exists() else (None, None)
        # rows of a micro-batch come before its timers: a life that has ended is closed here
        if self.clock == "event" and seen is not None and seen // 1000 + self.life_ms <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, votes, 0, seen, True)
            votes = seen = None
        before = votes
        for b in rows:
            # of equal times the larger count, whatever the order of the rows
            order = b.sort_values([self.ts, "vote_count"])
            if len(order):
                last = order.iloc[-1]
                found = (int(last[self.ts].value // 1000), int(last["vote_count"]))
                if seen is None or found >= (seen, votes if before is None else -1):
                    seen, votes = found
        self.state.update((votes, seen))
        if self.clock == "event":
            _reset_timer(self.handle, seen // 1000 + self.life_ms)
        yield self._row(key, votes, votes - (before if before is not None else votes), seen, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        votes, seen = self.state.get()
        self.state.clear()
        yield self._row(key, votes, 0, seen, True)

    @staticmethod
    def _row(key, votes, delta, seen, expired) -> pd.DataFrame:
        return pd.DataFrame({"movie_id": [key[0]], "last_vote_count": [votes], "vote_delta": [delta], "last_updated": [pd.Timestamp(seen, unit="us")], "expired": [expired]})

    def close(self) -> None:
        pass


def movie_state_stream(ratings: DataFrame, ts: str = "event_time", lifetime: str = "48 hours", watermark: str = "10 minutes", clock: str = "event") -> DataFrame:
    """movie_id, last_vote_count, vote_delta, last_updated, expired after each micro-batch (update mode): the incremental state.

    The state of a movie that has been silent for a lifetime goes, and a movie that comes again starts anew. By the event
    clock it goes when the watermark passes last_updated + lifetime, with a last row marked expired; by the processing
    clock it goes silently when no row came for so long; such a query always has a next batch, so it wants a processing
    time trigger, and an available-now one does not end. Rows stream through; none of a key's are gathered.
    """
    if clock not in ("event", "processing"):
        raise ValueError("clock is event or processing")
    use_disk_state(ratings.sparkSession)
    kind = dict(ratings.dtypes)["movie_id"]
    src = ratings.select("movie_id", F.col("vote_count").cast("long").alias("vote_count"), F.col(ts).cast("timestamp").alias(ts)).where("vote_count is not null").withWatermark(ts, watermark)
    out = f"movie_id {kind}, last_vote_count long, vote_delta long, last_updated timestamp, expired boolean"
    return src.groupBy("movie_id").transformWithStateInPandas(_MovieState(ts, _ms(lifetime), clock), out, "Update", "EventTime" if clock == "event" else "ProcessingTime")


HOUR_MS = 3_600_000


class _HourVelocity(StatefulProcessor):
    """The last state of each recent hour of a movie, in order, and the change of its rating from hour to hour.

    Each call of the store is a message to the JVM: hours are read by one and only changed ones are written.
    """

    def __init__(self, ts: str, life_ms: int):
        self.ts, self.life_ms = ts, life_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # hour -> time, votes, popularity, rating: the tuple's order is that of latest_by_hour
        self.hours = handle.getMapState("hours", "hour long", "seen long, votes long, popularity double, rating double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {k[0]: tuple(v) for k, v in self.hours.iterator()}
        end = timerValues.getCurrentWatermarkInMs() - self.life_ms - HOUR_MS  # rows of a micro-batch come before its timers
        known = {hour: row for hour, row in held.items() if hour > end}
        for hour in held.keys() - known.keys():
            self.hours.removeKey((hour,))
        changed = set()
        for b in rows:
            seen = b[self.ts].to_numpy("datetime64[us]").view("int64")
            for row in zip(seen.tolist(), b["vote_count"].tolist(), b["popularity"].tolist(), b["vote_average"].tolist()):
                hour = row[0] // (HOUR_MS * 1000) * HOUR_MS
                if hour not in known or row > known[hour]:
                    known[hour] = row
                    changed.add(hour)
        for hour in changed:
            self.hours.updateValue((hour,), known[hour])
        # the end of the first hour's life is the key's only timer
        old, at = (min(x) + HOUR_MS + self.life_ms if x else None for x in (held, known))
        if at != old:
            if at is not None:
                self.handle.registerTimer(at)
            if old is not None:
                self.handle.deleteTimer(old)
        order = sorted(known)
        # a changed hour also changes the velocity of the hour after it, late rows included
        out = [(order[i], known[order[i]], known[order[i - 1]][3] if i else None) for i in range(len(order)) if order[i] in changed or i and order[i - 1] in changed]
        yield pd.DataFrame(
            {
                "movie_id": [key[0]] * len(out), "hour": np.array([h for h, _, _ in out], "datetime64[ms]"), "vote_average": [r[3] for _, r, _ in out], "vote_count": [r[1] for _, r, _ in out],
                "popularity": [r[2] for _, r, _ in out], "rating_velocity": [0.0 if p is None or p == -1 else (r[3] - p) / (p + 1) for _, r, p in out], "last_updated": np.array([r[0] for _, r, _ in out], "datetime64[us]"),
            }
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = timerValues.getCurrentWatermarkInMs() - self.life_ms - HOUR_MS
        hours = [hour for (hour,) in self.hours.keys()]
        for hour in hours:
            if hour <= end:
                self.hours.removeKey((hour,))
        left = [hour for hour in hours if hour > end]
        if left:
            self.handle.registerTimer(min(left) + HOUR_MS + self.life_ms)
        return iter([])

    def close(self) -> None:
        pass


HOURLY = "hour timestamp, vote_average double, vote_count long, popularity double, rating_velocity double, last_updated timestamp"


def hourly_velocity_stream(ratings: DataFrame, ts: str = "event_time", lifetime: str = "48 hours", watermark: str = "10 minutes") -> DataFrame:
    """movie_id, hour, the hour's last state and rating_velocity, its change from the movie's hour before it (update mode).

    rating_velocity is (rating - before) / (before + 1), 0 for a movie's first hour, as `hourly_velocity` gives it for a
    batch. Rows of one hour in several micro-batches, and late ones within the watermark, are merged: the hour and the
    one after it are put out again. Put them in a table by (movie_id, hour): a later row replaces the one before. State
    is versioned with the micro-batch, so a batch that is run again gives the same rows. An hour is forgotten when the
    watermark is a lifetime behind its end; the hour after it then counts as the first. Rows without a rating are left out.
    """
    use_disk_state(ratings.sparkSession)
    kind = dict(ratings.dtypes)["movie_id"]
    src = ratings.select("movie_id", *[F.col(c).cast(t).alias(c) for c, t in (("vote_average", "double"), ("vote_count", "long"), ("popularity", "double"), (ts, "timestamp"))])
    src = src.where("movie_id is not null and vote_average is not null").na.fill(0, ["vote_count"]).na.fill(0.0, ["popularity"]).withWatermark(ts, watermark)
    return src.groupBy("movie_id").transformWithStateInPandas(_HourVelocity(ts, _ms(lifetime)), f"movie_id {kind}, {HOURLY}", "Update", "EventTime")


def hourly_velocity(hours: DataFrame, metric: str = "vote_average", out: str = "rating_velocity", change: str | None = None) -> DataFrame:
    """hours (movie_id, hour, metric) with the velocity of metric from each movie's hour before it, and its change if named."""
    df = velocity(hours, metric, ["movie_id"], ["hour"])
    df = df.withColumnsRenamed({f"{metric}_velocity": out} | ({f"{metric}_acceleration": change} if change else {}))
    return df.select(*hours.columns, out, *([change] if change else []))


def put_hour_state(batch: DataFrame, path: str) -> None:
    """Cumulative (movie, hour) state: the batch's rows compete with the stored ones, the later event stays.

    batch: movie_id, hour, vote_average, vote_count, popularity, last_updated. Only hours in the batch are rewritten.
    """
    spark = batch.sparkSession
    rows = batch.withColumn("date_hour", F.date_format("hour", "yyyyMMddHH"))
    from lakemill.sources.views import _exists

    if _exists(spark, path):
        old = spark.read.parquet(path).withColumn("date_hour", F.col("date_hour").cast("string")).join(rows.select("date_hour").distinct(), "date_hour", "left_semi")
        rows = rows.unionByName(old.select(*rows.columns))
    upsert_by_key(path, rows, ["movie_id", "hour"], "last_updated", ["date_hour"])


def hour_tables(spark: SparkSession, root: str) -> tuple[KeyedTable, KeyedTable]:
    """The tables of trending_topn_stream: the last state of each movie and hour, and the hours' lists, both by day."""
    return KeyedTable(spark, f"{root}/hours", ["day", "hour", "movie_id"], "last_updated", ["day"]), KeyedTable(spark, f"{root}/top", ["day", "hour", "rank"], "", ["day"])


def trending_topn_stream(ratings: DataFrame, root: str, checkpoint: str, n: int = 100, min_popularity: float = 10.0, min_votes: int = 10, ts: str = "event_time", name: str = "trending_topn", trigger: str | None = "30 seconds", vacuum_hours: float = 24.0) -> StreamingQuery:
    """The top n of each hour, kept while ratings arrive; hour_tables(spark, root)[1].read() is the list at any time.

    Each micro-batch competes with the stored state of its movies and hours, where the later event stays, however late
    it comes: there is no watermark. The lists of the days it touches are then ranked anew from the state and put in
    the place of the old ones in one commit, so a rank is never given twice and a movie that falls below the limits
    leaves. Both tables have the batch in their ledgers: one that is run again after the state was committed and
    before the lists were only makes the lists. Rows without a movie or a time are left out. Only the touched days'
    state is read; purge() of both tables ends their lives.
    """
    spark = ratings.sparkSession
    hours, top = hour_tables(spark, root)

    def put(batch: DataFrame, number: int) -> None:
        at = (name, number)
        if top.seen(at):
            return
        last = latest_by_hour(batch.where(F.col(ts).isNotNull()), ts, None)
        # the order of the columns is that of the comparison of equal times
        rows = last.select(F.to_date("hour").alias("day"), "hour", "movie_id", "vote_count", "popularity", "vote_average", "last_updated").persist()
        try:
            if rows.isEmpty():
                return
            days = hours.partitions(rows)
            hours.add(rows, {}, at)
            lists = hour_top_list(hours.read(only=days), n, min_popularity, min_votes)
            top.replace(lists.withColumn("day", F.to_date("hour")), days, at, known=True)
            if number % 100 == 99:
                hours.vacuum(vacuum_hours)
                top.vacuum(vacuum_hours)
        finally:
            rows.unpersist()

    w = ratings.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).queryName(name)
    return (w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)).start()


def hour_top_list(state: DataFrame, n: int = 100, min_popularity: float = 10.0, min_votes: int = 10) -> DataFrame:
    """The hours' lists ranked anew from cumulative state, so no rank is given twice."""
    df = state.where((F.col("popularity") >= min_popularity) & (F.col("vote_count") >= min_votes)).withColumn("trending_score", weighted((0.5, "popularity"), (0.5, "vote_count")))
    return numbered(df, ["hour"], [F.desc("trending_score"), F.col("movie_id")]).where(F.col("rank") <= n).select("hour", "rank", "movie_id", "trending_score")
