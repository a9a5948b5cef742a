"""Structured Streaming versions of the incremental jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from courtlake.functions import text
from courtlake.operators import catalog, fragments
from courtlake.operators.catalog import first_occurrence
from courtlake.sources.files import PROGRESS


def progress_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(PROGRESS).json(path)


def stream_progress(log: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Attempts by status and model in tumbling windows; later rows than the watermark are left out."""
    events = log.filter("event = 'attempt'").withColumn("at", F.try_to_timestamp("ts")).filter("at is not null")
    return events.withWatermark("at", late).groupBy(F.window("at", window), "status", "model").agg(F.count(F.lit(1)).alias("attempts")).select("window.start", "window.end", "status", "model", "attempts")


def stream_extract(pages: DataFrame, now: str, target: str, checkpoint: str, buckets: int = 64):
    """New pages (id, html) to fragments under `target`, a folder per bucket of judgments; a page that comes again adds
    nothing, nor does a batch that is repeated.  What is known is read before the batch is written: one stream may write to a
    target at a time.
    """

    def write(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        new, _ = fragments.extract(first_occurrence(batch), now)
        bucket = F.pmod(F.xxhash64("judgment_id"), F.lit(buckets)).cast("int")
        new = new.withColumn("bucket", bucket)
        # only the folders that hold a page of the batch are read; a batch is bounded by its trigger
        wanted = [r.bucket for r in batch.select(F.col("id").alias("judgment_id")).select(bucket.alias("bucket")).distinct().collect()]
        try:
            known = spark.read.parquet(target).filter(F.col("bucket").isin(wanted)).select("id")
        except AnalysisException as e:  # the first batch finds no table
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            known = spark.createDataFrame([], "id string")
        new.join(known, "id", "left_anti").write.mode("append").partitionBy("bucket").parquet(target)

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def stream_new_items(items: DataFrame, known: Callable[[], DataFrame], sink: Callable[[DataFrame], None], checkpoint: str):
    """Each id once, neither in the catalogue nor earlier in the stream.

    `known` gives the ids of the catalogue and of all that `sink` has written: the tables are the state, none is kept in memory.
    """

    def write(batch: DataFrame, _epoch: int) -> None:
        sink(catalog.first_occurrence(catalog.new_items(batch, known())))

    return items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


class LedgerState(StatefulProcessor):
    """Failures of one id since its last success."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", "count int, last_error string, last_attempt timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count, error, last = self.entry.get() if self.entry.exists() else (0, None, None)
        for row in pd.concat(rows).sort_values(["ts", "seq"]).itertuples():
            count, error, last = (0, None, None) if row.ok else (count + 1, row.error, row.ts)
        if count:
            self.entry.update((count, error, last))
        else:
            self.entry.clear()
        yield pd.DataFrame({"id": [key[0]], "count": [count], "last_error": [error], "last_attempt": [last]})

    def close(self) -> None:
        pass


def stream_ledger(attempts: DataFrame, now: Column | None = None, **tiers: int) -> DataFrame:
    """The ledger entry of every id that a batch touches (id, ts, seq, ok, error); use the RocksDB state store.

    The tier is F30's at `now`, the batch's own time if not given; its limits are arguments of summary_tier().
    """
    entries = attempts.groupBy("id").transformWithStateInPandas(
        statefulProcessor=LedgerState(), outputStructType="id string, count int, last_error string, last_attempt timestamp", outputMode="Update", timeMode="None"
    )
    at = F.current_timestamp() if now is None else now
    return entries.withColumn("tier", text.summary_tier(F.col("count"), F.col("last_attempt").cast("string"), at, **tiers))


class TimedLedgerState(StatefulProcessor):
    """Failures of one id since its last success, with a timer that ends a block."""

    def __init__(self, alternative: int, hard: int, seconds: int) -> None:
        self.alternative, self.hard, self.seconds = alternative, hard, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "count int, last_error string, last_ms long")

    def _row(self, key, tier: str, at: int, count: int = 0, error=None, last=None) -> pd.DataFrame:
        return pd.DataFrame({"id": [key[0]], "count": [count], "last_error": [error], "last_ms": pd.array([last], "Int64"), "tier": [tier], "at_ms": [at]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count, error, last = self.entry.get() if self.entry.exists() else (0, None, None)
        for row in pd.concat(rows).sort_values(["ts", "seq"]).itertuples():
            count, error, last, at = (0, None, None, row.ms) if row.ok else (count + 1, row.error, row.ms, row.ms)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not count:
            self.entry.clear()
            yield self._row(key, "primary", at)
            return
        self.entry.update((count, error, last))
        if count >= self.hard:
            self.handle.registerTimer(last + self.seconds * 1000)
        tier = "blocked" if count >= self.hard else "alternative" if count >= self.alternative else "primary"
        yield self._row(key, tier, at, count, error, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count, error, last = self.entry.get()
        yield self._row(key, "alternative", expiredTimerInfo.getExpiryTimeInMs(), count, error, last)

    def close(self) -> None:
        pass


def stream_ledger_timed(attempts: DataFrame, alternative: int = 3, hard: int = 6, seconds: int = 604_800, late: str = "0 seconds") -> DataFrame:
    """X4 with timers: changes of the ledger (id, count, last_error, last_attempt, tier, at); use the RocksDB state store.

    An id with `hard` failures since its last success is blocked.  When the watermark passes `seconds` after its last attempt it
    goes back to the alternative tier, also if nothing more is heard of it; a new attempt starts the time anew, and a success
    clears entry and timer.  Attempts (id, ts, seq, ok, error) older than the watermark by `late` are left out.
    """
    timed = attempts.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("ms", F.unix_millis("ts")).withWatermark("ts", late)
    found = timed.groupBy("id").transformWithStateInPandas(
        statefulProcessor=TimedLedgerState(alternative, hard, seconds), outputMode="Update", timeMode="EventTime",
        outputStructType="id string, count int, last_error string, last_ms long, tier string, at_ms long",
    )
    return found.select("id", "count", "last_error", F.timestamp_millis("last_ms").alias("last_attempt"), "tier", F.timestamp_millis("at_ms").alias("at"))


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that a stopped stream_progress() query still holds: start, status, model, attempts."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.window.start", "key.status", "key.model", F.col("value.count").alias("attempts"))
