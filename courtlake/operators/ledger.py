"""Failures by document: the ledger, its tiers, and runs of failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.functions import text
from courtlake.operators import folds


def ledger_from_attempts(attempts: DataFrame, longest_error: int = 500) -> DataFrame:
    """Failures since each document's last success: id, count, last_error, last_attempt.

    `attempts` has id, ts, seq (order among equal times), ok, error.  Two aggregates instead of a window: a document with a long history stays
    map-side combined.
    """
    place = F.struct("ts", "seq")
    success = attempts.filter("ok").groupBy("id").agg(F.max(place).alias("cleared"))
    left = attempts.filter("not ok").join(success, "id", "left").filter(F.col("cleared").isNull() | (place > F.col("cleared")))
    return left.groupBy("id").agg(F.count(F.lit(1)).alias("count"), F.substring(F.max_by("error", place), 1, longest_error).alias("last_error"), F.max("ts").alias("last_attempt"))


def exclude_quarantined(backlog: DataFrame, ledger: DataFrame, now, failures: int = 3, seconds: int = 86_400) -> DataFrame:
    """Without documents that failed often and lately."""
    blocked = ledger.filter(text.extract_quarantined(F.col("count"), F.col("last_attempt").cast("string"), F.lit(now), failures, seconds)).select("id")
    return backlog.join(blocked, "id", "left_anti")


def with_tier(backlog: DataFrame, ledger: DataFrame, now, alternative: int = 3, hard: int = 6, seconds: int = 604_800) -> DataFrame:
    """The tier of each document, and whether it goes first."""
    joined = backlog.join(ledger.select("id", F.col("count").alias("failures"), F.col("last_attempt").cast("string").alias("_last")), "id", "left")
    tier = text.summary_tier(F.col("failures"), F.col("_last"), F.lit(now), alternative, hard, seconds)
    return joined.withColumn("tier", tier).withColumn("priority", (F.coalesce("failures", F.lit(0)) >= alternative).cast("int")).drop("_last")


def breaker_trips(attempts: DataFrame, n: int = 5, run: str = "run_id", chunks: int | None = None) -> DataFrame:
    """Per run and phase, trips of a breaker after n failures in a row, successes and attempts.

    A success or a trip starts the count anew, so 2n failures in a row trip twice.  Runs are folded by chunks, so that a long one
    is not left to one task; `chunks` is the number of shuffle partitions if not given.
    """
    return folds.failure_runs(attempts, n, run, chunks)
