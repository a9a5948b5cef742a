"""Build health: counters of attempts, rollups of logs, anomalies of builds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtlake.operators.catalog import pipeline_state


def phase_counters(attempts: DataFrame) -> DataFrame:
    """Per run, results of both phases.  `attempts` has run_id, phase (2 or 3) and status."""
    of = lambda phase, status: F.count_if((F.col("phase") == phase) & (F.col("status") == status)).alias(f"{status}_{phase}")
    return attempts.groupBy("run_id").agg(*(of(2, s) for s in ("extracted", "empty", "failed", "quarantined")), *(of(3, s) for s in ("summarised", "cached", "failed", "quarantined")))


def phase_report(attempts: DataFrame, catalog: DataFrame) -> DataFrame:
    """A7 with the backlogs that the catalogue has left, one row of two numbers."""
    left = pipeline_state(catalog).select("extract_backlog", "summary_backlog")
    return phase_counters(attempts).crossJoin(F.broadcast(left))


def build_verdict(counters: DataFrame) -> DataFrame:
    """summarised = fresh + cached, notes, and blocked if an aborted build did nothing at all.

    `counters` has run_id, abort_reason, staged, extracted, empty, summarised, cached, extract_backlog, summary_backlog.
    """
    total = F.col("summarised") + F.col("cached")
    aborted = F.col("abort_reason").isNotNull()
    notes = F.concat_ws(
        "; ", F.when(aborted, F.concat(F.lit("discovery aborted ("), "abort_reason", F.lit(")"))), F.format_string("phase2 +%d extracted (%d backlog)", "extracted", "extract_backlog"),
        F.format_string("phase3 +%d summarised (%d backlog)", total, F.col("summary_backlog")),
    )
    return counters.select("run_id", "extracted", total.alias("summarised"), "extract_backlog", "summary_backlog", notes.alias("notes"), (aborted & (F.col("staged") == 0) & (F.col("extracted") + F.col("empty") + total == 0)).alias("blocked"))


def summary_footer(reports: DataFrame) -> DataFrame:
    """Per build, resources by status and the key-wise totals of their counters."""
    states = reports.groupBy("build").agg(F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.sum("duration_s").alias("seconds"))
    totals = reports.select("build", F.explode("extra_counts").alias("key", "n")).groupBy("build", "key").agg(F.sum("n").alias("n"))
    folded = totals.groupBy("build").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "n")))).alias("counters"))
    return states.join(folded, "build", "left")


def progress_rollup(log: DataFrame) -> DataFrame:
    """A10: attempts by day, status, model, court and whether the alternative model ran."""
    return log.filter("event = 'attempt'").groupBy(F.substring("ts", 1, 10).alias("day"), "status", "model", "court", "alt").agg(F.count(F.lit(1)).alias("attempts"))


def token_rollup(log: DataFrame) -> DataFrame:
    """Tokens by day, endpoint, model and kind of call."""
    return log.groupBy(F.substring("ts", 1, 10).alias("day"), "endpoint", "model", "call_type").agg(F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.count(F.lit(1)).alias("calls"))


def build_anomalies(builds: DataFrame) -> DataFrame:
    """(day, anomaly) rows of daily builds (site, day, blocked, extracted, summarised, extract_backlog, summary_backlog, seconds)."""
    order = Window.partitionBy("site").orderBy("day")
    idle = (F.col("summarised") == 0) & (F.col("summary_backlog") > 0)
    last = lambda c, n: F.sum(c.cast("int")).over(order.rowsBetween(-(n - 1), 0)) == n
    week = order.rowsBetween(-7, 0)
    stuck = lambda c: (F.count(F.lit(1)).over(week) == 8) & (F.col(c) > 0) & (F.first(c).over(week) <= F.col(c))
    checks = {
        "blocked twice": last(F.col("blocked"), 2), "nothing extracted": (F.col("extracted") == 0) & (F.col("extract_backlog") > 0), "nothing summarised for three days": last(idle, 3),
        "extract backlog stuck": stuck("extract_backlog"), "summary backlog stuck": stuck("summary_backlog"), "longer than two hours": F.col("seconds") > 7200,
    }
    found = builds.select("site", "day", F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull()).alias("found"))
    return found.select("site", "day", F.explode("found").alias("anomaly"))


def advanced_pipeline(builds: DataFrame) -> DataFrame:
    """Whether a build did something, and whether a backlog fell since the one before."""
    order = Window.partitionBy("site").orderBy("day")
    fell = (F.lag("extract_backlog").over(order) > F.col("extract_backlog")) | (F.lag("summary_backlog").over(order) > F.col("summary_backlog"))
    return builds.select("site", "day", ((F.col("records") > 0) | (F.col("extracted") > 0) | (F.col("summarised") > 0)).alias("advanced"), F.coalesce(fell, F.lit(False)).alias("backlog_fell"))


def monitor(builds: DataFrame) -> DataFrame:
    """Q9: per build whether it advanced, whether a backlog fell, and its anomalies."""
    found = build_anomalies(builds).groupBy("site", "day").agg(F.array_sort(F.collect_set("anomaly")).alias("anomalies"))
    none = F.expr("cast(array() as array<string>)")
    return advanced_pipeline(builds).join(found, ["site", "day"], "left").withColumn("anomalies", F.coalesce("anomalies", none))


def build_report(builds: DataFrame, phases: DataFrame, verdicts: DataFrame, footers: DataFrame, progress: DataFrame, tokens: DataFrame, catalog: DataFrame) -> DataFrame:
    """Q9 whole: what a build did, what the monitor says of it, and where the catalogue stands.

    `builds` as for monitor(); phases (A7) and verdicts (A8) by run_id, footers (A9) by build, progress (A10) and tokens (A11)
    by day: all of them names of the day.  Logs are summed by day before they meet the few rows of builds; the state of the
    catalogue (A3, A4) is one row, the same for each build.
    """
    worked = progress.groupBy("day").agg(F.sum("attempts").alias("attempts"), F.coalesce(F.sum(F.when(F.col("alt"), F.col("attempts"))), F.lit(0)).alias("alternative_attempts"))
    paid = tokens.groupBy("day").agg(F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"), F.sum("calls").alias("calls"))
    said = verdicts.select(F.col("run_id").alias("day"), "notes", F.col("blocked").alias("did_nothing"))
    counts = phases.withColumnRenamed("run_id", "day")
    ends = footers.select(F.col("build").alias("day"), "succeeded", F.col("failed").alias("failed_resources"), "skipped")
    report = monitor(builds)
    for part in (counts, said, ends, worked, paid):
        report = report.join(part, "day", "left")
    return report.join(F.broadcast(pipeline_state(catalog)))
