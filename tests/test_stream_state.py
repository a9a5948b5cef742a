"""Streams with watermarks: state that is given up, and timers of the ledger."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from courtlake.streaming import streams

START = datetime(2026, 3, 1)
SCHEMA = "id string, ts timestamp, seq long, ok boolean, error string"


def run_ledger(spark, tmp_path, batches, **limits):
    """Each batch of (id, day, ok) as a file; all changes in the order in which they came."""
    source = f"{tmp_path}/in"
    n = 0
    for rows in batches:
        data = []
        for i, day, ok in rows:
            data.append((i, START + timedelta(days=day), n, ok, None if ok else f"e{n}"))
            n += 1
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    found = []
    keep = lambda b, k: found.extend((k, r.id, r["count"], r.tier, r.at) for r in b.collect())
    ledger = streams.stream_ledger_timed(stream, **limits)
    ledger.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    return found


def last(found):
    return {i: (count, tier) for _, i, count, tier, _ in found}


def test_tiers_follow_counts_and_a_block_ends_after_a_week(spark, tmp_path):
    fail = lambda i, n, day=0.0: [(i, day + k / 100, False) for k in range(n)]
    found = run_ledger(spark, tmp_path, [
        fail("two", 2) + fail("three", 3) + fail("six", 6) + fail("again", 6) + fail("cured", 6),
        [("again", 5, False), ("cured", 5, True), ("clock", 6, True)],
        [("clock", 8, True)],  # a week after "six", not after "again"
        [("clock", 13, True)],
    ])
    assert last(x for x in found if x[0] == 0) == {"two": (2, "primary"), "three": (3, "alternative"), "six": (6, "blocked"), "again": (6, "blocked"), "cured": (6, "blocked")}
    assert last(found) == {"two": (2, "primary"), "three": (3, "alternative"), "six": (6, "alternative"), "again": (7, "alternative"), "cured": (0, "primary"), "clock": (0, "primary")}
    ended = {i: at for _, i, _, tier, at in found if tier == "alternative" and i in ("six", "again")}
    assert ended == {"six": START + timedelta(days=7.05), "again": START + timedelta(days=12)}
    assert not [x for x in found if x[1] == "cured" and x[3] == "alternative"]  # a success clears the timer


def test_a_new_attempt_before_the_end_keeps_the_block(spark, tmp_path):
    found = run_ledger(spark, tmp_path, [[("a", 0, False)] * 2, [("a", 2, False)], [("b", 4, True)]], alternative=1, hard=2, seconds=3 * 86_400)
    assert last(found)["a"] == (3, "blocked")
    assert last(run_ledger(spark, tmp_path / "more", [[("a", 0, False)] * 2, [("a", 2, False)], [("b", 6, True)]], alternative=1, hard=2, seconds=3 * 86_400))["a"] == (3, "alternative")


@pytest.mark.parametrize("days", [12])
def test_state_is_given_up_behind_the_watermark(spark, tmp_path, days):
    source, rows = f"{tmp_path}/in", "event string, ts string, status string, model string"
    for day in range(days):
        at = lambda d, h: (START + timedelta(days=d, hours=h)).isoformat()
        data = [("attempt", at(day, h), "ok", "m") for h in range(24)] + ([("attempt", at(day - 5, 1), "late", "m")] * 3 if day > 6 else [])
        spark.createDataFrame(data, rows).coalesce(1).write.mode("append").parquet(source)
    log = spark.readStream.schema(rows).option("maxFilesPerTrigger", 1).parquet(source)
    query = streams.stream_progress(log, "1 hour", "1 day").writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out")
    query = query.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(sizes) <= 73 and sizes[-1] < max(sizes)  # about three days of hours, whatever the length of the stream
    out = spark.read.parquet(f"{tmp_path}/out")
    held = streams.open_windows(spark, f"{tmp_path}/state")
    assert out.filter("status = 'late'").count() == held.filter("status = 'late'").count() == 0
    total = lambda df: df.agg(F.coalesce(F.sum("attempts"), F.lit(0))).first()[0]
    assert total(out) + total(held) == days * 24 and out.join(held, ["start", "status", "model"]).count() == 0
