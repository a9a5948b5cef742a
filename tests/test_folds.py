"""Folds by chunks against plain loops, at cuts in every place."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from courtlake.operators import catalog, folds, ledger

START = datetime(2026, 1, 1)


def trips(flags, n):
    count = found = 0
    for ok in flags:
        count = 0 if ok else count + 1
        if count == n:
            found, count = found + 1, 0
    return found


@pytest.mark.parametrize("chunks", [1, 3, 16, 50])
def test_breaker_trips_equal_a_loop(spark, chunks):
    rng = random.Random(chunks)
    rows, want = [], {}
    for run, size, share in (("a", 700, 0.2), ("b", 60, 0.9), ("c", 40, 0.0), ("d", 1, 1.0), ("e", 300, 0.02)):
        for phase in (2, 3):
            flags = [rng.random() < share for _ in range(size)]
            rows += [(run, phase, START + timedelta(seconds=i // 3), i, ok) for i, ok in enumerate(flags)]
            want[run, phase] = (trips(flags, 5), sum(flags), size)
    rng.shuffle(rows)
    got = ledger.breaker_trips(spark.createDataFrame(rows, "run_id string, phase int, ts timestamp, seq long, ok boolean"), 5, chunks=chunks)
    assert {(r.run_id, r.phase): (r.trips, r.successes, r.attempts) for r in got.collect()} == want


def test_one_run_fills_all_chunks(spark):
    rows = spark.range(200_000).select(F.lit("r").alias("run_id"), F.lit(2).alias("phase"), F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq"), (F.col("id") % 11 == 0).alias("ok"))
    (r,) = ledger.breaker_trips(rows, 5, chunks=8).collect()
    assert (r.trips, r.successes, r.attempts) == (200_000 // 11 * 2 + trips([i % 11 == 0 for i in range(200_000 // 11 * 11, 200_000)], 5), -(-200_000 // 11), 200_000)
    dealt = rows.repartitionByRange(8, "run_id", "phase", "ts", "seq").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(dealt) == 8 and max(d["count"] for d in dealt) < 50_000


def test_no_attempts(spark):
    assert ledger.breaker_trips(spark.createDataFrame([], "run_id string, phase int, ts timestamp, seq long, ok boolean")).collect() == []


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_scan_before_equals_a_loop(spark, size):
    rng = random.Random(size)
    rows = [(k, i, rng.choice((None, 1, 2, 5)), rng.choice((None, rng.randrange(100)))) for k in ("x", "y") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, i long, a long, b long")
    got = folds.scan_before(df, ["k"], "i", F.floor(F.col("i") / size), s=("sum", F.col("a")), m=("max", F.col("b")))
    for r in got.collect():
        before = [x for x in rows if x[0] == r.k and x[1] < r.i]
        assert r.s == sum(x[2] or 0 for x in before) and r.m == max((x[3] for x in before if x[3] is not None), default=None)


@pytest.mark.parametrize("pages", [1, 2, 1000])
def test_early_stop_by_chunks_of_pages(spark, monkeypatch, pages):
    monkeypatch.setattr(catalog, "PAGES", pages)
    rng = random.Random(pages)
    rows, known = [], {f"i{i}" for i in range(0, 400) if rng.random() < 0.7}
    for run in ("p", "q", "r"):
        rows += [(run, i // 4, i % 4, f"i{rng.randrange(400)}") for i in range(120)]
    got = catalog.stop_after_known_run(spark.createDataFrame(rows, "run_id string, page long, pos int, id string"), spark.createDataFrame([(i,) for i in known], "id string"), 4)
    want = set()
    for run in ("p", "q", "r"):
        seen, count = set(), 0
        for _, page, pos, i in (x for x in rows if x[0] == run):
            flag = i in known or i in seen
            seen.add(i)
            want.add((run, page, pos, i, flag))
            count = count + 1 if flag else 0
            if count == 4:
                break
    assert {(r.run_id, r.page, r.pos, r.id, r.known) for r in got.collect()} == want
