"""Folds over long ordered runs, cut into chunks that are summed up by themselves and then joined in order.

A chunk's summary is associative: two neighbouring chunks can be joined to the summary of both.  So one run of any length
is spread over all tasks, and only a row a chunk is put in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _failure_runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Of each key in a sorted chunk: place, rows, successes, leading and trailing failures, trips of the runs between."""
    names = ["run", "phase", "place", "rows", "passed", "lead", "trail", "inside"]
    table = pa.Table.from_batches(list(batches)) if batches else None
    if table is None or not table.num_rows:
        return
    key = np.concatenate([c.to_numpy(zero_copy_only=False) for c in table["key"].chunks])
    ok = np.concatenate([c.to_numpy(zero_copy_only=False) for c in table["ok"].chunks]).astype(bool)
    edges = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    out: list[tuple] = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        hits = np.flatnonzero(ok[a:b])
        gaps = np.diff(hits) - 1  # failures between two successes
        lead, trail = (int(hits[0]), int(b - a - 1 - hits[-1])) if len(hits) else (int(b - a), 0)
        out.append((int(a), int(b - a), len(hits), lead, trail, int((gaps // n).sum())))
    at = pa.array([r[0] for r in out])
    first = table.take(at)
    numbers = [pa.array([r[i] for r in out], pa.int64()) for i in range(1, 6)]
    columns = [first[c].combine_chunks() for c in ("run", "phase", "place")]
    yield pa.RecordBatch.from_arrays([*columns, *numbers], names)


def failure_runs(attempts: DataFrame, n: int, run: str = "run_id", chunks: int | None = None) -> DataFrame:
    """Trips of a breaker after n failures in a row: run, phase, trips, successes, attempts.

    Attempts are dealt by ranges of (run, phase, ts, seq), so a single run fills all chunks.  A chunk that holds a success sums
    up what lies between its first and last one; failures before and after meet those of the neighbouring chunks.
    """
    count = chunks or int(attempts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(run), F.col("phase"), F.col("ts"), F.col("seq")]
    key = F.xxhash64(F.col(run), F.col("phase"))
    place = F.struct(F.col("ts").alias("ts"), F.col("seq").cast("long").alias("seq"))
    rows = attempts.repartitionByRange(count, *order).sortWithinPartitions(*order)
    rows = rows.select(F.col(run).alias("run"), "phase", place.alias("place"), key.alias("key"), "ok")
    kinds = dict(rows.dtypes)
    schema = f"run {kinds['run']}, phase {kinds['phase']}, place {kinds['place']}, rows long, passed long, lead long, trail long, inside long"
    parts = rows.mapInArrow(lambda it: _failure_runs(it, n), schema)
    summary = F.array_sort(F.collect_list(F.struct("place", "rows", "passed", "lead", "trail", "inside")))
    start = F.struct(F.lit(0).cast("long").alias("trips"), F.lit(0).cast("long").alias("open"))

    def join(state: Column, part: Column) -> Column:
        broken = part["passed"] > 0
        closed = F.floor((state["open"] + part["lead"]) / n).cast("long") + part["inside"]
        return F.struct((state["trips"] + F.when(broken, closed).otherwise(0)).cast("long").alias("trips"), F.when(broken, part["trail"]).otherwise(state["open"] + part["lead"]).cast("long").alias("open"))

    joined = parts.groupBy("run", "phase").agg(summary.alias("parts"))
    folded = joined.withColumn("end", F.aggregate("parts", start, join))
    total = lambda name: F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p[name])
    trips = (F.col("end.trips") + F.floor(F.col("end.open") / n)).cast("long")
    return folded.select(F.col("run").alias(run), "phase", trips.alias("trips"), total("passed").alias("successes"), total("rows").alias("attempts"))


def scan_before(rows: DataFrame, keys: list[str], order: str, chunk: Column, **values: tuple[str, Column]) -> DataFrame:
    """Running sums and maxima of all earlier rows of a key, by chunks: each value is ("sum" or "max", column).

    `chunk` grows with `order`, and (keys, order) is unique.  A chunk's total is taken first; only totals are put in order over
    a whole key, and rows within their chunk.
    """
    with_chunk = rows.withColumn("_chunk", chunk)
    fold = {"sum": F.sum, "max": F.max}
    totals = with_chunk.groupBy(*keys, "_chunk").agg(*(fold[how](c).alias(f"_{name}") for name, (how, c) in values.items()))
    over = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_chunk", *(fold[how](f"_{name}").over(over).alias(f"_{name}") for name, (how, _) in values.items()))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = with_chunk.join(carried, [*keys, "_chunk"])
    both = {
        "sum": lambda name, c: F.coalesce(F.col(f"_{name}"), F.lit(0)) + F.coalesce(F.sum(c).over(inner), F.lit(0)),
        "max": lambda name, c: F.greatest(F.col(f"_{name}"), F.max(c).over(inner)),
    }
    return joined.select("*", *(both[how](name, c).alias(name) for name, (how, c) in values.items())).drop("_chunk", *(f"_{name}" for name in values))
