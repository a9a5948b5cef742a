"""Stored tables: only touched buckets are written anew, repeated changes write nothing, pages open few files."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtlake.operators import catalog, stored

GOOD = "Facts\n" + " ".join(["word"] * 60) + "."
CACHE = "judgment_id string, generated_at string, model string, endpoint string, frags_total int, summary string"


def files(path):
    return {str(p) for p in Path(path).rglob("*.parquet")}


def catalogue(spark, path, rows):
    df = spark.createDataFrame([(i, None, "SGHC", 10, s, "old") for i, s in rows], "id string, citation string, court string, fragment_count int, summary string, summary_generated_at string")
    stored.store(df, path, buckets=8)


def cache(spark, path, ids):
    stored.store(spark.createDataFrame([(i, "old", "m", "e", 1, "s") for i in ids], CACHE), path, "judgment_id", buckets=8)


def test_audit_writes_back_only_what_it_changes(spark, tmp_path):
    at, held = f"{tmp_path}/catalog", f"{tmp_path}/cache"
    catalogue(spark, at, [(f"g{i}", GOOD) for i in range(100)] + [("fix", GOOD + "\n2."), ("bad", "short"), ("none", None), ("odd", GOOD.replace("word.", "&#9; end."))])
    cache(spark, held, ["fix", "bad", *(f"g{i}" for i in range(100))])
    before, cached = files(at), files(held)
    records = {r.id: (r.citation, r.court, r.fragment_count, r.word_count, r.action) for r in stored.write_back_audit(spark, at, held, buckets=8).collect()}
    assert records == {"fix": ("fix", "SGHC", 10, 62, "fixed"), "bad": ("bad", "SGHC", 10, 1, "nullified"), "odd": ("odd", "SGHC", 10, 62, "unfixed")}
    rows = {r.id: (r.summary, r.summary_generated_at) for r in stored.read(spark, at).collect()}
    assert rows["fix"] == (GOOD, "old") and rows["bad"] == (None, None) and rows["none"] == (None, "old") and len(rows) == 104
    assert {r.judgment_id for r in stored.read(spark, held).collect()} == {"fix", *(f"g{i}" for i in range(100))}
    touched = {os.path.dirname(p) for p in before - files(at)}
    assert 1 <= len(touched) <= 2 and len({os.path.dirname(p) for p in cached - files(held)}) == 1
    after = files(at), files(held)
    stored.write_back_audit(spark, at, held, buckets=8)
    assert (files(at), files(held)) == after


def test_summaries_are_written_back_with_their_source(spark, tmp_path):
    at, held = f"{tmp_path}/catalog", f"{tmp_path}/cache"
    catalogue(spark, at, [(x, None) for x in "abcdefgh"])
    cache(spark, held, ["b"])
    drafts = spark.createDataFrame([("a", GOOD, 10), ("b", "Summary so far: " + GOOD, 12), ("c", "short", 3), ("unknown", GOOD, 1)], "id string, draft string, n_fragments int")
    for _ in range(2):
        got = {r.id: (r.status, r.detail) for r in stored.write_back_summaries(spark, at, held, drafts, "now", "large", "url", buckets=8).collect()}
        names = files(at) | files(held)
    assert got["a"] == got["b"] == ("ok", f"{len(GOOD)} chars") and got["c"][0] == "error" and got["c"][1].startswith("smell_test: too short; no structural")
    stored.write_back_summaries(spark, at, held, drafts, "now", "large", "url", buckets=8)
    assert files(at) | files(held) == names
    assert {r.id: r.summary_generated_at for r in stored.read(spark, at).collect()} == {x: "now" if x in "ab" else "old" for x in "abcdefgh"}
    entries = {r.judgment_id: (r.generated_at, r.model, r.endpoint, r.frags_total, r.summary) for r in stored.read(spark, held).collect()}
    assert entries == {"a": ("now", "large", "url", 10, GOOD), "b": ("now", "large", "url", 12, GOOD), "unknown": ("now", "large", "url", 1, GOOD)}


def test_removing_all_rows_of_a_bucket_removes_its_folder(spark, tmp_path):
    at = f"{tmp_path}/t"
    stored.store(spark.range(40).select(F.col("id").cast("string").alias("id")), at, buckets=4)
    one = stored.read(spark, at).filter("bucket = 2").select("id")
    n = one.count()
    assert n and stored.remove(spark, at, one, buckets=4) == 1 and not Path(f"{at}/bucket=2").exists()
    assert stored.read(spark, at).count() == 40 - n and stored.remove(spark, at, one.limit(0), buckets=4) == 0


@pytest.mark.parametrize("size", [1, 10, 25])
def test_a_far_page_opens_the_file_that_holds_it(spark, tmp_path, size):
    i = F.col("id")
    rows = spark.range(2000).select(F.format_string("j%05d", (i * 7919) % 2000).alias("id"), F.when(i % 50 > 0, F.format_string("20%02d-01-%02d", i % 20, 1 + i % 9)).alias("decision_date"), i.alias("n"))
    stored.store_ordered(rows, str(tmp_path), files=10)
    order = [tuple(r) for r in rows.orderBy(F.desc_nulls_last("decision_date"), "id").collect()]
    for page in (1, 2, 1000 // size, 2000 // size, 2000 // size + 1):
        got = stored.ordered_page(spark, str(tmp_path), page, size)
        assert [tuple(r) for r in got.collect()] == order[(page - 1) * size:page * size]
        assert page > 2000 // size or len(got.inputFiles()) <= 2
    same = [r.id for r in catalog.catalog_page(rows.filter("decision_date is not null"), 3, size).collect()]
    assert [r.id for r in stored.ordered_page(spark, str(tmp_path), 3, size).collect()] == same
