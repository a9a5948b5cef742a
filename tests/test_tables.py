"""Bucketed tables without shuffles, counts taken by a write, and folds that go on where they stopped."""

import pytest
from pyspark.sql import functions as F

from courtlake.operators import catalog, summaries
from courtlake.sources import bucketed


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_and_windows_by_judgment_need_no_exchange(spark, tmp_path):
    f = spark.range(400).select(F.format_string("j%d", F.col("id") % 40).alias("judgment_id"), (F.col("id") / 40).cast("int").alias("ordinal"), F.lit("Judg-1").alias("class_name"),
                                F.lit(None).cast("int").alias("paragraph_number"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("content_text"))
    c = spark.range(0, 40, 2).select(F.format_string("j%d", "id").alias("id"))
    held = bucketed.write_bucketed_fragments(f, "t_fragments", f"{tmp_path}/f", 4)
    listed = bucketed.write_bucketed_catalog(c, "t_catalog", f"{tmp_path}/c", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        chosen = catalog.fragments_of(listed, held)
        batched = summaries.batch_fragments(chosen)
        assert "Exchange" not in plan(chosen) and "Exchange" not in plan(batched)
        want = summaries.batch_fragments(catalog.fragments_of(c, f))
        assert "Exchange" in plan(want)
        assert sorted(map(tuple, batched.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP TABLE t_fragments")
        spark.sql("DROP TABLE t_catalog")


def test_a_write_counts_what_it_adds_and_ignores(spark, tmp_path):
    at = f"{tmp_path}/t"
    rows = lambda ids: spark.createDataFrame([(i, k) for k, i in enumerate(ids)], "id string, n int")
    rows("abc").write.parquet(at)
    assert bucketed.insert_counted(spark, at, rows("cdede"), "n") == {"added": 2, "ignored": 3}
    assert sorted((r.id, r.n) for r in spark.read.parquet(at).collect()) == [("a", 0), ("b", 1), ("c", 2), ("d", 1), ("e", 2)]
    assert bucketed.insert_counted(spark, at, rows("cdede"), "n") == {"added": 0, "ignored": 5}
    assert bucketed.insert_counted(spark, at, rows(""), "n") == {"added": 0, "ignored": 0}


def test_a_fold_goes_on_where_it_stopped(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    data = [(i, b, f"{i}{b}", 5) for i in ("x", "y", "z") for b in range(4) if not (i == "z" and b > 1)] + [("none", 0, "empty", 5), ("stop", 0, "s0", 5), ("stop", 1, "empty", 5), ("stop", 2, "s2", 5)]
    batches = spark.createDataFrame(data, "id string, batch int, input_text string, max_chars int")
    log = str(calls)

    def model(fail):
        def answer(summary, part, limit):
            import uuid

            if fail and part == "y2":
                raise RuntimeError("lost")
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write(part)
            return "" if part == "empty" else f"{summary}.{part}".strip(".")

        return answer

    shorten = lambda text, limit: text[:limit] + "!"
    with pytest.raises(Exception, match="lost"):
        summaries.stored_fold(batches, model(True), f"{tmp_path}/state", shorten)
    early = [p.read_text() for p in calls.iterdir() if p.read_text()[-1] in "01"]
    got = {r.id: (r.draft, r.status) for r in summaries.stored_fold(batches, model(False), f"{tmp_path}/state", shorten).collect()}
    assert got == {"x": ("x0.x1!", "ok"), "y": ("y0.y1!", "ok"), "z": ("z0.z1", "ok"), "none": ("", "error: empty first answer"), "stop": ("s0", "ok")}
    made = [p.read_text() for p in calls.iterdir()]
    assert sorted(x for x in made if x[-1] in "01") == sorted(early) == ["s0", "x0", "x1", "y0", "y1", "z0", "z1"] and "s2" not in made
    before = len(made)
    again = summaries.stored_fold(batches, model(False), f"{tmp_path}/state", shorten)
    assert {r.id: (r.draft, r.status) for r in again.collect()} == got and len(list(calls.iterdir())) == before
    want = {r.id: (r.draft, r.status) for r in summaries.rolling_fold(batches, model(False), shorten).collect()}
    assert want == got
    none = summaries.stored_fold(batches.limit(0), model(False), f"{tmp_path}/none")
    assert none.collect() == []


def test_pages_are_parsed_once(spark):
    from courtlake.plans import judgments

    count = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas")
    pages = judgments.detail_html(spark, "/root/testdata/sf0.001").limit(20)
    lazy, _ = judgments.fragments.extract(pages, "now")
    assert count(lazy) == 1
    once, columns = judgments.fragments.extract(pages, "now", once=True)
    assert count(once) == count(columns) == 0


def test_a_judgment_of_many_fragments(spark):
    """Headings, ends and best paragraphs of 50,000 fragments against a loop."""
    n, limit = 50_000, 20_000
    i = F.col("id")
    f = spark.range(n).select(
        F.lit("j").alias("judgment_id"), i.cast("int").alias("ordinal"), F.when(i % 5000 == 0, "Judg-Heading-1").when(i % 3 == 0, "Judg-1").otherwise("Judg-2").alias("class_name"),
        F.when((i % 3 == 0) & (i % 5000 > 0), i.cast("int")).alias("paragraph_number"), F.concat(F.lit("text "), F.repeat(F.lit("x"), (i * 7919 % 97).cast("int"))).alias("content_text"),
        (i % 13 == 0).cast("int").alias("has_footnotes"), (i % 17 == 0).cast("int").alias("has_table"), F.lit(None).cast("string").alias("section_heading"),
    )
    j = spark.createDataFrame([("j", None, "Court"), ("empty", " body ", None)], "id string, content_text string, court_summary string")
    got = {r.judgment_id: r.input_text for r in summaries.select_summary_input(j, f, limit).collect()}
    rows = [(k, "text " + "x" * (k * 7919 % 97)) for k in range(n)]
    show = lambda k, t: f"## {t}" if k % 5000 == 0 else f"[{k}] {t}" if k % 3 == 0 else t
    shown = {k: show(k, t.strip()) for k, t in rows}
    numbered = [k for k in range(n) if k % 3 == 0 and k % 5000]
    kept = {k for k in range(n) if k % 5000 == 0} | {numbered[0], *numbered[-3:]}
    used = len("Court") + 2 + sum(len(shown[k]) + 2 for k in kept)
    worth = lambda k: 2.0 * (k % 13 == 0) + 0.5 * (k % 17 == 0) + 0.1 * len(rows[k][1]) / 100
    for k in sorted((k for k in range(n) if k % 3 and k not in kept), key=lambda k: (-worth(k), k)):
        if used + len(shown[k]) + 2 <= limit:
            used += len(shown[k]) + 2
            kept.add(k)
    assert got == {"j": "\n\n".join(["## Court Summary\nCourt", *(shown[k] for k in sorted(kept))])[:limit], "empty": "body"}
