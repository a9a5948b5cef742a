"""Audit actions, messages and routes, escaped markup, corrupt archives, replaced folders."""

import gzip

from pyspark.sql import functions as F

from courtlake.functions import html, text
from courtlake.operators import catalog, monitor, summaries
from courtlake.sources import files


def test_audit_actions(spark):
    good = "Facts\n" + " ".join(["word"] * 60) + "."
    rows = [("a", good), ("b", good[:-1]), ("c", ""), ("d", good + "\n2."), ("e", "short."), ("f", None), ("g", good[:-1] + " &copy; x_y."), ("h", good.replace("word.", "&#9; end."))]
    got = {r.id: (r.action, r.repaired) for r in summaries.audit(spark.createDataFrame([(*r, 10) for r in rows], "id string, summary string, fragment_count int")).collect()}
    assert got == {
        "b": ("nullified", None), "c": ("unfixed", None), "d": ("fixed", good), "e": ("nullified", None),
        "g": ("fixed", good[:-1] + " &copy; xy."), "h": ("unfixed", None),
    }


def test_message_and_route(spark):
    row = spark.range(1).select(
        text.message("Batch {n}: {text}", F.lit("Present case: A"), n=F.lit(2), text=F.lit("t")).alias("m"),
        text.route(F.lit("alternative"), ("small", "e1"), ("large", "e2")).alias("r"),
    ).first()
    assert row.m == "Present case: A\n\nBatch 2: t" and tuple(row.r) == ("large", "e2")


def test_markup_parses_to_the_same_tree():
    source = '<p title="a &quot;b&quot; &amp; c">1 x &lt;b&gt; &amp; y<br><b>z</b></p>'
    once = html.tree(source).children[0].markup()
    assert once == '<p title="a &quot;b&quot; &amp; c">1 x &lt;b&gt; &amp; y<br/><b>z</b></p>'
    assert html.tree(once).children[0].markup() == once


def test_deep_page():
    page = '<div id="divJudgement"><p class="Judg-1">' + "<span>" * 10_000 + "deep" + "</span>" * 10_000 + "</p></div>"
    event = html.page_events(page, "divJudgement", "divCaseSummary", "Judg-", "Judg-Heading-", ())["events"][0]
    assert event["text"] == "deep" and event["raw"].count("<span>") == 10_000


def test_corrupt_archive_files_are_reported(spark, tmp_path):
    (tmp_path / "a.html.gz").write_bytes(gzip.compress(b"<p>a</p>"))
    (tmp_path / "b.html.gz").write_bytes(b"broken bytes")
    assert [r.id for r in files.read_page_archive(spark, str(tmp_path)).collect()] == ["a"]
    assert [r.file_name for r in files.corrupt_archive_files(spark, str(tmp_path)).collect()] == ["b.html.gz"]


def test_replace_fragments_keeps_other_folders(spark, tmp_path):
    at = str(tmp_path / "f")
    rows = [(f"j{i}", k, f"t{k}") for i in range(40) for k in range(3)]
    f = spark.createDataFrame(rows, "judgment_id string, ordinal int, content_text string")
    files.replace_fragments(f, at)
    bucket = F.pmod(F.xxhash64("judgment_id"), F.lit(64)).cast("int")
    one = f.withColumn("b", bucket).filter(F.col("b") == f.select(bucket.alias("b")).first().b).drop("b").withColumn("content_text", F.lit("new"))
    files.replace_fragments(one, at)
    back = spark.read.parquet(at)
    assert back.count() == 120 and back.filter("content_text = 'new'").count() == one.count()


def test_first_writes_win(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "id string, v int")
    old = spark.createDataFrame([("b", 9)], "id string, v int")
    table, added = catalog.insert_or_ignore(old, new, "v")
    assert [tuple(r) for r in added.collect()] == [("a", 1)] and table.count() == 2
    both = catalog.append_new(old, new.filter("v = 2"), new)
    assert {tuple(r) for r in both.collect()} == {("b", 9), ("a", 2)}


def test_state_without_phase_columns(spark):
    c = spark.createDataFrame([("a",), ("b",)], "id string")
    row = catalog.pipeline_state(c).first()
    assert (row.total, row.enriched, row.extract_backlog, row.summary_backlog) == (2, 0, 0, 0)
    attempts = spark.createDataFrame([("r", 2, "extracted")], "run_id string, phase int, status string")
    assert monitor.phase_report(attempts, c).first().extract_backlog == 0


def test_early_stop_across_pages(spark):
    known = spark.createDataFrame([(i,) for i in range(6, 30)], "id int")
    rows = [("r", i // 3, i % 3, i) for i in range(30)] + [("s", i // 10, i % 10, 100 + i) for i in range(20)]
    items = spark.createDataFrame(rows, "run_id string, page int, pos int, id int")
    kept = catalog.stop_after_known_run(items, known, 5)
    assert sorted(r.id for r in kept.filter("run_id = 'r'").collect()) == list(range(11)) and kept.filter("run_id = 's'").count() == 20
