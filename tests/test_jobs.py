"""Page extraction, sources and streams on small fixtures."""

import gzip
import json

import pandas as pd
from pyspark.sql import functions as F

from courtlake.operators import fragments, summaries
from courtlake.sources import files
from courtlake.streaming import streams


def extract(spark, body, rest=""):
    page = spark.createDataFrame([("j", f'<div id="divJudgement"><content><div>{body}</div></content></div>{rest}')], "id string, html string")
    f, e = fragments.extract(page, "now")
    return f.orderBy("ordinal").collect(), e.first()


def test_attachment_and_headings(spark):
    f, _ = extract(spark, '<p class="Judg-1">1&nbsp;One<table><tr><td>A<td>B</table></p>')
    assert "A | B" in f[0].content_text or len(f) == 1
    f, _ = extract(spark, '<div class="Judg-1">1&nbsp;One</div><table><tr><td>A</td></tr></table><div class="Judg-1">2&nbsp;Two</div>')
    assert [x.has_table for x in f] == [1, 0] and f[0].paragraph_number == 1
    f, _ = extract(spark, '<table><tr><td>A</td></tr></table><div class="Judg-1">1&nbsp;One</div>')
    assert f[0].has_table == 1 and f[0].content_text.startswith("One\n\n---table---")
    f, _ = extract(spark, '<div class="Judg-1">1&nbsp;One</div><img src="a.png" alt="x"><div class="Judg-1">2&nbsp;Two</div>')
    assert f[0].figure_src == ["a.png"] and f[0].figure_descriptions == ["x"] and f[1].figure_src is None
    f, _ = extract(spark, '<p class="Judg-Heading-1">How it came about</p><p class="Judg-1">1 a</p><p class="Judg-Heading-1"></p><p class="Judg-2">b</p><p class="Judg-Heading-2">On the lease</p><p class="Judg-1">2 c</p><p class="Judg-EOF">x</p>')
    assert [x.section_heading for x in f] == [None, "How it came about", None, "How it came about", None, "On the lease"]
    assert [x.id for x in f] == [f"j_{i:04d}" for i in range(6)]


def test_footnotes_summary_and_empty_pages(spark):
    f, e = extract(spark, '<p class="Judg-1">1 a<sup><a href="#fn1">1</a></sup><sup><button data-target="#fn-x">2</button></sup><sup><a href="#fn1">1</a></sup><sup>3</sup></p>', '<div id="fn1">one&nbsp;1</div><div id="fn-x">two</div><div id="divCaseSummary">Sum</div>')
    assert f[0].footnote_text == ["one 1", "two"] and e.court_summary == "Sum" and e.has_court_summary == 1
    page = spark.createDataFrame([("j", "<p>nothing</p>"), ("k", None)], "id string, html string")
    _, e = fragments.extract(page, "now")
    assert {(r.id, r.content_text, r.has_content, r.extraction_status) for r in e.collect()} == {(i, "", 0, "empty: container missing") for i in "jk"}


def test_partitioning_does_not_matter(spark):
    body = "".join(f'<p class="Judg-{1 + i % 3}">{i} t{i}</p><img src="{i}.png">' for i in range(40))
    page = spark.createDataFrame([(f"j{k}", f'<div id="divJudgement">{body}</div>') for k in range(6)], "id string, html string")
    one, eight = (fragments.json_columns(fragments.extract(page.repartition(n), "now")[0]).toPandas().sort_values("id").reset_index(drop=True) for n in (1, 8))
    pd.testing.assert_frame_equal(one, eight)


def test_sources(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.html.gz").write_bytes(gzip.compress(b"<p>x</p>"))
    (pages / "b.html.gz").write_bytes(b"not gzip")
    assert [(r.id, r.html) for r in files.read_page_archive(spark, str(pages)).collect()] == [("a", "<p>x</p>")]
    cache = tmp_path / "cache"
    cache.mkdir()
    (cache / "a.json").write_text(json.dumps({"judgment_id": "a", "summary": "s", "frags_total": 3}, indent=1))
    (cache / "b.json").write_text('{"judgment_id": "b", "summ')
    good, bad = files.split_corrupt(files.read_summaries(spark, str(cache)))
    assert [r.judgment_id for r in good.collect()] == ["a"] and [r.file_name for r in bad.collect()] == ["b.json"]
    ledger = tmp_path / "ledger.json"
    ledger.write_text(json.dumps({"failures": {"a": {"count": 2, "last_error": "e", "last_attempt": "t"}}}))
    assert [tuple(r) for r in files.read_ledger(spark, str(ledger)).collect()] == [("a", 2, "e", "t")]
    ledger.write_text("nonsense")
    assert files.read_ledger(spark, str(ledger)).count() == 0
    report = tmp_path / "r"
    report.mkdir()
    (report / "b1.json").write_text(json.dumps({"status": "success", "resources": [{"name": "judgments", "status": "success", "records": 2, "extra_counts": {"extracted": 5}}]}))
    row = files.read_build_reports(spark, str(report)).first()
    assert (row.build, row.name, row.extra_counts) == ("b1", "judgments", {"extracted": 5})


def test_written_tables_read_back(spark, tmp_path):
    c = spark.createDataFrame([("a", "SGHC"), ("b", "SGDC")], "id string, court string")
    files.write_catalog(c, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).filter("court = 'SGDC'").count() == 1


def test_stream_extract_is_idempotent(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    page = spark.createDataFrame([("j", '<div id="divJudgement"><p class="Judg-1">1 a</p></div>')], "id string, html string")
    for _ in range(2):
        page.write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("id string, html string").parquet(str(source))
        streams.stream_extract(stream, "now", target, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(target).count() == 1


def test_rolling_fold_ends(spark):
    rows = [("a", k, t, 5) for k, t in enumerate(["x", "y", ""])] + [("b", 0, "", 5)]
    df = spark.createDataFrame(rows, "id string, batch int, input_text string, max_chars int")
    got = summaries.rolling_fold(df, lambda s, b, n: s + b * 4 if b else "", lambda s, n: s[:n])
    assert {tuple(r) for r in got.collect()} == {("a", "xxxxy", "ok"), ("b", "", "error: empty first answer")}


def test_select_summary_input(spark):
    f = [("j", 0, "Judg-Heading-1", None, "Head"), ("j", 1, "Judg-1", 1, "one"), ("j", 2, "Judg-Quote-1", None, "q" * 51), ("j", 3, "Judg-Quote-1", None, "r" * 10)] + [("j", 3 + k, "Judg-1", k + 0, f"p{k}") for k in range(2, 6)]
    frag = spark.createDataFrame([(*x, 0, 0, None) for x in f], "judgment_id string, ordinal int, class_name string, paragraph_number int, content_text string, has_footnotes int, has_table int, section_heading string")
    j = spark.createDataFrame([("j", "body", " view "), ("k", " only body ", None)], "id string, content_text string, court_summary string")
    out = {r.judgment_id: r.input_text for r in summaries.select_summary_input(j, frag, 100).collect()}
    assert out["k"] == "only body"
    assert out["j"] == "## Court Summary\nview\n\n## Head\n\n[1] one\n\n" + "r" * 10 + "\n\n[3] p3\n\n[4] p4\n\n[5] p5"


def test_stream_ledger(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("a", 1, False), ("a", 2, False), ("b", 1, False), ("b", 2, True), ("c", 1, True)]
    df = spark.createDataFrame(rows, "id string, seq int, ok boolean").withColumns({"ts": F.timestamp_seconds("seq"), "error": F.lit("e")})
    df.write.parquet(source)
    got = []
    stream = streams.stream_ledger(spark.readStream.schema(df.schema).parquet(source))
    stream.writeStream.outputMode("update").foreachBatch(lambda b, _: got.extend(b.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert {(r.id, r["count"], r.tier) for r in got} == {("a", 2, "primary"), ("b", 0, "primary"), ("c", 0, "primary")}
