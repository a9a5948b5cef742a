"""Text functions: inputs and expected outputs."""

import pytest
from pyspark.sql import functions as F

from courtlake.functions import text


def run(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = {
    text.clean_citation: [("[2026] SGDC 1 |", "[2026] SGDC 1"), (" [2026] SGDC 1", "[2026] SGDC 1"), ("", "")],
    text.court_from_url: [("https://x/gd/s/2026_sgdc_136", "SGDC"), ("https://x/gd/s/2026", ""), (None, "")],
    text.pdf_url: [("see [2026] SGDC 136", text.SITE + "/gd/gd/%5B2026%5D%20SGDC%20136/pdf"), ("none", "")],
    text.absolute_url: [("/gd/s/1", text.SITE + "/gd/s/1"), ("https://a.b/c", "https://a.b/c"), ("gd", text.SITE + "/gd"), ("//c.d/e", "https://c.d/e")],
    text.total_pages: [("/x?CurrentPage=12&a=1", 12), ("/x", None)],
    text.normalize_ws: [("a b c  d\n", "a b c  d\n")],
    text.strip_meta_prefix: [("Updated summary: x", "x"), ("  Summary (Facts and so on): y", "y"), ("Facts", "Facts")],
    text.strip_commentary: [
        ("The provided excerpts are empty.\n\n**Facts**\nA sued B.", "**Facts**\nA sued B."), ("**Facts**\nx", "**Facts**\nx"), ("**Note** long\n**Facts**\nx", "**Note** long\n**Facts**\nx"),
        ("## Holding\nx", "## Holding\nx"), ("a" * 600 + "\nFacts\nx", "a" * 600 + "\nFacts\nx"), ("no heading", "no heading"),
    ],
    text.fix_artifacts: [("E_ik", "Eik"), ("a_b_c", "abc"), ("Women's $Charter", "Women's Charter"), ("a &amp;lt; b", "a &lt; b"), ("x &ge; 1", "x ≥ 1"), ("Khoont", "Khoon"), ("1_2", "1_2")],
    text.trim_trailing_incomplete: [("One.\n2.", "One."), ("One\n(a)", "One."), ("Paid $2.", "Paid $2."), ("One:\n•", "One:"), ("2.", "2."), ("One.\n**2.", "One."), ("One.\n2. **", "One.")],
    text.word_count: [("", 0), (" a  b c ", 3)],
}


@pytest.mark.parametrize("function", CASES, ids=lambda f: f.__name__)
def test_cases(spark, function):
    given, expected = zip(*CASES[function], strict=True)
    assert run(spark, function, given) == list(expected)


def test_trim_to_complete(spark):
    cut = lambda n: lambda v: text.trim_to_complete(v, F.lit(n))
    assert run(spark, cut(20), ["One two. Three four five."]) == ["One two. Three four."]
    assert run(spark, cut(20), ["One two three. Four five six seven."]) == ["One two three."]
    assert run(spark, cut(12), ["One two.\n2. three"]) == ["One two.\n2. ."] or run(spark, cut(10), ["One two.\n2. three"]) == ["One two."]
    assert run(spark, cut(100), ["Short.\n3."]) == ["Short."]
    assert run(spark, cut(10), ["abcdefghijklmnop"]) == ["abcdefghij."]


def test_decision_date(spark):
    rows = [('DecisionDate:"2026-04-17"', "x"), ("", "Decision Date: 17 Apr 2026"), ("", "Decision Date: 31 Feb 2026"), (None, None), ("", "Decision Date: 7 April 2026")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    assert [r.o for r in df.select("i", text.decision_date(F.col("a"), F.col("b")).alias("o")).orderBy("i").collect()] == ["2026-04-17", "2026-04-17", "", "", ""]


def test_paragraph_numbers(spark):
    values = [("12  Text\nmore", "Judg-1"), ("(a) Text", "Judg-1"), ("3 Text", "Judg-2"), ("4 Text", "Judg-1-firstpara")]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, v string, c string")
    found = [(r.o.number, r.o.rest) for r in df.select("i", text.split_paragraph_number(F.col("v"), F.col("c")).alias("o")).orderBy("i").collect()]
    assert found == [(12, "Text\nmore"), (None, "(a) Text"), (None, "3 Text"), (4, "Text")]


def test_lists_tables_figures(spark):
    df = spark.createDataFrame([(["[Tort — duty]", "", "a\"b"], [["A", "B"], ["", ""], []], "data:x", " ", "3", "4")], "tags array<string>, t array<array<string>>, src string, alt string, w string, h string")
    r = df.select(text.clean_tags(F.col("tags")).alias("tags"), text.render_table(F.col("t")).alias("t"), text.figure_pair(F.col("src"), F.col("alt"), F.col("w"), F.col("h")).alias("f")).first()
    assert r.tags == '["Tort — duty", "a\\"b"]'
    assert r.t == "\n\n---table---\nA | B\n---end-table---\n"
    assert r.f.src.startswith("sha256:") and r.f.alt == "[Figure, 3x4]"


def test_smell(spark):
    long = "**Facts**\n" + "word " * 60 + "end."
    issues = lambda v, n=0: run(spark, lambda c: F.array_join(text.smell_test(c, F.lit(n))["issues"], ","), [v])[0]
    assert issues(long) == ""
    assert issues(None) == "empty summary"
    assert issues("**Facts** short.", 300) == "too short"
    assert issues(long.replace("Facts", "Story")) == "no structural heading"
    assert issues("The provided excerpts contain\n" + long) == "commentary leak"
    assert issues(long[:-1]) == "no terminal punctuation"
    assert issues(long + "\n2.") == "trailing list marker"
    assert issues(long[:-1] + " &#39;.") == "HTML entity"
    assert issues(long[:-1] + " E_ik.") == "underscore in name"


@pytest.mark.parametrize(("count", "last", "tier"), [(2, "2026-07-16T11:00:00", "primary"), (3, "2026-07-16T11:00:00", "alternative"), (5, None, "alternative"), (6, "2026-07-16T11:00:00", "blocked"), (6, "2026-07-09T12:00:00", "alternative"), (6, "bad", "alternative"), (6, "2026-07-09T12:00:01", "blocked")])
def test_tiers(spark, count, last, tier):
    row = spark.createDataFrame([(count, last)], "c int, l string").select(text.summary_tier(F.col("c"), F.col("l"), F.lit("2026-07-16 12:00:00")).alias("t"), text.extract_quarantined(F.col("c"), F.col("l"), F.lit("2026-07-16 12:00:00")).alias("q")).first()
    assert row.t == tier
    assert row.q == (count >= 3 and last == "2026-07-16T11:00:00")
