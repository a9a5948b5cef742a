"""Fragment, search and page-extraction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.operators import catalog, fragments, search
from courtlake.operators import enrich as enrichment
from courtlake.plans.registry import SQL_FRAGS, frags, query, table
from courtlake.sources.scratch import new_folder

NOW = "2026-07-16T12:00:00"


def _escaped(value):
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(sign), F.lit(name))
    return value


def detail_html(spark, sf_dir):
    """Detail pages built from document lines: a table before the first paragraph, an image after every 5th, footnotes."""
    f = frags(spark, sf_dir)
    o = F.col("ordinal")
    mark = F.when(o % 7 == 3, F.concat(F.lit("<sup><a href=\"#fn"), (o + 1).cast("string"), F.lit("\">"), F.lit("</a></sup>"))).otherwise("")
    number = F.when(F.col("paragraph_number").isNotNull(), F.concat(F.col("paragraph_number").cast("string"), F.lit("&#160;&#160;"))).otherwise("")
    element = F.concat(
        F.when(o == 1, F.lit("<table><tr><td>a</td><td>b</td></tr></table>")).otherwise(""), F.lit("<div><p class=\""), F.col("class_name"), F.lit("\">"), number, _escaped(F.col("content_text")), mark, F.lit("</p></div>"),
        F.when(o % 5 == 2, F.concat(F.lit("<img src=\"i"), o.cast("string"), F.lit(".png\" alt=\"\" width=\"3\" height=\"4\">"))).otherwise(""),
    )
    pages = f.groupBy("judgment_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", element.alias("e"), F.when(o % 7 == 3, F.concat(F.lit("<div id=\"fn"), (o + 1).cast("string"), F.lit("\"> note "), o.cast("string"), F.lit("</div>"))).otherwise("").alias("n")))).alias("es"))
    parts = lambda c: F.array_join(F.transform("es", lambda e: e[c]), "")
    summary = F.when(F.col("judgment_id").cast("long") % 2 == 0, F.concat(F.lit("<div id=\"divCaseSummary\"> Sum "), "judgment_id", F.lit("</div>"))).otherwise("")
    box = F.when(F.col("judgment_id").cast("long") % 10 == 9, F.lit("other")).otherwise("divJudgement")
    return pages.select(F.col("judgment_id").alias("id"), F.concat(F.lit("<html><body><div id=\""), box, F.lit("\">"), parts("e"), F.lit("<p class=\"Judg-EOF\">end</p></div>"), parts("n"), summary, F.lit("</body></html>")).alias("html"))


# text of a paragraph as the page gives it: outer white space gone; then what its attachments add
_BODY = """b AS (SELECT *, regexp_replace(regexp_replace(content_text, '^\\s+', ''), '\\s+$', '') AS t, max(ordinal) OVER (PARTITION BY judgment_id) AS last FROM frags WHERE doc_id % 10 <> 9),
x AS (SELECT judgment_id || '_' || CASE WHEN ordinal < 10000 THEN lpad(CAST(ordinal AS VARCHAR), 4, '0') ELSE CAST(ordinal AS VARCHAR) END AS id, judgment_id, doc_id, ordinal, class_name,
    CASE WHEN paragraph_number IS NOT NULL AND t <> '' THEN paragraph_number END AS paragraph_number,
    CASE WHEN ordinal % 5 <> 0 THEN last_value(CASE WHEN ordinal % 5 = 0 AND t <> '' THEN t END IGNORE NULLS) OVER (PARTITION BY judgment_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS section_heading,
    CASE WHEN paragraph_number IS NOT NULL AND t = '' THEN CAST(paragraph_number AS VARCHAR) ELSE t END
        || CASE WHEN ordinal = 1 THEN chr(10) || chr(10) || '---table---' || chr(10) || 'a | b' || chr(10) || '---end-table---' || chr(10) ELSE '' END
        || CASE WHEN ordinal % 5 = 2 THEN chr(10) || chr(10) || '[Figure, 3x4]' ELSE '' END AS content_text,
    CASE WHEN ordinal % 7 = 3 THEN 'note ' || ordinal END AS footnotes, has_footnotes, CAST(ordinal = 1 AS INTEGER) AS has_table, CAST(ordinal % 5 = 2 AS INTEGER) AS has_figure,
    CASE WHEN ordinal % 5 = 2 THEN 'i' || ordinal || '.png' END AS figures FROM b)"""


_RAW = """'<p class="' || class_name || '">' || coalesce(paragraph_number || chr(160) || chr(160), '') || replace(replace(replace(content_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
    || CASE WHEN ordinal % 7 = 3 THEN '<sup><a href="#fn' || (ordinal + 1) || '"></a></sup>' ELSE '' END || '</p>'"""


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, ordinal, {_RAW} AS html_raw FROM frags WHERE doc_id % 10 <> 9")
def fragments_html(spark, sf_dir):
    """H2: the markup of every fragment."""
    return fragments.extract(detail_html(spark, sf_dir), NOW)[0].select("judgment_id", "ordinal", "html_raw")


@query(f"WITH {SQL_FRAGS}, {_BODY} SELECT * EXCLUDE (doc_id) FROM x")
def extract_fragments(spark, sf_dir):
    """Q2: H2-H5, W1-W4, J3, F11-F16 on pages built from lines."""
    return shown_fragments(fragments.extract(detail_html(spark, sf_dir), NOW)[0])


def shown_fragments(f):
    """The columns that the query compares, lists as text."""
    joined = lambda c: F.array_join(c, ",").alias
    return f.select("id", "judgment_id", "ordinal", "class_name", "paragraph_number", "section_heading", "content_text", joined("footnote_text")("footnotes"), "has_footnotes", "has_table", "has_figure", joined("figure_src")("figures"))


@query(f"""WITH {SQL_FRAGS}, {_BODY},
c AS (SELECT judgment_id, string_agg(CASE WHEN content_text <> '' THEN CASE WHEN paragraph_number IS NULL THEN content_text ELSE paragraph_number || ' ' || content_text END END, chr(10) || chr(10) ORDER BY ordinal) AS t, count(*) AS n FROM x GROUP BY judgment_id)
SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(t, '') AS content_text, CASE WHEN doc_id % 2 = 0 AND doc_id % 10 <> 9 THEN 'Sum ' || doc_id ELSE '' END AS court_summary, CAST(coalesce(t, '') <> '' AS INTEGER) AS has_content,
    CAST(doc_id % 2 = 0 AND doc_id % 10 <> 9 AS INTEGER) AS has_court_summary, CAST(coalesce(n, 0) AS INTEGER) AS fragment_count, '{NOW}' AS extracted_at, CASE WHEN doc_id % 10 = 9 THEN 'empty: container missing' ELSE 'ok' END AS extraction_status
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN c ON c.judgment_id = CAST(d.doc_id AS VARCHAR)""")
def enriched_pages(spark, sf_dir):
    """Q2: A6, P7, P8."""
    return fragments.extract(detail_html(spark, sf_dir), NOW, once=True)[1]


@query(f"""WITH {SQL_FRAGS}, {_BODY},
c AS (SELECT judgment_id, string_agg(CASE WHEN content_text <> '' THEN CASE WHEN paragraph_number IS NULL THEN content_text ELSE paragraph_number || ' ' || content_text END END, chr(10) || chr(10) ORDER BY ordinal) AS t FROM x GROUP BY judgment_id)
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 4 = 0 THEN 'old' WHEN doc_id % 7 = 1 THEN NULL WHEN doc_id % 5 = 2 THEN 'cached ' || doc_id WHEN doc_id % 11 = 3 THEN NULL ELSE coalesce(t, '') END AS content_text,
    CASE WHEN doc_id % 4 = 0 OR doc_id % 7 = 1 THEN NULL WHEN doc_id % 5 = 2 THEN 1 WHEN doc_id % 11 = 3 THEN NULL ELSE CAST(coalesce(t, '') <> '' AS INTEGER) END AS has_content
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN c ON c.judgment_id = CAST(d.doc_id AS VARCHAR)""")
def enrich(spark, sf_dir):
    """Q3: P3, J4, J5, Q2, J8: every 7th quarantined, every 5th cached, every 11th not archived."""
    i = F.col("doc_id")
    ids = table(spark, sf_dir, "documents").select(i, i.cast("string").alias("id")).distinct()
    known = ids.select("doc_id", "id", F.when(i % 4 == 0, "old").alias("content_text"), F.lit("2020-01-01").alias("decision_date"))
    failures = ids.filter("doc_id % 7 = 1").select("id", F.lit(3).alias("count"), F.lit(NOW).alias("last_attempt"))
    cached = ids.filter("doc_id % 5 = 2").select(
        "id", F.concat(F.lit("cached "), "id").alias("content_text"), F.lit("").alias("court_summary"), F.lit(1).alias("has_content"),
        F.lit(0).alias("has_court_summary"), F.lit(0).alias("fragment_count"), F.lit(NOW).alias("extracted_at"))
    archive = detail_html(spark, sf_dir).filter("cast(id as long) % 11 <> 3")
    return enrichment.enrich(known, failures, cached, archive, NOW)[0].select("id", "content_text", "has_content")


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, ordinal AS seq, CAST(row_number() OVER (PARTITION BY judgment_id ORDER BY ordinal) - 1 AS INTEGER) AS ordinal, judgment_id || '_' || lpad(CAST(row_number() OVER (PARTITION BY judgment_id ORDER BY ordinal) - 1 AS VARCHAR), 4, '0') AS id FROM frags WHERE ordinal % 3 <> 1")
def assign_ordinals(spark, sf_dir):
    """W1."""
    return fragments.assign_ordinals(frags(spark, sf_dir).filter("ordinal % 3 <> 1").select("judgment_id", F.col("ordinal").alias("seq")))


@query(f"""WITH {SQL_FRAGS}, k AS (SELECT judgment_id, ordinal, content_text, class_name = 'Judg-Heading-1' AS h FROM frags)
SELECT judgment_id, ordinal, CASE WHEN NOT h THEN last_value(CASE WHEN h AND content_text <> '' THEN content_text END IGNORE NULLS) OVER (PARTITION BY judgment_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS section_heading FROM k""")
def carry_section_heading(spark, sf_dir):
    """W2, P5, P6."""
    f = frags(spark, sf_dir).withColumn("kind", F.when(F.col("class_name").startswith("Judg-Heading-"), "heading").otherwise("paragraph"))
    return f.select("judgment_id", "ordinal", fragments.carry_section_heading(order="ordinal", value="content_text").alias("section_heading"))


@query(f"""WITH {SQL_FRAGS}, k AS (SELECT judgment_id, ordinal, ordinal % 6 = 2 AS anchor FROM frags)
SELECT judgment_id, ordinal, coalesce(last_value(CASE WHEN anchor THEN ordinal END IGNORE NULLS) OVER (PARTITION BY judgment_id ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    first_value(CASE WHEN anchor THEN ordinal END IGNORE NULLS) OVER (PARTITION BY judgment_id ORDER BY ordinal ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS target FROM k""")
def attach_orphans(spark, sf_dir):
    """W3, W4."""
    f = frags(spark, sf_dir).withColumn("is_anchor", F.col("ordinal") % 6 == 2)
    return f.select("judgment_id", "ordinal", fragments.attachment_target(order="ordinal").alias("target"))


@query(f"""WITH {SQL_FRAGS} SELECT judgment_id, string_agg(CASE WHEN content_text <> '' THEN CASE WHEN paragraph_number IS NULL THEN content_text ELSE paragraph_number || ' ' || content_text END END, chr(10) || chr(10) ORDER BY ordinal) AS content_text, CAST(count(*) AS INTEGER) AS fragment_count
FROM frags GROUP BY judgment_id HAVING bool_or(content_text <> '') UNION ALL SELECT judgment_id, '', CAST(count(*) AS INTEGER) FROM frags GROUP BY judgment_id HAVING NOT bool_or(content_text <> '')""")
def compose_content(spark, sf_dir):
    """A6."""
    return fragments.compose_content(frags(spark, sf_dir))


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, count(*) AS fragments, CAST(sum(has_footnotes) AS BIGINT) AS with_footnotes, CAST(sum(length(content_text)) AS BIGINT) AS chars FROM frags GROUP BY judgment_id")
def fragment_stats(spark, sf_dir):
    """A5."""
    return catalog.fragment_stats(frags(spark, sf_dir))


@query(f"WITH {SQL_FRAGS} SELECT 'class_name' AS facet, class_name AS value, count(*) AS n FROM frags GROUP BY ALL UNION ALL SELECT 'has_footnotes', CAST(has_footnotes AS VARCHAR), count(*) FROM frags GROUP BY ALL UNION ALL SELECT 'has_table', CAST(has_table AS VARCHAR), count(*) FROM frags GROUP BY ALL UNION ALL SELECT 'has_figure', CAST(CAST(ordinal % 5 = 2 AS INTEGER) AS VARCHAR), count(*) FROM frags GROUP BY ALL")
def facet_counts_fragments(spark, sf_dir):
    """A2."""
    f = frags(spark, sf_dir).withColumn("has_figure", (F.col("ordinal") % 5 == 2).cast("int"))
    return catalog.facet_counts(f, "class_name", "has_footnotes", "has_table", "has_figure")


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, ordinal FROM frags WHERE paragraph_number = 2 AND class_name = 'Judg-1' AND has_footnotes = 1")
def fragment_lookup(spark, sf_dir):
    """P10."""
    return fragments.fragment_lookup(frags(spark, sf_dir), paragraph_number=2, class_name="Judg-1", has_footnotes=1).select("judgment_id", "ordinal")


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, ordinal FROM frags")
def reading_order(spark, sf_dir):
    """T4."""
    return fragments.reading_order(frags(spark, sf_dir)).select("judgment_id", "ordinal")


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, ordinal FROM frags WHERE doc_id % 3 = 0")
def fragments_of(spark, sf_dir):
    """J7."""
    chosen = table(spark, sf_dir, "documents").filter("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("id"))
    return catalog.fragments_of(chosen, frags(spark, sf_dir)).select("judgment_id", "ordinal")


@query(f"""WITH {SQL_FRAGS}, g AS (SELECT doc_id, judgment_id, count(*) AS n FROM frags GROUP BY ALL)
SELECT 'no judgment' AS problem, judgment_id AS id FROM g WHERE doc_id % 13 = 0
UNION ALL SELECT 'fragment count', judgment_id FROM g WHERE doc_id % 13 <> 0 AND doc_id % 5 = 0
UNION ALL SELECT 'ordinals', judgment_id FROM frags WHERE doc_id % 17 = 0 AND ordinal = 0
UNION ALL SELECT 'fragment id', judgment_id || '_' || ordinal FROM frags WHERE ordinal = 7""")
def integrity_checks(spark, sf_dir):
    """J10 on planted problems."""
    f = frags(spark, sf_dir)
    counted = f.groupBy("doc_id", F.col("judgment_id").alias("id")).agg(F.count(F.lit(1)).cast("int").alias("n")).filter("doc_id % 13 <> 0")
    judgments = counted.select("id", F.when(F.col("doc_id") % 5 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("fragment_count"))
    shifted = F.when(F.col("doc_id") % 17 == 0, F.col("ordinal") + 100_000).otherwise(F.col("ordinal"))
    good = F.format_string("%s_%04d", F.col("judgment_id"), shifted)
    f = f.select("judgment_id", F.when(F.col("ordinal") == 7, F.concat("judgment_id", F.lit("_"), F.col("ordinal").cast("string"))).otherwise(good).alias("id"), shifted.alias("ordinal"))
    return fragments.integrity_checks(judgments, f)


_TERMS = "regexp_extract_all(lower(text), '[a-z0-9\\x{80}-\\x{ffff}]+')"


@query(f"SELECT term, doc_id AS id, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL")
def search_index(spark, sf_dir):
    """A15."""
    return search.search_index(table(spark, sf_dir, "documents"), "doc_id", "text")[0]


def _search_sql(columns: str = "", joined: str = "") -> str:
    return f"""WITH p AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL), l AS (SELECT doc_id, len({_TERMS}) AS terms FROM documents),
s AS (SELECT count(*) AS n, avg(terms) AS mean FROM l), q AS (SELECT item_id AS query_id, list_distinct({_TERMS}) AS w FROM benchmark),
t AS (SELECT query_id, len(w) AS need, unnest(w) AS term FROM q), df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
h AS (SELECT query_id, need, doc_id AS id, count(*) AS matched, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * terms / mean))), 6) AS score FROM t JOIN p USING (term) JOIN df USING (term) JOIN l USING (doc_id), s GROUP BY ALL HAVING count(*) = need)
SELECT query_id, rank, id, score{columns} FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM h){joined} WHERE rank <= 10"""


def _asked(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _indexed(spark, sf_dir):
    """The documents as a stored index, added in two batches."""
    d, at = table(spark, sf_dir, "documents"), new_folder(spark, "index")
    search.add_to_index(d.filter("doc_id % 2 = 0"), at, "even", "doc_id", "text")
    search.add_to_index(d.filter("doc_id % 2 <> 0"), at, "odd", "doc_id", "text")
    return at


@query(_search_sql())
def search_queries(spark, sf_dir):
    """All words of every benchmark item against a stored index of all documents."""
    return search.search_stored(spark, _indexed(spark, sf_dir), _asked(spark, sf_dir), 10)


@query(_search_sql(", lang, source", " JOIN documents ON doc_id = id"))
def search_judgments(spark, sf_dir):
    """Q8: whole items against the stored index, with columns of what is found."""
    judgments = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    return search.search_judgments(spark, _indexed(spark, sf_dir), _asked(spark, sf_dir), judgments, ["lang", "source"])


@query(_search_sql())
def search_whole_items(spark, sf_dir):
    """search_queries under its older name."""
    return search_queries(spark, sf_dir)
