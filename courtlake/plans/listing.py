"""Discovery and catalogue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.functions import html, text
from courtlake.operators import catalog, stored
from courtlake.plans.registry import SQL_LISTED, listed, query, table
from courtlake.sources import bucketed
from courtlake.sources.scratch import new_folder

NOW = "2026-07-16T12:00:00"


def listing_html(spark, sf_dir):
    """Listing pages of ten cards each, built in Spark from pages."""
    p = listed(spark, sf_dir)
    i = F.col("page_id")
    n = i.cast("string")
    date = F.when(i % 4 == 0, F.concat(F.lit("<a class=\"decision-date-link\">Decision Date: "), F.date_format(F.to_date("decision_date"), "d MMM yyyy"), F.lit("</a>"))).when(i % 4 == 1, F.lit("")).otherwise(
        F.concat(F.lit("<a class=\"decision-date-link\" data-searchparam='DecisionDate:\""), "decision_date", F.lit("\"'>x</a>")))
    card = F.concat(
        F.lit("<div class=\"card col-12\"><a class=\"gd-heardertext\" href=\""), F.when(i % 2 == 0, F.col("source_url")).otherwise(F.regexp_replace("source_url", "^https://[^/]+", "")), F.lit("\"> A &amp; B <em>v</em> "), n, F.lit("</a>"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<a class=\"citation-num-link\"><span class=\"gd-addinfo-text\">"), "citation", F.lit(" |</span></a>"))), date,
        F.lit("<a class=\"case-num-link\">HC/"), n, F.lit("</a><a class=\"case-num-link\"> </a><a class=\"case-num-link\">OS/"), n, F.lit("</a><div class=\"gd-catchword-container\"><a class=\"gd-cw\">[Tort — "), "code", F.lit("]</a><a class=\"gd-cw\">plain \"x\"</a></div></div>"),
    )
    cards = p.select(F.expr("page_id div 10").alias("page"), F.struct("page_id", card.alias("card")).alias("c")).groupBy("page").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    body = F.array_join(F.transform("cs", lambda c: c["card"]), "")
    return cards.select("page", F.concat(F.lit("<html><body>"), body, F.lit("<ul class=\"pagination\"><li class=\"PagedList-skipToLast\"><a href=\"/gd/Home/Index?CurrentPage="), (F.col("page") + 1).cast("string"), F.lit("\">Last</a></li></ul></body></html>")).alias("html"))


_ROW = f"""
SELECT page_id // 10 AS page, CAST(page_id % 10 AS INTEGER) AS pos, id, CASE WHEN page_id % 5 = 0 THEN '' ELSE citation END AS citation, 'A & Bv' || page_id AS case_name, 'HC/' || page_id || ' | OS/' || page_id AS case_numbers,
    CASE WHEN page_id % 4 = 1 THEN '' ELSE decision_date END AS decision_date, 'SG' || code AS court, '["Tort — ' || code || '", "plain \\"x\\""]' AS subject_tags, source_url,
    CASE WHEN page_id % 5 = 0 THEN '' ELSE 'https://www.elitigation.sg/gd/gd/%5B' || (2000 + page_id % 25) || '%5D%20SG' || code || '%20' || page_id || '/pdf' END AS pdf_url,
    CAST(NULL AS VARCHAR) AS content_text, CAST(NULL AS VARCHAR) AS court_summary, CAST(NULL AS VARCHAR) AS summary, '{NOW}' AS created_at FROM listed"""


@query(f"WITH {SQL_LISTED} {_ROW}")
def catalog_rows_from_listing(spark, sf_dir):
    """Cards of listing pages to catalogue rows."""
    cards = html.listing_cards(listing_html(spark, sf_dir))
    return catalog.catalog_rows(catalog.valid_cards(cards), NOW)


@query("SELECT page_id // 10 AS page, CAST(page_id // 10 + 1 AS INTEGER) AS total_pages FROM pages GROUP BY ALL")
def listing_total_pages(spark, sf_dir):
    """F10."""
    cards = html.listing_cards(listing_html(spark, sf_dir))
    return cards.groupBy("page").agg(F.max(text.total_pages(F.col("last_link"))).alias("total_pages"))


@query(f"WITH {SQL_LISTED} SELECT code AS court, count(*) AS n FROM listed GROUP BY code ORDER BY n DESC, court LIMIT 10")
def flagship_courts(spark, sf_dir):
    """A1 and top-k: the courts with most judgments."""
    return listed(spark, sf_dir).groupBy(F.col("code").alias("court")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "court").limit(10)


def _known(spark, sf_dir):
    return listed(spark, sf_dir).filter("page_id % 9 in (1, 2, 3, 4, 5) or page_id % 3 = 0").select("id")


def _items(spark, sf_dir):
    """Listing rows in crawl order; each 20th id comes twice."""
    p = listed(spark, sf_dir)
    again = p.filter("page_id % 20 = 7").withColumn("pos", F.lit(11))
    rows = p.withColumn("pos", (F.col("page_id") % 10).cast("int")).unionByName(again)
    return rows.select("id", "page_id", F.expr("page_id div 10").alias("page"), "pos", (F.col("page_id") % 8).cast("string").alias("run_id"))


_SQL_ITEMS = """items AS (SELECT id, page_id, page_id // 10 AS page, CAST(page_id % 10 AS INTEGER) AS pos, CAST(page_id % 8 AS VARCHAR) AS run_id FROM listed
    UNION ALL SELECT id, page_id, page_id // 10, 11, CAST(page_id % 8 AS VARCHAR) FROM listed WHERE page_id % 20 = 7),
    known AS (SELECT id FROM listed WHERE page_id % 9 IN (1, 2, 3, 4, 5) OR page_id % 3 = 0)"""


@query(f"WITH {SQL_LISTED}, {_SQL_ITEMS} SELECT * FROM items WHERE id NOT IN (SELECT id FROM known)")
def new_items(spark, sf_dir):
    """J1, J2."""
    return catalog.new_items(_items(spark, sf_dir), _known(spark, sf_dir))


@query(f"WITH {SQL_LISTED}, {_SQL_ITEMS} SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page, pos) AS k FROM items) WHERE k = 1")
def first_occurrence(spark, sf_dir):
    """W6."""
    return catalog.first_occurrence(_items(spark, sf_dir), "page", "pos")


@query(f"""WITH {SQL_LISTED}, {_SQL_ITEMS},
a AS (SELECT i.*, i.id IN (SELECT id FROM known) OR row_number() OVER (PARTITION BY run_id, id ORDER BY page, pos) > 1 AS known, row_number() OVER (PARTITION BY run_id ORDER BY page, pos) AS place FROM items i),
b AS (SELECT *, place - coalesce(max(CASE WHEN NOT known THEN place END) OVER (PARTITION BY run_id ORDER BY place), 0) AS len FROM a),
c AS (SELECT run_id, min(place) AS cut FROM b WHERE len >= 3 GROUP BY run_id)
SELECT b.id, b.page_id, b.page, b.pos, b.run_id, b.known FROM b LEFT JOIN c USING (run_id) WHERE cut IS NULL OR place <= cut""")
def stop_after_known_run(spark, sf_dir):
    """W5 with three in a row."""
    return catalog.stop_after_known_run(_items(spark, sf_dir), _known(spark, sf_dir), 3)


@query(f"WITH {SQL_LISTED}, {_SQL_ITEMS} SELECT page, count(*) AS total, count(*) FILTER (WHERE id NOT IN (SELECT id FROM known)) AS new FROM items GROUP BY page")
def page_totals(spark, sf_dir):
    """A14."""
    return catalog.page_totals(_items(spark, sf_dir), _known(spark, sf_dir))


@query(f"WITH {SQL_LISTED} {_ROW} WHERE id NOT IN (SELECT id FROM listed WHERE page_id % 3 = 0)")
def discover(spark, sf_dir):
    """Q1 without an early stop: all new rows of a crawl."""
    known = listed(spark, sf_dir).filter("page_id % 3 = 0").select("id")
    return catalog.discover(html.listing_cards(listing_html(spark, sf_dir)), known, None, NOW, n=1_000_000_000)


@query(f"""WITH {SQL_LISTED}, known AS (SELECT id FROM listed WHERE page_id % 3 = 0 OR page_id % 100 > 90),
a AS (SELECT page_id, row_number() OVER (ORDER BY page_id // 10, page_id % 10) AS place, id IN (SELECT id FROM known) AS known FROM listed),
b AS (SELECT *, place - coalesce(max(CASE WHEN NOT known THEN place END) OVER (ORDER BY place), 0) AS len FROM a),
rows AS ({_ROW.replace('SELECT page_id // 10 AS page', 'SELECT page_id AS k, page_id // 10 AS page')})
SELECT rows.* EXCLUDE (k) FROM rows JOIN b ON b.page_id = k WHERE NOT known AND place <= (SELECT coalesce(min(place), 1000000000) FROM b WHERE len >= 5)""")
def discover_until_known(spark, sf_dir):
    """Q1: new rows of a crawl up to five known ones in a row."""
    known = listed(spark, sf_dir).filter("page_id % 3 = 0 or page_id % 100 > 90").select("id")
    return catalog.discover(html.listing_cards(listing_html(spark, sf_dir)), known, None, NOW)


# tables at volume


@query("SELECT o_orderkey AS id, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders")
def apply_updates(spark, sf_dir):
    """Two columns of every 7th order."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus", "o_orderpriority")
    updates = orders.filter("id % 7 = 0").select("id", F.lit("X").alias("o_orderstatus"), F.lit(None).cast("string").alias("o_orderpriority"))
    return catalog.apply_updates(orders, updates, ["o_orderstatus", "o_orderpriority"])


_LINE = "l_orderkey || '_' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS id, l_orderkey, l_quantity"


@query(f"SELECT {_LINE} FROM lineitem WHERE l_orderkey % 3 <> 0 UNION ALL SELECT DISTINCT id, l_orderkey, -1.0 FROM (SELECT {_LINE} FROM lineitem WHERE l_orderkey % 3 = 0)")
def insert_or_ignore(spark, sf_dir):
    """Lines as fragments; the first write wins."""
    lines = table(spark, sf_dir, "lineitem").select(F.format_string("%s_%04d", F.col("l_orderkey").cast("string"), "l_linenumber").alias("id"), "l_orderkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    old = lines.filter("l_orderkey % 3 <> 0")
    return catalog.insert_or_ignore(old, lines.withColumn("l_quantity", F.lit(-1.0)))[0]


@query(f"""WITH lines AS (SELECT {_LINE} FROM lineitem), new AS (SELECT count(*) AS n, count(DISTINCT id) FILTER (WHERE l_orderkey % 3 = 0) AS added FROM lines)
SELECT 'added' AS kind, added AS n FROM new UNION ALL SELECT 'ignored', n - added FROM new UNION ALL SELECT 'rows', (SELECT count(*) FROM lines WHERE l_orderkey % 3 <> 0) + added FROM new""")
def insert_counts(spark, sf_dir):
    """Lines appended to a stored table, with the counts that the write itself took."""
    lines, at = table(spark, sf_dir, "lineitem"), new_folder(spark, "insert")
    lines = lines.select(F.format_string("%s_%04d", F.col("l_orderkey").cast("string"), "l_linenumber").alias("id"), "l_orderkey", F.col("l_quantity").cast("double").alias("l_quantity"))
    lines.filter("l_orderkey % 3 <> 0").write.parquet(at)
    counts = bucketed.insert_counted(spark, at, lines)
    rows = spark.read.parquet(at).agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows").alias("kind"), "n")
    return rows.unionByName(spark.createDataFrame(sorted(counts.items()), "kind string, n long"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS o_custkey FROM orders")
def append_new(spark, sf_dir):
    """Staged and pending rows, one per new id."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    staged = orders.select("id", F.lit(None).cast(orders.schema["o_custkey"].dataType).alias("o_custkey"))
    return catalog.append_new(orders.filter("id % 4 <> 0"), staged, staged.filter("id % 8 = 0"))


@query(f"SELECT {_LINE} FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber = 1) UNION ALL SELECT {_LINE.replace('l_quantity', '0.0 AS l_quantity')} FROM lineitem WHERE l_orderkey % 5 = 0 AND l_linenumber = 1")
def reextract(spark, sf_dir):
    """All lines of every 5th order give way to one."""
    lines = table(spark, sf_dir, "lineitem").select(F.format_string("%s_%04d", F.col("l_orderkey").cast("string"), "l_linenumber").alias("id"), "l_orderkey", F.col("l_quantity").cast("double").alias("l_quantity"), "l_linenumber")
    new = lines.filter("l_orderkey % 5 = 0 and l_linenumber = 1").withColumn("l_quantity", F.lit(0.0)).drop("l_linenumber")
    return catalog.replace_for(lines.drop("l_linenumber"), new, "l_orderkey")


def _catalog(spark, sf_dir):
    """A catalogue in all three states of content and summary."""
    i = F.col("page_id")
    return listed(spark, sf_dir).select(
        "id", "page_id", F.col("code").alias("court"), "decision_date", "citation", F.when(i % 4 == 0, None).when(i % 4 == 1, "").otherwise(F.concat(F.lit("body "), i.cast("string"))).alias("content_text"),
        F.when(i % 4 == 0, None).otherwise((i % 4 > 1).cast("int")).alias("has_content"), F.when(i % 8 == 2, F.concat(F.lit("summary "), i.cast("string"))).alias("summary"), F.when(i % 8 == 2, F.col("decision_date")).alias("summary_generated_at"),
    )


def state_catalog(spark, sf_dir):
    """The catalogue whose state the monitor reports."""
    return _catalog(spark, sf_dir)


SQL_CATALOG = """catalog AS (SELECT id, page_id, code AS court, decision_date, citation, CASE page_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'body ' || page_id END AS content_text,
    CASE WHEN page_id % 4 = 0 THEN NULL ELSE CAST(page_id % 4 > 1 AS INTEGER) END AS has_content, CASE WHEN page_id % 8 = 2 THEN 'summary ' || page_id END AS summary, CASE WHEN page_id % 8 = 2 THEN decision_date END AS summary_generated_at FROM listed)"""


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT 'court' AS facet, court AS value, count(*) AS n FROM catalog GROUP BY ALL UNION ALL SELECT 'decision_date', decision_date, count(*) FROM catalog GROUP BY ALL UNION ALL SELECT 'has_content', CAST(has_content AS VARCHAR), count(*) FROM catalog GROUP BY ALL")
def facet_counts_judgments(spark, sf_dir):
    """A1."""
    return catalog.facet_counts(_catalog(spark, sf_dir), "court", "decision_date", "has_content")


@query(f"""WITH {SQL_LISTED}, {SQL_CATALOG} SELECT count(*) AS total, count(content_text) AS enriched, count(*) FILTER (WHERE has_content = 1) AS with_body, count(summary) AS summarised,
    count(*) FILTER (WHERE content_text IS NULL) AS extract_backlog, count(*) FILTER (WHERE has_content = 1 AND summary IS NULL) AS summary_backlog FROM catalog""")
def pipeline_state(spark, sf_dir):
    """A3, A4, P3, P4."""
    return catalog.pipeline_state(_catalog(spark, sf_dir))


@query(f"""WITH {SQL_LISTED}, {SQL_CATALOG} SELECT 'extracted' AS kind, count(*) FILTER (WHERE has_content = 1) AS n FROM catalog UNION ALL SELECT 'empty', count(*) FILTER (WHERE has_content = 0) FROM catalog
UNION ALL SELECT 'waiting', count(*) FILTER (WHERE content_text IS NULL) FROM catalog""")
def extraction_counts(spark, sf_dir):
    """Extracted and empty rows counted while they are written, and what waits."""
    of = lambda n: F.count_if(F.col("has_content") == n)
    there = F.col("content_text").isNotNull()
    counts = bucketed.write_counted(_catalog(spark, sf_dir), new_folder(spark, "written"), keep=there, extracted=of(1), empty=of(0), waiting=F.count_if(~there))
    return spark.createDataFrame(sorted(counts.items()), "kind string, n long")


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, page_id FROM catalog WHERE content_text IS NULL ORDER BY decision_date DESC, id LIMIT 50")
def select_for_extraction(spark, sf_dir):
    """T1, P3."""
    return catalog.newest(catalog.extract_backlog(_catalog(spark, sf_dir)), 50).select("id", "page_id")


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, page_id FROM catalog ORDER BY decision_date DESC, id LIMIT 25 OFFSET 25")
def catalog_second_page(spark, sf_dir):
    """T3."""
    return catalog.catalog_page(_catalog(spark, sf_dir), page=2).select("id", "page_id")


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, page_id FROM catalog ORDER BY decision_date DESC, id LIMIT 20 OFFSET 100")
def stored_catalog_page(spark, sf_dir):
    """The sixth page of a stored catalogue, from the files that hold it."""
    at = new_folder(spark, "ordered")
    stored.store_ordered(_catalog(spark, sf_dir), at, files=8)
    return stored.ordered_page(spark, at, page=6, size=20).select("id", "page_id")


@query(f"WITH {SQL_LISTED} SELECT citation, decision_date || 'T00:00:00' AS extracted_at FROM listed WHERE page_id % 3 > 0 ORDER BY extracted_at DESC, id LIMIT 10")
def recent_extractions(spark, sf_dir):
    """T5: the judgments extracted last."""
    t = listed(spark, sf_dir).withColumn("extracted_at", F.when(F.col("page_id") % 3 > 0, F.concat("decision_date", F.lit("T00:00:00"))))
    return catalog.newest(t.filter("extracted_at is not null"), 10, date="extracted_at").select("citation", "extracted_at")


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, summary_generated_at FROM catalog WHERE summary_generated_at IS NOT NULL ORDER BY summary_generated_at DESC, id LIMIT 10")
def recent_summaries(spark, sf_dir):
    """T5."""
    return catalog.newest(_catalog(spark, sf_dir).filter("summary_generated_at is not null"), 10, date="summary_generated_at").select("id", "summary_generated_at")


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, CASE WHEN page_id % 6 = 0 THEN 'cache' WHEN page_id % 3 = 0 THEN 'archive' ELSE 'missing' END AS content_source FROM catalog WHERE content_text IS NULL")
def best_source(spark, sf_dir):
    """J5."""
    c = _catalog(spark, sf_dir)
    return catalog.best_source(catalog.extract_backlog(c).select("id"), c.filter("page_id % 6 = 0"), c.filter("page_id % 3 = 0"))


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, CASE WHEN page_id % 6 = 3 THEN 'cached ' || page_id END AS cached_summary, CASE WHEN page_id % 6 = 3 THEN 'cached' ELSE 'pending' END AS status FROM catalog WHERE has_content = 1 AND summary IS NULL")
def reuse_cached_summaries(spark, sf_dir):
    """J6, P4."""
    c = _catalog(spark, sf_dir)
    cache = c.filter("page_id % 3 = 0").select(F.col("id").alias("judgment_id"), F.when(F.col("page_id") % 6 == 3, F.concat(F.lit("cached "), F.col("page_id").cast("string"))).otherwise(" ").alias("summary"))
    return catalog.reuse_cached_summaries(catalog.summary_backlog(c).select("id"), cache)


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, CASE WHEN page_id % 16 = 2 THEN NULL ELSE summary END AS summary, CASE WHEN page_id % 16 = 2 THEN NULL ELSE summary_generated_at END AS summary_generated_at FROM catalog")
def nullify_summaries(spark, sf_dir):
    """U6."""
    c = _catalog(spark, sf_dir)
    cache = c.select(F.col("id").alias("judgment_id"), "summary")
    return catalog.nullify_summaries(c, cache, c.filter("page_id % 16 = 2"))[0].select("id", "summary", "summary_generated_at")


@query(f"WITH {SQL_LISTED}, {SQL_CATALOG} SELECT id, court, CAST(NULL AS INTEGER) AS fragment_count, CAST(NULL AS VARCHAR) AS extracted_at FROM catalog")
def ensure_columns(spark, sf_dir):
    """Idempotent."""
    c = _catalog(spark, sf_dir).select("id", "court")
    new = {"fragment_count": "int", "extracted_at": "string"}
    return catalog.ensure_columns(catalog.ensure_columns(c, new), new)
