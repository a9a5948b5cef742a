"""Queries by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Adapters: court-like tables derived from the given ones, the same in SQL.

SQL_CODE = "upper(regexp_extract(url, '/([a-z]{2})/[0-9]+', 1))"
SQL_LISTED = f"""listed AS (SELECT page_id, url, {SQL_CODE} AS code, 'https://www.elitigation.sg/gd/s/' || (2000 + page_id % 25) || '_SG' || {SQL_CODE} || '_' || page_id AS source_url,
    substr(sha256('https://www.elitigation.sg/gd/s/' || (2000 + page_id % 25) || '_SG' || {SQL_CODE} || '_' || page_id), 1, 12) AS id,
    '[' || (2000 + page_id % 25) || '] SG' || {SQL_CODE} || ' ' || page_id AS citation,
    (2000 + page_id % 25) || '-' || lpad(CAST(1 + page_id % 12 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') AS decision_date FROM pages)"""


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue-like row per page: source_url, id, citation, decision_date, code."""
    from courtlake.functions import text

    p = table(spark, sf_dir, "pages").select("page_id", "url", F.upper(F.regexp_extract("url", r"/([a-z]{2})/\d+", 1)).alias("code"))
    year = (2000 + F.col("page_id") % 25).cast("string")
    p = p.withColumn("source_url", F.concat(F.lit("https://www.elitigation.sg/gd/s/"), year, F.lit("_SG"), "code", F.lit("_"), F.col("page_id").cast("string")))
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return p.withColumns({
        "id": text.make_id(F.col("source_url")), "citation": F.concat(F.lit("["), year, F.lit("] SG"), "code", F.lit(" "), F.col("page_id").cast("string")),
        "decision_date": F.concat(year, F.lit("-"), pad(1 + F.col("page_id") % 12), F.lit("-"), pad(1 + F.col("page_id") % 28)),
    })


#: Lines of documents as fragments: every 5th a heading, then numbered, lettered and quoted paragraphs.
SQL_FRAGS = """frags AS (SELECT CAST(doc_id AS VARCHAR) AS judgment_id, doc_id, CAST(o - 1 AS INTEGER) AS ordinal, line AS content_text,
    CASE (o - 1) % 5 WHEN 0 THEN 'Judg-Heading-1' WHEN 1 THEN 'Judg-1' WHEN 2 THEN 'Judg-2' WHEN 3 THEN 'Judg-1' ELSE 'Judg-Quote-1' END AS class_name,
    CASE WHEN (o - 1) % 5 IN (1, 3) THEN CAST((o - 1) // 5 * 2 + (o - 1) % 5 // 2 + 1 AS INTEGER) END AS paragraph_number,
    CASE WHEN (o - 1) % 7 = 3 THEN 1 ELSE 0 END AS has_footnotes, CASE WHEN (o - 1) % 11 = 4 THEN 1 ELSE 0 END AS has_table
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS o FROM documents))"""


def frags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ordinal", "content_text"))
    o = F.col("ordinal")
    return d.select(
        F.col("doc_id").cast("string").alias("judgment_id"), "doc_id", "ordinal", "content_text",
        F.element_at(F.array(*(F.lit(c) for c in ("Judg-Heading-1", "Judg-1", "Judg-2", "Judg-1", "Judg-Quote-1"))), o % 5 + 1).alias("class_name"),
        F.when((o % 5).isin(1, 3), F.expr("cast(ordinal div 5 * 2 + (ordinal % 5) div 2 + 1 as int)")).alias("paragraph_number"),
        (o % 7 == 3).cast("int").alias("has_footnotes"), (o % 11 == 4).cast("int").alias("has_table"),
    )


#: Events as attempts: a user is a document, an event of type error is a failure.
SQL_ATTEMPTS = """attempts AS (SELECT CAST(user_id AS VARCHAR) AS id, ts, event_id AS seq, event_type <> 'error' AS ok, 'error ' || event_id AS error,
    strftime(ts, '%Y-%m-%d') AS run_id, CAST(2 + user_id % 2 AS INTEGER) AS phase, event_type, value FROM events)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("id"), "ts", F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"), F.concat(F.lit("error "), F.col("event_id").cast("string")).alias("error"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), (2 + F.col("user_id") % 2).cast("int").alias("phase"), "event_type", "value",
    )
