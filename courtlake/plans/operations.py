"""Ledger, summary, audit, monitoring and streaming queries."""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import functions as F

from courtlake.functions import text
from courtlake.operators import catalog, ledger, monitor, stored, summaries
from courtlake.plans import listing
from courtlake.plans.registry import ORACLES, QUERIES, SQL_ATTEMPTS, SQL_FRAGS, attempts, frags, query, table
from courtlake.sources import bucketed, files
from courtlake.sources.scratch import new_folder
from courtlake.streaming import streams

_LEDGER = """cleared AS (SELECT id, max((ts, seq)) AS c FROM attempts WHERE ok GROUP BY id),
ledger AS (SELECT a.id, count(*) AS count, substr(arg_max(error, (ts, seq)), 1, 500) AS last_error, max(ts) AS last_attempt FROM attempts a LEFT JOIN cleared USING (id) WHERE NOT ok AND (c IS NULL OR (ts, seq) > c) GROUP BY a.id)"""
_NOW = "(SELECT max(ts) + INTERVAL 1 HOUR FROM events)"


def now(a):
    """One hour after the last attempt: a single value."""
    return (a.agg(F.max("ts")).first()[0] + timedelta(hours=1)).isoformat(sep=" ")


@query(f"WITH {SQL_ATTEMPTS}, {_LEDGER} SELECT * FROM ledger")
def ledger_from_attempts(spark, sf_dir):
    """A13."""
    return ledger.ledger_from_attempts(attempts(spark, sf_dir))


def failures(a):
    """A harsher ledger for the tiers: all failures of a document."""
    return a.filter("not ok").groupBy("id").agg((F.count(F.lit(1)) % 8).alias("count"), F.max("ts").alias("last_attempt"), F.lit("x").alias("last_error"))


_FAILURES = "failures AS (SELECT id, count(*) % 8 AS count, max(ts) AS last_attempt FROM attempts WHERE NOT ok GROUP BY id)"


@query(f"WITH {SQL_ATTEMPTS}, {_FAILURES} SELECT DISTINCT id FROM attempts WHERE id NOT IN (SELECT id FROM failures WHERE count >= 3 AND epoch({_NOW}) - epoch(last_attempt) < 86400)")
def exclude_quarantined(spark, sf_dir):
    """F29, J4."""
    a = attempts(spark, sf_dir)
    return ledger.exclude_quarantined(a.select("id").distinct(), failures(a), now(a))


@query(f"""WITH {SQL_ATTEMPTS}, {_FAILURES} SELECT id, count AS failures, CASE WHEN coalesce(count, 0) < 3 THEN 'primary' WHEN count >= 6 AND epoch({_NOW}) - epoch(last_attempt) < 604800 THEN 'blocked' ELSE 'alternative' END AS tier,
    CAST(coalesce(count, 0) >= 3 AS INTEGER) AS priority, CASE WHEN coalesce(count, 0) < 3 THEN 'small' ELSE 'large' END AS model FROM (SELECT DISTINCT id FROM attempts) LEFT JOIN failures USING (id)""")
def summary_tiers(spark, sf_dir):
    """F30, J9, P9."""
    a = attempts(spark, sf_dir)
    return ledger.with_tier(a.select("id").distinct(), failures(a), now(a)).withColumn("model", text.model_route(F.col("tier"), "small", "large"))


@query(f"""WITH {SQL_ATTEMPTS}, i AS (SELECT *, sum(CAST(ok AS INTEGER)) OVER (PARTITION BY run_id, phase ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS island FROM attempts),
g AS (SELECT run_id, phase, island, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE ok) AS passed FROM i GROUP BY ALL)
SELECT run_id, phase, CAST(sum(failed // 2) AS BIGINT) AS trips, CAST(sum(passed) AS BIGINT) AS successes, CAST(sum(failed + passed) AS BIGINT) AS attempts FROM g GROUP BY ALL""")
def breaker_trips(spark, sf_dir):
    """W7 with two failures in a row."""
    return ledger.breaker_trips(attempts(spark, sf_dir), 2)


# summaries

_STRIP = "regexp_replace(regexp_replace(content_text, '^\\s+', ''), '\\s+$', '')"
_RENDER = f"CASE WHEN {_STRIP} = '' THEN '' WHEN class_name LIKE 'Judg-Heading-%' THEN '## ' || {_STRIP} WHEN paragraph_number IS NOT NULL THEN '[' || paragraph_number || '] ' || {_STRIP} ELSE {_STRIP} END"


@query(f"WITH {SQL_FRAGS} SELECT judgment_id, ordinal, {_RENDER} AS rendered FROM frags")
def render_fragments(spark, sf_dir):
    """F19."""
    return summaries.rendered(frags(spark, sf_dir)).select("judgment_id", "ordinal", "rendered")


@query(f"""WITH {SQL_FRAGS}, r AS (SELECT judgment_id, ordinal, {_RENDER} AS t FROM frags), s AS (SELECT *, row_number() OVER (PARTITION BY judgment_id ORDER BY ordinal) - 1 AS idx, count(*) OVER (PARTITION BY judgment_id) AS n FROM r WHERE t <> '')
SELECT judgment_id, CAST(floor(idx / greatest(3, ceil(n / 4))) AS INTEGER) AS batch, string_agg(t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY idx) AS batch_text, CAST(max(n) AS INTEGER) AS n_rendered FROM s GROUP BY ALL""")
def batch_texts(spark, sf_dir):
    """At most four batches of at least three."""
    return summaries.batch_texts(frags(spark, sf_dir), 4, 3)


@query("SELECT n, CAST(4000 + greatest(0, (n - 100) // 100) * 1000 AS INTEGER) AS max_chars, CAST(greatest(4096, (4000 + greatest(0, (n - 100) // 100) * 1000) // 2 + 1024) AS INTEGER) AS max_tokens, CAST(CASE WHEN n <= 20 THEN 20 ELSE greatest(50, least(n // 5, 200)) END AS INTEGER) AS min_words FROM (SELECT DISTINCT CAST(n_chars AS BIGINT) AS n FROM documents)")
def summary_limits(spark, sf_dir):
    """F17, F18, F28."""
    n = F.col("n")
    limit = text.max_summary_chars(n)
    return table(spark, sf_dir, "documents").select(F.col("n_chars").cast("long").alias("n")).distinct().select("n", limit.alias("max_chars"), text.token_budget(limit).alias("max_tokens"), text.min_words(n).alias("min_words"))


@query(f"""WITH {SQL_FRAGS}, h AS (SELECT *, CASE ordinal % 3 WHEN 0 THEN 'The Holding' WHEN 1 THEN 'Issues' END AS heading FROM frags)
SELECT judgment_id, ordinal, round(CASE WHEN has_footnotes = 1 THEN 2.0 ELSE 0.0 END + CASE ordinal % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.5 ELSE 0.0 END + CASE WHEN has_table = 1 THEN 0.5 ELSE 0.0 END + CAST(0.1 AS DOUBLE) * least(length(content_text), 500) / 100, 6) AS score FROM h""")
def score_fragments(spark, sf_dir):
    """F20."""
    f = frags(spark, sf_dir).withColumn("heading", F.when(F.col("ordinal") % 3 == 0, "The Holding").when(F.col("ordinal") % 3 == 1, "Issues"))
    return f.select("judgment_id", "ordinal", F.round(text.score_fragment(F.col("has_footnotes"), F.col("heading"), F.col("has_table"), F.col("content_text")), 6).alias("score"))


@query(f"""WITH RECURSIVE {SQL_FRAGS}, k AS (SELECT judgment_id, ordinal, length(content_text) AS size, row_number() OVER (PARTITION BY judgment_id ORDER BY length(content_text) % 50 DESC, ordinal) AS place FROM frags),
f AS (SELECT judgment_id, CAST(0 AS BIGINT) AS place, CAST(0 AS BIGINT) AS used, CAST([] AS INTEGER[]) AS taken FROM (SELECT DISTINCT judgment_id FROM frags) UNION ALL
    SELECT f.judgment_id, k.place, CASE WHEN used + size <= 900 THEN used + size ELSE used END, CASE WHEN used + size <= 900 THEN list_append(taken, ordinal) ELSE taken END FROM f JOIN k ON k.judgment_id = f.judgment_id AND k.place = f.place + 1)
SELECT judgment_id, array_to_string(list_sort(arg_max(taken, place)), ',') AS taken FROM f GROUP BY judgment_id""")
def greedy_fill(spark, sf_dir):
    """Lines within 900 characters."""
    item = F.struct((F.length("content_text") % 50).cast("double").alias("score"), "ordinal", F.length("content_text").cast("long").alias("size"))
    grouped = frags(spark, sf_dir).groupBy("judgment_id").agg(F.collect_list(item).alias("items"))
    return grouped.select("judgment_id", F.array_join(F.array_sort(summaries.greedy_fill(F.col("items"), F.lit(900))), ",").alias("taken"))


def _drafts(spark, sf_dir):
    """Documents as drafts, with planted faults by doc_id."""
    i = F.col("doc_id")
    body = F.concat(F.when(i % 3 == 0, "").when(i % 3 == 1, "**Facts**\n").otherwise("Holding\n"), F.when(i % 4 == 1, "Ee_ik &amp; Co &lt;x Khoont's $Charter\n").otherwise(""), F.col("text"), F.when(i % 5 == 0, "\n2.").when(i % 5 == 1, " cut").when(i % 5 == 2, "\n(a) ").otherwise("\nEnd."))
    return table(spark, sf_dir, "documents").select(i.cast("string").alias("id"), i.alias("doc_id"), F.when(i % 6 == 0, F.concat(F.lit("Updated summary: "), body)).otherwise(body).alias("draft"), (i % 300).cast("int").alias("n_fragments"))


_BODY = """body AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '**Facts**' || chr(10) ELSE 'Holding' || chr(10) END || CASE WHEN doc_id % 4 = 1 THEN 'Ee_ik &amp; Co &lt;x Khoont''s $Charter' || chr(10) ELSE '' END || text
    || CASE doc_id % 5 WHEN 0 THEN chr(10) || '2.' WHEN 1 THEN ' cut' WHEN 2 THEN chr(10) || '(a) ' ELSE chr(10) || 'End.' END AS b, CAST(doc_id % 300 AS INTEGER) AS n_fragments FROM documents),
drafts AS (SELECT doc_id, id, CASE WHEN doc_id % 6 = 0 THEN 'Updated summary: ' || b ELSE b END AS draft, n_fragments FROM body)"""


@query(f"WITH {_BODY} SELECT id, b AS stripped FROM body")
def strip_meta_prefix(spark, sf_dir):
    """F22."""
    return _drafts(spark, sf_dir).select("id", text.strip_meta_prefix(F.col("draft")).alias("stripped"))


_US = "regexp_replace(regexp_replace({0}, '([A-Za-z])_([A-Za-z])', '\\1\\2', 'g'), '([A-Za-z])_([A-Za-z])', '\\1\\2', 'g')"


def _fixed(column):
    plain = f"regexp_replace({_US.format(column)}, '([a-zA-Z''\\s])\\$Charter\\b', '\\1Charter', 'gi')"
    return f"replace(replace(replace(replace({plain}, '&lt;', '<'), '&amp;', '&'), 'Khoont', 'Khoon'), 'Emplain', 'Claim')"


@query(f"WITH {_BODY} SELECT id, {_fixed('draft')} AS repaired FROM drafts")
def fix_artifacts(spark, sf_dir):
    """F24."""
    return _drafts(spark, sf_dir).select("id", text.fix_artifacts(F.col("draft")).alias("repaired"))


_HEADING = "\\s*\\*{0,2}\\s*(Facts|Factual\\s+Background|Background|Holding|Decision|Reasons|Analysis)\\b"
_MARKER = "(^|\\n)\\s*([0-9]+\\.\\s*\\*{0,2}|\\*\\*[0-9]+\\.|\\(\\w+\\)|[•\\-*])\\s*$"


def _rstrip(column):
    return f"regexp_replace({column}, '\\s+$', '')"


def _issues(column, n="n_fragments"):
    words = f"len(regexp_extract_all({column}, '\\S+'))"
    least = f"CASE WHEN {n} <= 20 THEN 20 ELSE greatest(50, least({n} // 5, 200)) END"
    checks = f"""CASE WHEN {words} < {least} THEN 'too short' END, CASE WHEN NOT regexp_matches({column}, '(?im)^{_HEADING}') THEN 'no structural heading' END,
    CASE WHEN NOT regexp_matches({_rstrip(column)}, '[.!?:)\\]"''`]$') THEN 'no terminal punctuation' END, CASE WHEN regexp_matches({_rstrip(column)}, '{_MARKER}') THEN 'trailing list marker' END,
    CASE WHEN regexp_matches({column}, '&(amp|lt|gt|ge|le|ne|quot|apos|nbsp|#[0-9]+);') THEN 'HTML entity' END, CASE WHEN regexp_matches({column}, '[A-Za-z]_[A-Za-z]') THEN 'underscore in name' END"""
    return f"list_filter([{checks}], lambda x: x IS NOT NULL)"


@query(f"WITH {_BODY} SELECT id, array_to_string({_issues('draft')}, ',') AS issues, len({_issues('draft')}) = 0 AS passed FROM drafts")
def smell_test(spark, sf_dir):
    """F27."""
    s = text.smell_test(F.col("draft"), F.col("n_fragments"))
    return _drafts(spark, sf_dir).select("id", F.array_join(s["issues"], ",").alias("issues"), s["passed"].alias("passed"))


def _headed(source, column):
    """CTE bare: rows of a source with `bare`, its column without a preface."""
    return f"""b0 AS (SELECT *, regexp_extract({column}, '(?ims)\\A(.*?)^{_HEADING}', 1) AS pre, regexp_matches({column}, '(?im)^{_HEADING}') AS has FROM {source}),
bare AS (SELECT *, CASE WHEN has AND pre <> '' AND length(trim(pre, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) < 500 AND NOT regexp_matches(pre, '^\\s*\\*\\*')
    THEN regexp_replace(substr({column}, length(pre) + 1), '^\\s+', '') ELSE {column} END AS bare FROM b0)"""


def _ended(column):
    return f"CASE WHEN {column} <> '' AND NOT regexp_matches({column}, '[.:!?]$') THEN {column} || '.' ELSE {column} END"


def _unmarked(name, source, column):
    """CTE `name`: rows of a source with `unmarked`, its column without a trailing marker, or null."""
    return f"""{name}0 AS (SELECT *, {_rstrip(column)} AS base, {_rstrip(f"regexp_replace({_rstrip(column)}, '{_MARKER}', '')")} AS cut FROM {source}),
{name} AS (SELECT * EXCLUDE (base, cut), CASE WHEN regexp_matches(base, '{_MARKER}') AND cut <> '' AND length({_ended('cut')}) < length(base) THEN {_ended('cut')} END AS unmarked FROM {name}0)"""


_BARE = f"""{_BODY}, m AS (SELECT *, regexp_replace(draft, '(?i)^\\s*(Updated summary|Summary so far|Draft summary|Summary\\s*\\(Facts[^)]*\\))\\s*:?\\s*', '') AS plain FROM drafts), {_headed('m', 'plain')}"""


@query(f"WITH {_BODY}, {_headed('drafts', 'draft')} SELECT id, bare AS summary FROM bare")
def strip_commentary(spark, sf_dir):
    """F23."""
    return _drafts(spark, sf_dir).select("id", text.strip_commentary(F.col("draft")).alias("summary"))


@query(f"WITH {_BODY}, {_unmarked('u', 'drafts', 'draft')} SELECT id, coalesce(unmarked, draft) AS summary FROM u")
def trim_trailing_incomplete(spark, sf_dir):
    """F25."""
    return _drafts(spark, sf_dir).select("id", text.trim_trailing_incomplete(F.col("draft")).alias("summary"))


_AT = "CASE WHEN strpos(chunk, {0}) > 0 THEN length(chunk) - strpos(reverse(chunk), reverse({0})) + 1 - length({0}) ELSE -1 END"
_TRIES = [f"CASE WHEN {_AT.format(m)} > half THEN {_ended(_rstrip(f'substr(chunk, 1, {_AT.format(m)})'))} END" for m in ("chr(10) || chr(10)", "chr(10)", "'. '", "'.' || chr(10)")]
_TRIMMED = f"""c0 AS (SELECT *, {_fixed('bare')} AS whole, 4000 + greatest(0, (n_fragments - 100) // 100) * 1000 AS lim FROM bare),
c1 AS (SELECT *, substr(whole, 1, CAST(lim AS BIGINT)) AS chunk, lim * 0.5 AS half FROM c0), {_unmarked('c2', 'c1', 'chunk')},
done AS (SELECT id, n_fragments, CASE WHEN length(whole) <= lim THEN coalesce(unmarked, whole) ELSE coalesce(unmarked, CASE WHEN {_AT.format("'. '")} > half THEN substr(chunk, 1, {_AT.format("'. '")}) || '.' END,
    {', '.join(_TRIES)}, {_rstrip('chunk')} || '.') END AS summary FROM c2)"""


@query(f"WITH {_BARE}, {_TRIMMED} SELECT id, summary FROM done")
def trim_to_complete(spark, sf_dir):
    """F22-F24, F26."""
    return summaries.clean_drafts(_drafts(spark, sf_dir)).select("id", "summary")


@query(f"WITH {_BARE}, {_TRIMMED} SELECT id, summary, array_to_string({_issues('summary')}, ',') AS issues, len({_issues('summary')}) = 0 AS passed FROM done")
def finish_summaries(spark, sf_dir):
    """Q6: F22-F24, F26, F27."""
    return summaries.finish_summaries(_drafts(spark, sf_dir)).withColumn("issues", F.array_join("issues", ","))


def _audited(spark, sf_dir):
    d = _drafts(spark, sf_dir).select("id", F.col("draft").alias("summary"), F.col("n_fragments").alias("fragment_count"))
    return summaries.audit(d)


_AUDIT = f"""{_BODY}, {_headed('drafts', 'draft')}, a0 AS (SELECT id, draft, n_fragments, {_fixed('bare')} AS mended FROM bare), {_unmarked('a1', 'a0', 'mended')},
a2 AS (SELECT id, draft, n_fragments, {_issues('draft')} AS l, coalesce(unmarked, mended) AS mended FROM a1), a3 AS (SELECT *, mended <> draft AND len({_issues('mended')}) = 0 AS fixed FROM a2 WHERE len(l) > 0),
audited AS (SELECT id, l, CASE WHEN fixed THEN 'fixed' WHEN list_has_any(l, ['too short', 'no structural heading', 'no terminal punctuation']) THEN 'nullified' ELSE 'unfixed' END AS action, CASE WHEN fixed THEN mended END AS repaired FROM a3)"""


@query(f"WITH {_AUDIT} SELECT id, array_to_string(l, ',') AS issues, action, repaired FROM audited")
def audit(spark, sf_dir):
    """Q7: F23-F25, F27."""
    return _audited(spark, sf_dir).withColumn("issues", F.array_join("issues", ","))


@query(f"""WITH {_AUDIT} SELECT 'issue' AS kind, name, count(*) AS n FROM (SELECT unnest(l) AS name FROM audited) GROUP BY ALL
UNION ALL SELECT 'action', action, count(*) FROM audited GROUP BY ALL""")
def audit_issue_histogram(spark, sf_dir):
    """A12."""
    return summaries.audit_totals(_audited(spark, sf_dir))


def _stored_drafts(spark, sf_dir):
    """Drafts as stored summaries, and their cached copies."""
    d, at = _drafts(spark, sf_dir), new_folder(spark, "tables")
    i = F.col("id")
    table = d.select("id", F.when(i.cast("long") % 5 > 0, F.concat(F.lit("[2020] SGHC "), i)).alias("citation"), F.concat(F.lit("SG"), (i.cast("long") % 3).cast("string")).alias("court"),
                     F.col("n_fragments").cast("int").alias("fragment_count"), F.col("draft").alias("summary"), F.lit("2026-01-01").alias("summary_generated_at"))
    stored.store(table, f"{at}/catalog", buckets=16)
    stored.store(table.select(F.col("id").alias("judgment_id"), F.lit("2026-01-01").alias("generated_at"), F.lit("m").alias("model"), F.lit("e").alias("endpoint"), F.col("fragment_count").alias("frags_total"), "summary"), f"{at}/cache", "judgment_id", buckets=16)
    return at


@query(f"""WITH {_AUDIT} SELECT id, CASE WHEN CAST(id AS BIGINT) % 5 > 0 THEN '[2020] SGHC ' || id ELSE id END AS citation, 'SG' || CAST(id AS BIGINT) % 3 AS court, CAST(n_fragments AS INTEGER) AS fragment_count,
    CAST(len(regexp_extract_all(draft, '\\S+')) AS INTEGER) AS word_count, array_to_string(l, ',') AS issues, action FROM audited JOIN a2 USING (id, l)""")
def audit_records(spark, sf_dir):
    """Q7: records of the audit of a stored table."""
    found = summaries.audit_records(stored.read(spark, f"{_stored_drafts(spark, sf_dir)}/catalog"))
    return found.withColumn("issues", F.array_join("issues", ",")).drop("repaired")


@query(f"""WITH {_AUDIT} SELECT d.id, CASE action WHEN 'fixed' THEN repaired WHEN 'nullified' THEN NULL ELSE d.draft END AS summary, CASE WHEN coalesce(action, '') <> 'nullified' THEN '2026-01-01' END AS summary_generated_at,
    coalesce(action, '') <> 'nullified' AS cached FROM drafts d LEFT JOIN audited USING (id)""")
def audit_write_back(spark, sf_dir):
    """The stored catalogue and cache after an audit, made twice."""
    at = _stored_drafts(spark, sf_dir)
    for _ in range(2):
        stored.write_back_audit(spark, f"{at}/catalog", f"{at}/cache", buckets=16)
    cache = stored.read(spark, f"{at}/cache").select(F.col("judgment_id").alias("id"), F.lit(True).alias("cached"))
    return stored.read(spark, f"{at}/catalog").join(cache, "id", "left").select("id", "summary", "summary_generated_at", F.coalesce("cached", F.lit(False)).alias("cached"))


@query(f"""WITH {_BARE}, {_TRIMMED}, judged AS (SELECT id, n_fragments, summary, len({_issues('summary')}) = 0 AS passed FROM done)
SELECT id, CASE WHEN passed THEN summary END AS summary, CASE WHEN passed THEN '2026-07-16T12:00:00' END AS summary_generated_at, CASE WHEN passed THEN 'large' END AS model, CASE WHEN passed THEN CAST(n_fragments AS INTEGER) END AS frags_total FROM judged""")
def summaries_write_back(spark, sf_dir):
    """Finished drafts in the stored catalogue and cache, with time, model and endpoint."""
    d, at = _drafts(spark, sf_dir), new_folder(spark, "tables")
    none = lambda c: F.lit(None).cast("string").alias(c)
    stored.store(d.select("id", none("summary"), none("summary_generated_at")), f"{at}/catalog", buckets=16)
    old = d.filter("id % 10 = 0").select(F.col("id").alias("judgment_id"), none("generated_at"), none("model"), none("endpoint"), F.lit(0).alias("frags_total"), none("summary"))
    stored.store(old, f"{at}/cache", "judgment_id", buckets=16)
    stored.write_back_summaries(spark, f"{at}/catalog", f"{at}/cache", d, "2026-07-16T12:00:00", "large", "https://models", buckets=16)
    cache = stored.read(spark, f"{at}/cache").filter("model is not null").select(F.col("judgment_id").alias("id"), "model", "frags_total")
    return stored.read(spark, f"{at}/catalog").join(cache, "id", "left").select("id", "summary", "summary_generated_at", "model", "frags_total")


def _first_words(summary: str, part: str, limit: int) -> str:
    """A stand-in for a model: the summary so far, the first ten words of the batch, the number of its words and its hash."""
    words = part.split()
    return " ".join([summary, *words[:10], str(len(words)), hashlib.md5(part.encode()).hexdigest()]).strip()


_SPLIT = "list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '')"


@query(f"""WITH {SQL_FRAGS}, r AS (SELECT judgment_id, ordinal, {_RENDER} AS t FROM frags), s AS (SELECT *, row_number() OVER (PARTITION BY judgment_id ORDER BY ordinal) - 1 AS idx, count(*) OVER (PARTITION BY judgment_id) AS n FROM r WHERE t <> ''),
b AS (SELECT judgment_id, floor(idx / greatest(10, ceil(n / 20))) AS batch, string_agg(t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY idx) AS t FROM s GROUP BY ALL)
SELECT judgment_id AS id, string_agg(array_to_string({_SPLIT}[1:10], ' ') || ' ' || len({_SPLIT}) || ' ' || md5(t), ' ' ORDER BY batch) AS draft, 'ok' AS status FROM b GROUP BY judgment_id""")
def rolling_fold(spark, sf_dir):
    """H6 with a stand-in model."""
    batches = summaries.batch_texts(frags(spark, sf_dir)).select(F.col("judgment_id").alias("id"), "batch", F.col("batch_text").alias("input_text"), F.lit(10**9).alias("max_chars"))
    return summaries.rolling_fold(batches, _first_words)


@query(ORACLES["rolling_fold"])
def stored_fold(spark, sf_dir):
    """H6 in stored rounds with the same stand-in model; the second call finds all rounds made."""
    batches = summaries.batch_texts(frags(spark, sf_dir)).select(F.col("judgment_id").alias("id"), "batch", F.col("batch_text").alias("input_text"), F.lit(10**9).alias("max_chars"))
    at = new_folder(spark, "fold")
    summaries.stored_fold(batches, _first_words, at)
    return summaries.stored_fold(batches, _first_words, at)


@query(ORACLES["batch_texts"])
def bucketed_batches(spark, sf_dir):
    """Batches of the fragments of stored judgments, over bucketed tables."""
    at, f = new_folder(spark, "bucketed"), frags(spark, sf_dir)
    name = "courtlake_" + at.rsplit("-", 1)[-1]
    ids = f.select(F.col("judgment_id").alias("id")).distinct()
    held = bucketed.write_bucketed_fragments(f, f"{name}_fragments", f"{at}/fragments", 16)
    listed = bucketed.write_bucketed_catalog(ids, f"{name}_catalog", f"{at}/catalog", 16)
    found = summaries.batch_texts(catalog.fragments_of(listed, held), 4, 3)
    for part in ("fragments", "catalog"):
        spark.sql(f"DROP TABLE {name}_{part}")  # the files stay
    return found


def judgment_table(spark, sf_dir):
    i = F.col("doc_id")
    d = table(spark, sf_dir, "documents").dropDuplicates(["doc_id"])
    return d.select(i.cast("string").alias("id"), F.concat(F.lit("Case "), i.cast("string")).alias("case_name"), F.lit("[2020] SGHC 1").alias("citation"), F.format_string("2020-01-%02d", 1 + i % 28).alias("decision_date"),
                    F.col("text").alias("content_text"), F.when(i % 2 == 0, " Court view ").alias("court_summary"), F.lit(1).alias("has_content"), F.lit(None).cast("string").alias("summary"), F.size(F.split("text", "\n")).alias("fragment_count"))


_STRIPPED_BODY = "regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')"
_LIMIT = "(4000 + greatest(0, (n - 100) // 100) * 1000)"
_TEXT = "regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '') <> ''"


@query(f"""WITH {SQL_FRAGS}, {SQL_ATTEMPTS}, {_FAILURES}, r AS (SELECT judgment_id, ordinal, {_RENDER} AS t FROM frags),
s AS (SELECT *, row_number() OVER (PARTITION BY judgment_id ORDER BY ordinal) - 1 AS idx, count(*) OVER (PARTITION BY judgment_id) AS n FROM r WHERE t <> ''),
b AS (SELECT judgment_id, CAST(floor(idx / greatest(10, ceil(n / 20))) AS INTEGER) AS batch,
    string_agg(t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY idx) AS batch_text FROM s GROUP BY ALL),
d AS (SELECT CAST(doc_id AS VARCHAR) AS id, text, len(string_split(text, chr(10))) AS n FROM documents),
t AS (SELECT d.*, CASE WHEN coalesce(count, 0) < 3 THEN 'primary' WHEN count >= 6 AND epoch({_NOW}) - epoch(last_attempt) < 604800 THEN 'blocked' ELSE 'alternative' END AS tier
    FROM d LEFT JOIN failures USING (id))
SELECT id, coalesce(batch, 0) AS batch, coalesce(batch_text, CASE WHEN {_TEXT} THEN text END) AS input_text, CAST(n AS INTEGER) AS n_fragments, CAST({_LIMIT} AS INTEGER) AS max_chars,
    CAST(greatest(4096, {_LIMIT} // 2 + 1024) AS INTEGER) AS max_tokens, tier, 'Present case: Case ' || id || ' [2020] SGHC 1' AS anchor,
    CASE WHEN batch_text IS NOT NULL THEN 'fragments' WHEN {_TEXT} THEN 'body' ELSE 'error: nothing to read' END AS input_source
FROM t LEFT JOIN b ON b.judgment_id = id WHERE tier <> 'blocked'""")
def summary_inputs(spark, sf_dir):
    """Q4: P4, J4, J9, T2, J7, F19, W8, F17, F18, F21."""
    a = attempts(spark, sf_dir)
    return summaries.summary_inputs(judgment_table(spark, sf_dir), frags(spark, sf_dir), failures(a), now(a))


@query(f"""WITH RECURSIVE {SQL_FRAGS}, r0 AS (SELECT *, {_RENDER} AS t, class_name LIKE 'Judg-Heading-%' AS heading, class_name IN ('Judg-1', 'Judg-1-firstpara') AND paragraph_number IS NOT NULL AS numbered FROM frags),
r1 AS (SELECT judgment_id, ordinal, t, heading, numbered, length(t) + 2 AS size, CASE WHEN has_footnotes = 1 THEN 2.0 ELSE 0.0 END + CASE WHEN ordinal % 3 = 0 THEN 3.0 ELSE 0.0 END + CASE WHEN has_table = 1 THEN 0.5 ELSE 0.0 END + CAST(0.1 AS DOUBLE) * least(length(content_text), 500) / 100 AS score,
    row_number() OVER (PARTITION BY judgment_id, numbered ORDER BY paragraph_number, ordinal) AS a, row_number() OVER (PARTITION BY judgment_id, numbered ORDER BY paragraph_number DESC, ordinal DESC) AS z FROM r0),
r2 AS (SELECT *, heading OR (numbered AND (a = 1 OR z <= 3)) AS fixed FROM r1),
c AS (SELECT CAST(doc_id AS VARCHAR) AS judgment_id, CASE WHEN doc_id % 2 = 0 THEN 'Court view' END AS court, text FROM documents),
base AS (SELECT judgment_id, CAST(coalesce(sum(size) FILTER (WHERE fixed), 0) + coalesce(max(length(court) + 2), 0) AS BIGINT) AS used FROM r2 JOIN c USING (judgment_id) GROUP BY judgment_id),
k AS (SELECT judgment_id, ordinal, size, row_number() OVER (PARTITION BY judgment_id ORDER BY score DESC, ordinal) AS place FROM r2 WHERE NOT fixed AND NOT numbered),
g(judgment_id, place, used, ordinal, taken) AS (SELECT judgment_id, CAST(0 AS BIGINT), used, -1, false FROM base
    UNION ALL SELECT g.judgment_id, k.place, g.used + CASE WHEN g.used + k.size <= 2000 THEN k.size ELSE 0 END, k.ordinal, g.used + k.size <= 2000 FROM g JOIN k ON k.judgment_id = g.judgment_id AND k.place = g.place + 1),
filled AS (SELECT judgment_id, max(used) AS used FROM g GROUP BY judgment_id),
l AS (SELECT judgment_id, ordinal, size, row_number() OVER (PARTITION BY judgment_id ORDER BY z DESC) AS place FROM r2 WHERE numbered AND z <= 3),
o AS (SELECT l.judgment_id, l.ordinal FROM l JOIN filled f USING (judgment_id) WHERE f.used - coalesce((SELECT sum(b.size) FROM l b WHERE b.judgment_id = l.judgment_id AND b.place < l.place), 0) > 2000),
p AS (SELECT judgment_id, ordinal, t FROM r2 WHERE t <> '' AND (fixed OR (judgment_id, ordinal) IN (SELECT (judgment_id, ordinal) FROM g WHERE taken)) AND (judgment_id, ordinal) NOT IN (SELECT (judgment_id, ordinal) FROM o)),
j AS (SELECT judgment_id, string_agg(t, chr(10) || chr(10) ORDER BY ordinal) AS joined FROM p GROUP BY judgment_id)
SELECT c.judgment_id, CASE WHEN base.used IS NULL THEN substr(coalesce({_STRIPPED_BODY}, ''), 1, 2000) ELSE substr(concat_ws(chr(10) || chr(10), '## Court Summary' || chr(10) || court, joined), 1, 2000) END AS input_text
FROM c LEFT JOIN base USING (judgment_id) LEFT JOIN j USING (judgment_id)""")
def select_summary_input(spark, sf_dir):
    """Q5, T6, F20."""
    f = frags(spark, sf_dir).withColumn("section_heading", F.when(F.col("ordinal") % 3 == 0, "Holding"))
    return summaries.select_summary_input(judgment_table(spark, sf_dir), f, 2000)


# monitoring


def _builds(spark, sf_dir):
    a = attempts(spark, sf_dir)
    of = lambda t: F.count_if(F.col("event_type") == t)
    day = a.groupBy(F.col("phase").cast("string").alias("site"), F.col("run_id").alias("day")).agg(of("click").alias("extracted"), of("purchase").alias("summarised"), of("view").alias("records"), of("error").alias("failed"))
    i = F.dayofmonth("day")
    return day.select("site", "day", (i % 5 < 2).alias("blocked"), F.when(i % 4 == 0, 0).otherwise(F.col("extracted")).alias("extracted"), F.when(i % 7 < 4, 0).otherwise(F.col("summarised")).alias("summarised"),
                      (F.lit(1000) - 10 * (i % 9)).alias("extract_backlog"), (i % 3).alias("summary_backlog"), "records", (F.col("failed") * 60).cast("double").alias("seconds"))


_BUILDS = f"""{SQL_ATTEMPTS}, g AS (SELECT CAST(phase AS VARCHAR) AS site, run_id AS day, count(*) FILTER (WHERE event_type = 'click') AS e, count(*) FILTER (WHERE event_type = 'purchase') AS s, count(*) FILTER (WHERE event_type = 'view') AS records, count(*) FILTER (WHERE event_type = 'error') AS failed, CAST(substr(run_id, 9, 2) AS INTEGER) AS i FROM attempts GROUP BY ALL),
builds AS (SELECT site, day, i % 5 < 2 AS blocked, CASE WHEN i % 4 = 0 THEN 0 ELSE e END AS extracted, CASE WHEN i % 7 < 4 THEN 0 ELSE s END AS summarised, 1000 - 10 * (i % 9) AS extract_backlog, i % 3 AS summary_backlog, records, failed * 60 AS seconds FROM g)"""


@query(f"""WITH {_BUILDS}, w AS (SELECT *, count(*) FILTER (WHERE blocked) OVER (PARTITION BY site ORDER BY day ROWS 1 PRECEDING) AS b2, count(*) FILTER (WHERE summarised = 0 AND summary_backlog > 0) OVER (PARTITION BY site ORDER BY day ROWS 2 PRECEDING) AS i3,
    count(*) OVER (PARTITION BY site ORDER BY day ROWS 7 PRECEDING) AS n8, first_value(extract_backlog) OVER (PARTITION BY site ORDER BY day ROWS 7 PRECEDING) AS e8, first_value(summary_backlog) OVER (PARTITION BY site ORDER BY day ROWS 7 PRECEDING) AS s8 FROM builds)
SELECT site, day, 'blocked twice' AS anomaly FROM w WHERE b2 = 2 UNION ALL SELECT site, day, 'nothing extracted' FROM w WHERE extracted = 0 AND extract_backlog > 0 UNION ALL SELECT site, day, 'nothing summarised for three days' FROM w WHERE i3 = 3
UNION ALL SELECT site, day, 'extract backlog stuck' FROM w WHERE n8 = 8 AND extract_backlog > 0 AND e8 <= extract_backlog UNION ALL SELECT site, day, 'summary backlog stuck' FROM w WHERE n8 = 8 AND summary_backlog > 0 AND s8 <= summary_backlog
UNION ALL SELECT site, day, 'longer than two hours' FROM w WHERE seconds > 7200""")
def build_anomalies(spark, sf_dir):
    """W9."""
    return monitor.build_anomalies(_builds(spark, sf_dir))


@query(f"""WITH {_BUILDS} SELECT site, day, records > 0 OR extracted > 0 OR summarised > 0 AS advanced, coalesce(lag(extract_backlog) OVER w > extract_backlog OR lag(summary_backlog) OVER w > summary_backlog, false) AS backlog_fell
FROM builds WINDOW w AS (PARTITION BY site ORDER BY day)""")
def advanced_pipeline(spark, sf_dir):
    """W10."""
    return monitor.advanced_pipeline(_builds(spark, sf_dir))


@query(f"""WITH {_BUILDS}, w AS (SELECT *, count(*) FILTER (WHERE blocked) OVER (PARTITION BY site ORDER BY day ROWS 1 PRECEDING) AS b2, count(*) FILTER (WHERE summarised = 0 AND summary_backlog > 0) OVER (PARTITION BY site ORDER BY day ROWS 2 PRECEDING) AS i3,
    count(*) OVER w7 AS n8, first_value(extract_backlog) OVER w7 AS e8, first_value(summary_backlog) OVER w7 AS s8, lag(extract_backlog) OVER o AS e1, lag(summary_backlog) OVER o AS s1 FROM builds WINDOW w7 AS (PARTITION BY site ORDER BY day ROWS 7 PRECEDING), o AS (PARTITION BY site ORDER BY day))
SELECT site, day, records > 0 OR extracted > 0 OR summarised > 0 AS advanced, coalesce(e1 > extract_backlog OR s1 > summary_backlog, false) AS backlog_fell, array_to_string(list_sort(list_filter([
    CASE WHEN b2 = 2 THEN 'blocked twice' END, CASE WHEN extracted = 0 AND extract_backlog > 0 THEN 'nothing extracted' END, CASE WHEN i3 = 3 THEN 'nothing summarised for three days' END,
    CASE WHEN n8 = 8 AND extract_backlog > 0 AND e8 <= extract_backlog THEN 'extract backlog stuck' END, CASE WHEN n8 = 8 AND summary_backlog > 0 AND s8 <= summary_backlog THEN 'summary backlog stuck' END,
    CASE WHEN seconds > 7200 THEN 'longer than two hours' END], lambda x: x IS NOT NULL)), ',') AS anomalies FROM w""")
def monitor_builds(spark, sf_dir):
    """Q9: W9, W10 as one report per build."""
    return monitor.monitor(_builds(spark, sf_dir)).withColumn("anomalies", F.array_join("anomalies", ","))


_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN CASE phase WHEN 2 THEN 'extracted' ELSE 'summarised' END WHEN 'view' THEN CASE phase WHEN 2 THEN 'empty' ELSE 'cached' END ELSE 'quarantined' END"


def _phased(spark, sf_dir):
    return attempts(spark, sf_dir).withColumn("status", F.expr(_STATUS))


@query(f"WITH {SQL_ATTEMPTS}, s AS (SELECT *, {_STATUS} AS status FROM attempts) SELECT run_id, " + ", ".join(f"count(*) FILTER (WHERE phase = {p} AND status = '{s}') AS {s}_{p}" for p, all_s in ((2, ("extracted", "empty", "failed", "quarantined")), (3, ("summarised", "cached", "failed", "quarantined"))) for s in all_s) + " FROM s GROUP BY run_id")
def phase_counters(spark, sf_dir):
    """A7."""
    return monitor.phase_counters(_phased(spark, sf_dir))


@query(f"""WITH {SQL_ATTEMPTS}, c AS (SELECT run_id, CAST(substr(run_id, 9, 2) AS INTEGER) % 3 AS m, count(*) FILTER (WHERE event_type = 'click') AS extracted, count(*) FILTER (WHERE event_type = 'view') AS summarised, count(*) FILTER (WHERE event_type = 'error') AS backlog FROM attempts GROUP BY ALL),
d AS (SELECT run_id, m, CASE WHEN m = 0 THEN 0 ELSE extracted END AS extracted, CASE WHEN m = 0 THEN 0 ELSE summarised + 1 END AS summarised, backlog FROM c)
SELECT run_id, extracted, summarised, backlog AS extract_backlog, backlog + 1 AS summary_backlog, CASE WHEN m < 2 THEN 'discovery aborted (source down); ' ELSE '' END || 'phase2 +' || extracted || ' extracted (' || backlog || ' backlog); phase3 +' || summarised || ' summarised (' || (backlog + 1) || ' backlog)' AS notes, m = 0 AS blocked FROM d""")
def build_verdict(spark, sf_dir):
    """A8."""
    of = lambda t: F.count_if(F.col("event_type") == t)
    c = attempts(spark, sf_dir).groupBy("run_id").agg(of("click").alias("e"), of("view").alias("s"), of("error").alias("b")).withColumn("m", F.dayofmonth("run_id") % 3)
    idle = F.col("m") == 0
    counters = c.select("run_id", F.when(F.col("m") < 2, "source down").alias("abort_reason"), F.lit(0).alias("staged"), F.when(idle, 0).otherwise(F.col("e")).alias("extracted"), F.lit(0).alias("empty"), F.when(idle, 0).otherwise(F.col("s")).alias("summarised"),
                        F.when(idle, 0).otherwise(1).cast("long").alias("cached"), F.col("b").alias("extract_backlog"), (F.col("b") + 1).alias("summary_backlog"))
    return monitor.build_verdict(counters)


@query("""SELECT strftime(ts, '%Y-%m-%d') AS build, count(*) FILTER (WHERE event_type = 'click') AS succeeded, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type NOT IN ('click', 'error')) AS skipped,
    round(sum(value), 3) AS seconds, CAST(sum(event_id % 7) AS BIGINT) AS extracted, CAST(sum(1) AS BIGINT) AS summarised FROM events GROUP BY ALL""")
def summary_footer(spark, sf_dir):
    """A9."""
    e = table(spark, sf_dir, "events")
    reports = e.select(F.date_format("ts", "yyyy-MM-dd").alias("build"), F.when(F.col("event_type") == "click", "success").when(F.col("event_type") == "error", "failed").otherwise("skipped").alias("status"), F.col("value").alias("duration_s"),
                       F.create_map(F.lit("extracted"), F.col("event_id") % 7, F.lit("summarised"), F.lit(1).cast("long")).alias("extra_counts"))
    return monitor.summary_footer(reports).select("build", "succeeded", "failed", "skipped", F.round("seconds", 3).alias("seconds"), F.col("counters")["extracted"].alias("extracted"), F.col("counters")["summarised"].alias("summarised"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS status, 'm' || user_id % 3 AS model, 'SG' || user_id % 5 AS court, user_id % 2 = 0 AS alt, count(*) AS attempts FROM events GROUP BY ALL")
def progress_rollup(spark, sf_dir):
    """A10."""
    u = F.col("user_id")
    log = table(spark, sf_dir, "events").select(F.lit("attempt").alias("event"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.col("event_type").alias("status"), F.concat(F.lit("m"), (u % 3).cast("string")).alias("model"), F.concat(F.lit("SG"), (u % 5).cast("string")).alias("court"), (u % 2 == 0).alias("alt"))
    return monitor.progress_rollup(log)


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, 'e' || user_id % 2 AS endpoint, 'm' || user_id % 3 AS model, event_type AS call_type, CAST(sum(event_id % 100) AS BIGINT) AS prompt_tokens, CAST(sum(event_id % 10) AS BIGINT) AS completion_tokens, count(*) AS calls FROM events GROUP BY ALL")
def token_rollup(spark, sf_dir):
    """A11."""
    u, i = F.col("user_id"), F.col("event_id")
    log = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.concat(F.lit("e"), (u % 2).cast("string")).alias("endpoint"), F.concat(F.lit("m"), (u % 3).cast("string")).alias("model"), F.col("event_type").alias("call_type"), (i % 100).alias("prompt_tokens"), (i % 10).alias("completion_tokens"))
    return monitor.token_rollup(log)


@query(f"""SELECT m.*, p.* EXCLUDE (run_id), v.notes, v.blocked AS did_nothing, f.succeeded, f.failed AS failed_resources, f.skipped, r.attempts, r.alternative_attempts, t.prompt_tokens, t.completion_tokens, t.calls, s.*
FROM ({ORACLES['monitor_builds']}) m LEFT JOIN ({ORACLES['phase_counters']}) p ON p.run_id = m.day LEFT JOIN ({ORACLES['build_verdict']}) v ON v.run_id = m.day LEFT JOIN ({ORACLES['summary_footer']}) f ON f.build = m.day
LEFT JOIN (SELECT day, CAST(sum(attempts) AS BIGINT) AS attempts, CAST(coalesce(sum(attempts) FILTER (WHERE alt), 0) AS BIGINT) AS alternative_attempts FROM ({ORACLES['progress_rollup']}) GROUP BY day) r ON r.day = m.day
LEFT JOIN (SELECT day, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(calls) AS BIGINT) AS calls FROM ({ORACLES['token_rollup']}) GROUP BY day) t ON t.day = m.day,
({ORACLES['pipeline_state']}) s""")
def build_report(spark, sf_dir):
    """Q9: A3, A4, A7-A11, W9 and W10 in one row per build."""
    q = QUERIES
    parts = [q[n](spark, sf_dir) for n in ("phase_counters", "build_verdict", "summary_footer", "progress_rollup", "token_rollup")]
    found = monitor.build_report(_builds(spark, sf_dir), *parts, listing.state_catalog(spark, sf_dir))
    return found.withColumn("anomalies", F.array_join("anomalies", ","))


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'skip' WHEN 2 THEN 'fail' WHEN 3 THEN 'warn' ELSE 'summary' END AS kind, CASE WHEN event_id % 5 < 4 THEN event_type END AS resource, CASE WHEN event_id % 5 = 0 THEN user_id END AS records,
    CASE event_id % 5 WHEN 1 THEN 'proxy down' WHEN 2 THEN 'boom' WHEN 3 THEN 'slow' END AS message, CASE WHEN event_id % 5 = 1 THEN 'blocked' END AS skip_kind, CASE WHEN event_id % 5 <> 3 THEN 12.5 END AS seconds, CASE WHEN event_id % 5 IN (0, 4) THEN event_id END AS enriched FROM events""")
def status_lines(spark, sf_dir):
    """S9 on lines composed from events."""
    e = table(spark, sf_dir, "events")
    i, t, u = F.col("event_id"), F.col("event_type"), F.col("user_id").cast("string")
    n = i.cast("string")
    line = (
        F.when(i % 5 == 0, F.concat(F.lit("[OK  ] "), t, F.lit("  "), u, F.lit(" records; updated=50 enriched="), n, F.lit("  (12.5s)"))).when(i % 5 == 1, F.concat(F.lit("[SKIP] "), t, F.lit("  proxy down (blocked)  (12.5s)")))
        .when(i % 5 == 2, F.concat(F.lit("[FAIL] "), t, F.lit("  boom  (12.5s)"))).when(i % 5 == 3, F.concat(F.lit("WARN["), t, F.lit("]: slow"))).otherwise(F.concat(F.lit("SUMMARY: 1 succeeded, 0 failed, 2 skipped in 12.5s | enriched="), n, F.lit(" updated=1")))
    )
    parsed = files.parse_status_lines(e.select("event_id", line.alias("value")))
    return parsed.select("event_id", "kind", "resource", "records", "message", "skip_kind", "seconds", F.col("counters")["enriched"].alias("enriched"))


@query(f"""WITH {SQL_ATTEMPTS}, l AS (SELECT id, count(*) FILTER (WHERE NOT ok AND (c IS NULL OR (ts, seq) > c)) AS n FROM (SELECT *, max(CASE WHEN ok THEN (ts, seq) END) OVER (PARTITION BY id) AS c FROM attempts) GROUP BY id)
SELECT id, CAST(n AS INTEGER) AS count, CASE WHEN n < 1 THEN 'primary' WHEN n >= 2 THEN 'blocked' ELSE 'alternative' END AS tier FROM l""")
def stream_ledger(spark, sf_dir):
    """The ledger of all events as a stream, after its last batch; one failure is enough for the alternative, two block."""
    e = _event_stream(spark, sf_dir)
    a = e.select(F.col("user_id").cast("string").alias("id"), "ts", F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"), F.lit("e").alias("error"))
    at = _shared(spark)
    stream = streams.stream_ledger(a, F.lit("2000-01-01"), alternative=1, hard=2).select("id", "count", "tier")
    write = lambda b, k: b.withColumn("batch", F.lit(k)).write.mode("append").parquet(f"{at}/out")
    with _rocksdb(spark):
        stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out").groupBy("id").agg(F.max_by("count", "batch").alias("count"), F.max_by("tier", "batch").alias("tier"))


# streams


@contextmanager
def _rocksdb(spark):
    """The state store that stateful processors need; the session's own afterwards."""
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(store, before)


def _shared(spark) -> str:
    return new_folder(spark, "stream")


def _event_stream(spark, sf_dir):
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type AS status, 'm' || user_id % 2 AS model, count(*) AS attempts FROM events GROUP BY ALL")
def stream_progress(spark, sf_dir):
    """X1 over the events table as a stream."""
    log = _event_stream(spark, sf_dir).select(F.lit("attempt").alias("event"), F.col("ts").cast("string").alias("ts"), F.col("event_type").alias("status"), F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")).alias("model"))
    at = _shared(spark)

    def write(batch, _epoch):
        batch.select("start", "status", "model", "attempts").write.mode("overwrite").parquet(f"{at}/out")

    streams.stream_progress(log, "1 day").writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out")


@query("SELECT user_id AS id FROM events WHERE user_id % 3 <> 0 GROUP BY user_id")
def stream_new_items(spark, sf_dir):
    """Users as listing ids, each once and not in the catalogue."""
    at = _shared(spark)
    items = _event_stream(spark, sf_dir).select(F.col("user_id").alias("id"))
    spark.createDataFrame([], items.schema).write.parquet(f"{at}/out")

    def known():
        listed = table(spark, sf_dir, "events").filter("user_id % 3 = 0").select(F.col("user_id").alias("id")).distinct()
        return listed.unionByName(spark.read.parquet(f"{at}/out"))

    streams.stream_new_items(items, known, lambda df: df.write.mode("append").parquet(f"{at}/out"), f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{at}/out")


_FILES = 6
_SQL_DELIVERED = f"""d0 AS (SELECT *, date_diff('day', CAST((SELECT min(ts) FROM events) AS DATE), CAST(ts AS DATE)) AS day, (SELECT date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 FROM events) AS days FROM events),
delivered AS (SELECT * EXCLUDE (day, days), least(day * {_FILES} // days + CASE WHEN event_id % 10 = 0 THEN 3 ELSE 0 END, {_FILES - 1}) AS f FROM d0),
tops AS (SELECT f, max(ts) AS top FROM delivered GROUP BY f)"""


def _delivered(spark, sf_dir, late: bool):
    """Events as a stream of files in order of time; with `late`, each 10th event comes three files later."""
    e, at = table(spark, sf_dir, "events"), _shared(spark)
    span = e.agg(F.to_date(F.min("ts")).alias("low"), (F.datediff(F.max("ts"), F.min("ts")) + 1).alias("days"))
    shift = F.when(F.col("event_id") % 10 == 0, 3 if late else 0).otherwise(0)
    dealt = e.join(F.broadcast(span)).withColumn("f", F.least(F.expr(f"cast(datediff(ts, low) * {_FILES} div days as int)") + shift, F.lit(_FILES - 1))).drop("low", "days")
    for k in range(_FILES):
        dealt.filter(F.col("f") == k).drop("f").coalesce(1).write.mode("append").parquet(f"{at}/in")
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in"), at


@query(f"""WITH {_SQL_DELIVERED}, limits AS (SELECT a.f, (SELECT max(top) FROM tops b WHERE b.f <= a.f - 2) - INTERVAL 1 DAY AS mark FROM tops a),
e AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type AS status, 'm' || user_id % 2 AS model, coalesce(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= mark, false) AS late FROM delivered JOIN limits USING (f))
SELECT start, status, model, count(*) AS attempts, CASE WHEN start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) THEN 'closed' ELSE 'open' END AS state FROM e WHERE NOT late GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, count(*), 'late' FROM e WHERE late""")
def stream_progress_late(spark, sf_dir):
    """X1 in append mode: windows leave the state behind the watermark, late rows are left out and counted."""
    log, at = _delivered(spark, sf_dir, late=True)
    log = log.select(F.lit("attempt").alias("event"), F.col("ts").cast("string").alias("ts"), F.col("event_type").alias("status"), F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")).alias("model"))
    write = streams.stream_progress(log, "1 day", "1 day").writeStream.outputMode("append").format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state")
    write.trigger(availableNow=True).start().awaitTermination()
    columns = ["start", "status", "model", "attempts"]
    closed = spark.read.parquet(f"{at}/out").select(*columns, F.lit("closed").alias("state"))
    kept = closed.unionByName(streams.open_windows(spark, f"{at}/state").select(*columns, F.lit("open").alias("state")))
    read = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("read"))
    late = kept.agg(F.coalesce(F.sum("attempts"), F.lit(0)).alias("kept")).join(F.broadcast(read)).select((F.col("read") - F.col("kept")).alias("attempts"))
    none = {"start": "timestamp", "status": "string", "model": "string"}
    return kept.unionByName(late.select(*(F.lit(None).cast(t).alias(c) for c, t in none.items()), "attempts", F.lit("late").alias("state")))


@query(f"""WITH {SQL_ATTEMPTS}, {_LEDGER}, l AS (SELECT DISTINCT a.id, coalesce(g.count, 0) AS n, g.last_attempt FROM attempts a LEFT JOIN ledger g USING (id))
SELECT id, CAST(n AS INTEGER) AS count, CASE WHEN n < 1 THEN 'primary' WHEN n >= 2 AND (SELECT max(ts) FROM events) <= last_attempt + INTERVAL 3 DAY THEN 'blocked' ELSE 'alternative' END AS tier FROM l""")
def stream_ledger_timers(spark, sf_dir):
    """X4 with timers: two failures in a row block an id for three days after its last attempt."""
    e, at = _delivered(spark, sf_dir, late=False)
    a = e.select(F.col("user_id").cast("string").alias("id"), "ts", F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("ok"), F.lit("e").alias("error"))
    stream = streams.stream_ledger_timed(a, alternative=1, hard=2, seconds=3 * 86_400).select("id", "count", "tier", "at")
    write = lambda b, k: b.withColumn("batch", F.lit(k)).write.mode("overwrite").parquet(f"{at}/out/batch_no={k}")
    with _rocksdb(spark):
        stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    last = F.struct("batch", "at")
    return spark.read.parquet(f"{at}/out").groupBy("id").agg(F.max_by("count", last).alias("count"), F.max_by("tier", last).alias("tier"))
