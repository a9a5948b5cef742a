"""Archive, index and stored-table queries: tables written from the given ones, taken in batch by batch, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.operators import catalog, ledger, monitor
from courtlake.plans import judgments, operations
from courtlake.plans.registry import ORACLES, QUERIES, SQL_ATTEMPTS, SQL_FRAGS, SQL_LISTED, attempts, frags, listed, query, table
from courtlake.sources import bucketed, files
from courtlake.sources.files import SUMMARY
from courtlake.sources.scratch import new_folder
from courtlake.streaming import archive, streams


def _deliver(df, key, value, at):
    """One compressed text file for each row, named after its key; rows of one key lie in one partition."""
    files.write_each(df.select(key.alias("id"), value.alias("value")), at)


def _dealt(df, key):
    """Rows by a key over all tasks: a row costs a file however short it is, so Spark mustn't join partitions by their bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), key)


@query("""SELECT CAST(page_id AS VARCHAR) AS id, length(html) AS n_chars, CASE WHEN page_id % 10 = 3 THEN 1 ELSE 0 END AS batch, page_id % 10 = 3 AS late FROM pages WHERE html IS NOT NULL""")
def archive_pages(spark, sf_dir):
    """Pages as one compressed file each, in two deliveries; the second run reads the new files only."""
    p, at = table(spark, sf_dir, "pages").filter("html is not null"), new_folder(spark, "archive")
    key = F.col("page_id").cast("string")
    runs = []
    for part in ("page_id % 10 <> 3", "page_id % 10 = 3"):
        _deliver(_dealt(p.filter(part), "page_id"), key, F.col("html"), f"{at}/in")
        runs.append(archive.ingest_pages(spark, f"{at}/in", f"{at}/out", name=files.EACH_NAME, glob=files.EACH_GLOB))
    new = p.filter("page_id % 10 = 3").count()
    if runs[1]["files"] != new:
        raise ValueError(f"the second run read {runs[1]['files']} files, {new} are new")
    got = archive.read_archive(spark, f"{at}/out")
    late = F.col("batch") >= runs[0]["batches"]  # it came in a batch of the second run
    # a text file ends with a line break
    return got.select("id", (F.length("html") - 1).cast("long").alias("n_chars"), late.cast("int").alias("batch"), late.alias("late"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 7 <> 6 THEN substr(text, 1, 40) END AS summary, CASE WHEN doc_id % 7 <> 6 THEN CAST(doc_id % 100 AS INTEGER) END AS frags_total,
    CASE WHEN doc_id % 7 = 6 THEN 'json' END AS reason FROM documents WHERE text IS NOT NULL""")
def archive_summaries(spark, sf_dir):
    """Cached summaries as one JSON file each, every 7th cut short; good rows and the side table of corrupt files."""
    d, at = table(spark, sf_dir, "documents").filter("text is not null"), new_folder(spark, "summaries")
    i = F.col("doc_id")
    whole = F.to_json(F.struct(i.cast("string").alias("judgment_id"), F.substring("text", 1, 40).alias("summary"), (i % 100).cast("int").alias("frags_total")))
    _deliver(_dealt(d.select(i, F.substring("text", 1, 40).alias("text")), "doc_id"), i.cast("string"), F.when(i % 7 == 6, F.substring(whole, 1, 20)).otherwise(whole), f"{at}/in")
    archive.ingest_summaries(spark, f"{at}/in", f"{at}/out", name=files.EACH_NAME, glob=files.EACH_GLOB, files=5000)
    good = archive.read_archive(spark, f"{at}/out", f"id string, {SUMMARY}").select("id", "summary", "frags_total", F.lit(None).cast("string").alias("reason"))
    bad = archive.read_corrupt(spark, f"{at}/out").select("id", F.lit(None).cast("string").alias("summary"), F.lit(None).cast("int").alias("frags_total"), "reason")
    return good.unionByName(bad)


@query(ORACLES["progress_rollup"])
def progress_log_round_trip(spark, sf_dir):
    """The progress log written as JSON lines and read back."""
    u, at = F.col("user_id"), new_folder(spark, "progress")
    log = table(spark, sf_dir, "events").select(
        F.lit("attempt").alias("event"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.col("event_type").alias("status"), F.concat(F.lit("m"), (u % 3).cast("string")).alias("model"),
        F.concat(F.lit("SG"), (u % 5).cast("string")).alias("court"), (u % 2 == 0).alias("alt"))
    files.write_payload(log, at)
    return monitor.progress_rollup(files.read_progress_log(spark, at))


@query(ORACLES["token_rollup"])
def token_log_round_trip(spark, sf_dir):
    """The token log written as JSON lines and read back."""
    u, i, at = F.col("user_id"), F.col("event_id"), new_folder(spark, "tokens")
    log = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.concat(F.lit("e"), (u % 2).cast("string")).alias("endpoint"), F.concat(F.lit("m"), (u % 3).cast("string")).alias("model"),
        F.col("event_type").alias("call_type"), (i % 100).alias("prompt_tokens"), (i % 10).alias("completion_tokens"))
    files.write_payload(log, at, agent="builder")
    return monitor.token_rollup(files.read_token_log(spark, at))


@query(f"""WITH {SQL_FRAGS} SELECT judgment_id, ordinal, content_text FROM frags WHERE doc_id % 5 <> 0 UNION ALL SELECT judgment_id, ordinal, 'new' FROM frags WHERE doc_id % 5 = 0 AND ordinal = 0""")
def replaced_fragments(spark, sf_dir):
    """Stored fragments of every 5th judgment replaced, by folders of buckets."""
    f, at = frags(spark, sf_dir).select("judgment_id", "doc_id", "ordinal", "content_text"), new_folder(spark, "fragments")
    files.replace_fragments(f, at)
    new = f.filter("doc_id % 5 = 0 and ordinal = 0").withColumn("content_text", F.lit("new"))
    touched = [r.bucket for r in new.select(F.pmod(F.xxhash64("judgment_id"), F.lit(64)).cast("int").alias("bucket")).distinct().collect()]  # 64 at most
    held = spark.read.parquet(at).filter(F.col("bucket").isin(touched)).drop("bucket")
    files.replace_fragments(catalog.replace_for(held, new), at)
    return spark.read.parquet(at).select("judgment_id", "ordinal", "content_text")


@query("SELECT CAST(doc_id AS VARCHAR) AS judgment_id, n_chars AS input_chars, 'large' AS model, 'https://models' AS endpoint, '2026-07-16' AS generated_at FROM documents")
def payload_round_trip(spark, sf_dir):
    """Results as JSON with time, model and endpoint."""
    at = new_folder(spark, "payload")
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("judgment_id"), F.col("n_chars").alias("input_chars"))
    files.write_payload(rows, at, model="large", endpoint="https://models", generated_at="2026-07-16")
    return spark.read.schema("judgment_id string, input_chars long, model string, endpoint string, generated_at string").json(at)


@query(ORACLES["audit"])
def audit_report_round_trip(spark, sf_dir):
    """The report of an audit as JSON."""
    at = new_folder(spark, "audit")
    files.write_audit_report(QUERIES["audit"](spark, sf_dir), at)
    return spark.read.schema("id string, issues string, action string, repaired string").json(at)


@query(ORACLES["extract_fragments"])
def stream_extract_pages(spark, sf_dir):
    """Detail pages as a stream of files, every 5th of them twice; fragments as extract_fragments gives them."""
    pages, at = judgments.detail_html(spark, sf_dir), new_folder(spark, "pages")
    number = F.pmod(F.xxhash64("id"), F.lit(10))
    pages.filter(number < 6).coalesce(1).write.parquet(f"{at}/in")
    pages.filter((number >= 6) | (number < 2)).coalesce(1).write.mode("append").parquet(f"{at}/in")
    source = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    streams.stream_extract(source, judgments.NOW, f"{at}/out", f"{at}/log").trigger(availableNow=True).start().awaitTermination()
    return judgments.shown_fragments(spark.read.parquet(f"{at}/out"))


@query(f"""WITH {SQL_ATTEMPTS}, failures AS (SELECT id, count(*) % 8 AS count, max(ts) AS last_attempt FROM attempts WHERE NOT ok GROUP BY id),
d AS (SELECT CAST(doc_id AS VARCHAR) AS id, '2020-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS decision_date FROM documents),
t AS (SELECT d.*, coalesce(count, 0) AS n, CASE WHEN coalesce(count, 0) < 3 THEN 'primary' WHEN count >= 6 AND epoch((SELECT max(ts) + INTERVAL 1 HOUR FROM events)) - epoch(last_attempt) < 604800 THEN 'blocked' ELSE 'alternative' END AS tier
    FROM d LEFT JOIN failures USING (id))
SELECT id, tier FROM t WHERE tier <> 'blocked' ORDER BY n >= 3 DESC, decision_date DESC, id LIMIT 50""")
def next_summaries(spark, sf_dir):
    """The next 50 judgments to summarise, those that failed often first, then the newest."""
    a = attempts(spark, sf_dir)
    tiered = ledger.with_tier(catalog.summary_backlog(operations.judgment_table(spark, sf_dir)), operations.failures(a), operations.now(a))
    return catalog.newest(tiered.filter("tier <> 'blocked'"), 50, F.desc("priority")).select("id", "tier")


@query(ORACLES["ledger_from_attempts"])
def ledger_round_trip(spark, sf_dir):
    """The ledger as failure maps, one JSON file for each of eight groups of ids, and read back."""
    at = new_folder(spark, "ledger")
    found = ledger.ledger_from_attempts(attempts(spark, sf_dir))
    entry = F.struct(F.col("count").cast("int").alias("count"), "last_error", F.col("last_attempt").cast("string").alias("last_attempt"))
    maps = found.groupBy(F.pmod(F.xxhash64("id"), F.lit(8)).alias("part")).agg(F.map_from_entries(F.collect_list(F.struct("id", entry))).alias("failures"))
    maps.select("part", F.to_json(F.struct("failures")).alias("value")).repartition("part").write.partitionBy("part").text(at)
    read = files.read_ledger(spark, at)
    return read.select("id", F.col("count").cast("long").alias("count"), "last_error", F.col("last_attempt").cast("timestamp_ntz").alias("last_attempt"))


@query(f"""WITH {SQL_FRAGS} SELECT judgment_id AS id, CAST(count(*) AS INTEGER) AS fragments, CAST(sum(length(content_text)) AS BIGINT) AS chars, CAST(max(ordinal) AS INTEGER) AS last, NULL AS reason
FROM frags WHERE doc_id % 11 <> 4 GROUP BY judgment_id UNION ALL SELECT DISTINCT judgment_id, NULL, NULL, NULL, 'json' FROM frags WHERE doc_id % 11 = 4""")
def archive_extractions(spark, sf_dir):
    """Cached parses with their fragments as one JSON file each, every 11th cut short."""
    at = new_folder(spark, "extractions")
    f = frags(spark, sf_dir).select("judgment_id", "doc_id", "ordinal", "content_text")
    rows = F.sort_array(F.collect_list(F.struct("ordinal", "content_text")))
    parsed = f.groupBy("judgment_id", "doc_id").agg(rows.alias("fragments")).withColumn("whole", F.to_json(F.struct("judgment_id", "fragments")))
    text = F.when(F.col("doc_id") % 11 == 4, F.substring("whole", 1, 30)).otherwise(F.col("whole"))
    _deliver(parsed, F.col("judgment_id"), text, f"{at}/in")
    archive.ingest_extractions(spark, f"{at}/in", f"{at}/out", name=files.EACH_NAME, glob=files.EACH_GLOB)
    each = F.aggregate("fragments", F.lit(0).cast("long"), lambda a, x: a + F.length(x["content_text"]))
    good = archive.read_archive(spark, f"{at}/out", f"id string, {files.EXTRACTION}")
    good = good.select("id", F.size("fragments").alias("fragments"), each.alias("chars"), F.array_max(F.transform("fragments", lambda x: x["ordinal"])).alias("last"), F.lit(None).cast("string").alias("reason"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    bad = archive.read_corrupt(spark, f"{at}/out").select("id", none("int", "fragments"), none("long", "chars"), none("int", "last"), "reason")
    return good.unionByName(bad)


@query(f"""WITH {SQL_LISTED}, known AS (SELECT id FROM listed WHERE page_id % 3 = 0) SELECT 'total' AS kind, count(*) AS n FROM listed
UNION ALL SELECT 'new', count(*) FROM listed WHERE id NOT IN (SELECT id FROM known) UNION ALL SELECT 'known', count(*) FROM listed WHERE id IN (SELECT id FROM known)""")
def staging_counts(spark, sf_dir):
    """New listing rows staged, with the counts that the write itself took."""
    rows = listed(spark, sf_dir)
    known = rows.filter("page_id % 3 = 0").select("id", F.lit(True).alias("known")).distinct()
    marked = rows.join(known, "id", "left")
    new = F.col("known").isNull()
    counts = bucketed.write_counted(marked, new_folder(spark, "staged"), keep=new, total=F.count(F.lit(1)), new=F.count_if(new), known=F.count_if(~new))
    return spark.createDataFrame(sorted(counts.items()), "kind string, n long")


@query("""WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS build, event_type AS name, user_id FROM events),
n AS (SELECT build, name, count(*) AS records, count(DISTINCT user_id) AS users FROM e GROUP BY ALL)
SELECT build, CASE WHEN max(records) OVER (PARTITION BY build) > 2 THEN 'success' ELSE 'partial' END AS build_status, name, CASE WHEN name = 'error' THEN 'failed' ELSE 'success' END AS status, records, users FROM n""")
def build_reports(spark, sf_dir):
    """A build report as one JSON file a day, with a resource for each type of event."""
    at, e = new_folder(spark, "reports"), table(spark, sf_dir, "events")
    counted = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("build"), F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("user_id").alias("users"))
    status = F.when(F.col("name") == "error", "failed").otherwise("success")
    resource = F.struct("name", status.alias("status"), "records", F.create_map(F.lit("users"), "users").alias("extra_counts"))
    builds = counted.groupBy("build").agg(F.collect_list(resource).alias("resources"), F.max("records").alias("most"))
    report = F.struct(F.when(F.col("most") > 2, "success").otherwise("partial").alias("status"), "resources")
    builds.select("build", F.to_json(report).alias("value")).repartition("build").write.partitionBy("build").text(at)
    read = files.read_build_reports(spark, at, r"/build=([^/]+)/")
    return read.select("build", "build_status", "name", "status", "records", F.col("extra_counts")["users"].alias("users"))
