"""Readers and writers: page archives, cached JSON, logs, build reports, published tables."""

from __future__ import annotations

import gzip
import os
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAGMENT = (
    "id string, judgment_id string, ordinal int, paragraph_number int, class_name string, section_heading string, content_text string, html_raw string, footnote_text string,"
    " has_footnotes boolean, has_table boolean, has_figure boolean, figure_src string, figure_descriptions string"
)
EXTRACTION = f"judgment_id string, extracted_at string, content_text string, court_summary string, has_content boolean, has_court_summary boolean, fragments array<struct<{FRAGMENT.replace(' string', ':string').replace(' int', ':int').replace(' boolean', ':boolean')}>>, extraction_status string"
SUMMARY = "judgment_id string, generated_at string, model string, endpoint string, frags_total int, summary string, input_chars int, frags_kept int"
PROGRESS = (
    "event string, ts string, remaining long, model string, model_alt string, priority_quarantined long, n long, id string, citation string, court string, status string, detail string, alt boolean,"
    " successes long, cached long, failures long, skipped_quarantined long"
)
TOKENS = "ts string, agent string, endpoint string, model string, prompt_tokens long, completion_tokens long, call_type string"
RESOURCE = "name:string,status:string,records:long,duration_s:double,error_message:string,traceback:string,fragments_records:long,skip_reason:string,skip_kind:string,warnings:array<string>,extra_counts:map<string,bigint>,notes:string"
REPORT = f"status string, total_duration_s double, resources array<struct<{RESOURCE}>>, build_warnings array<string>, fts_error string, fatal_error string, post_hook struct<command:string,exit_code:int,stdout:string,stderr:string>"
CORRUPT = "_corrupt_record"
#: The id in the path of a file of write_each(), and the names of these files; they lie in so many folders.
EACH_NAME, EACH_GLOB, EACH_FOLDERS = r"/id=([^/.]*)[/.]", "*.txt.gz", 256


def _stem(pattern: str):
    return F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)


def read_page_archive(spark: SparkSession, path: str) -> DataFrame:
    """(id, html) of one compressed page per file; unreadable files are misses."""
    files = spark.read.option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(_stem(r"^(.*?)\.html(?:\.gz)?$").alias("id"), F.col("value").alias("html")).filter("html is not null")


def corrupt_archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, size) of archive files of which read_page_archive() gives no page, for a quarantine folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    read = read_page_archive(spark, path).select("id").distinct()
    found = listed.select(name.alias("file_name"), F.regexp_extract(name, r"^(.*?)\.html(?:\.gz)?$", 1).alias("id"), F.col("length").alias("size"))
    return found.join(read, "id", "left_anti").select("file_name", "size")


def _read_json(spark: SparkSession, path: str, schema: str, multi_line: bool) -> DataFrame:
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("multiLine", multi_line).option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    return reader.json(path).withColumn("file_name", F.col("_metadata.file_name"))


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    """Cached parses, one JSON per id, with their fragments; corrupt files keep their name and text."""
    return _read_json(spark, path, EXTRACTION, True)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """S3: cached summaries, one JSON per id."""
    return _read_json(spark, path, SUMMARY, True)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows, and the others for a quarantine folder, with file_name and the text in _corrupt_record."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "file_name")
    return good, df.filter(F.col(CORRUPT).isNotNull())


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Failure map to rows; a corrupt file is an empty ledger."""
    parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", "failures map<string,struct<count:int,last_error:string,last_attempt:string>>").alias("f"))
    return parsed.select(F.explode("f.failures").alias("id", "entry")).select("id", "entry.*")


def read_progress_log(spark: SparkSession, path: str) -> DataFrame:
    """S6."""
    return spark.read.schema(PROGRESS).json(path)


def read_token_log(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    return spark.read.schema(TOKENS).json(path)


def read_build_reports(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """One row per build (file) and resource.  A build is named by its file, or by the first group of `name` in its path."""
    build = _stem(r"^(.*?)\.json$") if name is None else F.regexp_extract("_metadata.file_path", name, 1)
    reader = spark.read.schema(REPORT).option("multiLine", True).option("recursiveFileLookup", name is not None)
    builds = reader.json(path).select(build.alias("build"), F.col("status").alias("build_status"), "total_duration_s", "resources")
    return builds.select("build", "build_status", "total_duration_s", F.inline("resources"))


def parse_status_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Status lines of a build log as rows; lines of other forms are left out.

    kind is ok, fail, skip, warn, summary, fts_error, post_hook or fatal; counters are the key=value pairs of a line.
    """
    v = F.rtrim(F.col(column))
    part = lambda p, k=1: F.regexp_extract(v, p, k)
    box = r"^\[(OK|FAIL|SKIP)\s*\]\s+(\S+)\s+(.*?)\s*(?:\(([\d.]+)s\))?$"
    tag = F.lower(part(box))
    other = F.when(v.startswith("WARN["), "warn").when(v.startswith("SUMMARY:"), "summary").when(v.startswith("FTS_ERROR:"), "fts_error").when(v.startswith("POST_HOOK:"), "post_hook").when(v.startswith("FATAL:"), "fatal")
    kind = F.when(tag != "", tag).otherwise(other)
    body = part(box, 3)
    main = F.regexp_extract(body, r"^(.*?)(?:;\s*(?:\w+=-?\d+\s*)+)?$", 1)
    tail = F.when(kind == "summary", part(r"\|\s*(.*)$")).when(kind.isin("ok", "skip"), F.regexp_extract(body, r";\s*((?:\w+=-?\d+\s*)+)$", 1)).otherwise("")
    counters = F.map_from_arrays(F.regexp_extract_all(tail, F.lit(r"(\w+)=(-?\d+)"), F.lit(1)), F.transform(F.regexp_extract_all(tail, F.lit(r"(\w+)=(-?\d+)"), F.lit(2)), lambda x: x.cast("long")))
    reason = r"^(.*?)\s*\((up_to_date|blocked|disabled)\)\s*$"
    has_kind = main.rlike(reason)
    message = F.when(kind == "fail", main).when((kind == "skip") & has_kind, F.regexp_extract(main, reason, 1)).when(kind == "warn", part(r"^WARN\[[^\]]*\]:\s*(.*)$")).when(kind.isin("fts_error", "post_hook", "fatal"), part(r"^[A-Z_]+:\s*(.*)$"))
    seconds = F.when(kind == "summary", part(r"in ([\d.]+)s")).otherwise(part(box, 4)).try_cast("double")
    return lines.select(
        "*", kind.alias("kind"), F.when(tag != "", part(box, 2)).when(kind == "warn", part(r"^WARN\[([^\]]*)\]")).alias("resource"), F.when(kind == "ok", F.regexp_extract(main, r"(\d+) records", 1)).try_cast("long").alias("records"),
        message.alias("message"), F.when(kind == "skip", F.when(has_kind, F.regexp_extract(main, reason, 2)).otherwise("up_to_date")).alias("skip_kind"), seconds.alias("seconds"), counters.alias("counters"),
    ).filter("kind is not null")


def write_catalog(catalog: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The catalogue, partitioned by court."""
    catalog.write.mode(mode).partitionBy("court").parquet(path)


def write_fragments(fragments: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Fragments, each judgment in one file and in order."""
    fragments.repartition("judgment_id").sortWithinPartitions("judgment_id", "ordinal").write.mode(mode).parquet(path)


def replace_fragments(fragments: DataFrame, path: str, buckets: int = 64) -> None:
    """Fragments by bucket of judgments; only the folders of buckets in `fragments` are replaced."""
    bucket = F.pmod(F.xxhash64("judgment_id"), F.lit(buckets)).cast("int")
    ordered = fragments.withColumn("bucket", bucket).repartition("bucket", "judgment_id").sortWithinPartitions("judgment_id", "ordinal")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def write_payload(payload: DataFrame, path: str, **stamps) -> None:
    """Parse or summary results as JSON, with columns such as timestamp, model and endpoint added."""
    payload.withColumns({k: F.lit(v) for k, v in stamps.items()}).write.mode("overwrite").json(path)


def write_audit_report(audited: DataFrame, path: str) -> None:
    """S12."""
    audited.write.mode("overwrite").json(path)


def _each(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, seen, attempt = set(), Counter(), uuid.uuid4().hex
        for batch in batches:
            for i, value in zip(*batch.columns, strict=True):
                i, value = i.as_py() or "", value.as_py() or ""
                at = f"{folder}/shard={zlib.crc32(i.encode()) % EACH_FOLDERS}"
                if at not in made:
                    os.makedirs(at, exist_ok=True)
                    made.add(at)
                with open(f"{at}/.{attempt}", "wb") as f:
                    f.write(gzip.compress(f"{value}\n".encode(), 6, mtime=0))
                os.replace(f.name, f"{at}/id={i}.{seen[i]}.txt.gz")  # whole or not at all, and the same if the task is repeated
                seen[i] += 1
        yield pa.RecordBatch.from_arrays([pa.array([seen.total()], pa.int64())], ["n"])

    return write


def write_each(rows: DataFrame, path: str) -> None:
    """Rows (id, value) as one compressed text file each, added to those in `path`; rows of one id lie in one partition.

    Where the folder is one of the file system, shared or local, its files are written directly: Hadoop starts a process for the
    rights of each file there, and moves the folders one by one in the driver.  In another store Spark writes a folder for each id.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    to = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(hadoop).toUri()
    dealt = rows.select(F.col("id").cast("string").alias("id"), F.col("value").cast("string").alias("value"))
    if to.getScheme() == "file":
        dealt.mapInArrow(_each(to.getPath()), "n long").write.format("noop").mode("overwrite").save()
    else:
        sharded = dealt.withColumn("shard", F.crc32(F.encode("id", "utf-8")) % EACH_FOLDERS)
        sharded.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("shard", "id").option("compression", "gzip").text(path)
