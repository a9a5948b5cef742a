"""Archives of one file per id as streams of files, compacted into bucketed Parquet.

Spark's file source keeps the log of files seen, so a run opens only the files that came since the last one.  Each
micro-batch writes one folder, ``batch=<n>``, of at most `buckets` files in place of its many small ones, and writes it anew if
it is repeated: a run that was cut off leaves neither gaps nor doubles.  Files that can't be read go to a side table with
their name and the reason, and are not read again.

A run reads in a session of its own, with settings for many small files: few tasks list them, and a task opens as many as fill
it.  With Spark's own settings each path is listed by a task, and a task opens 32 files at most.

A folder looks like this: ``<target>/good/batch=0/bucket=7/part-...`` and ``<target>/corrupt/batch=0/part-...``.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.sources.files import CORRUPT, EXTRACTION, SUMMARY

PAGE_NAME = r"([^/]+?)\.html(?:\.gz)?$"
JSON_NAME = r"([^/]+?)\.json(?:\.gz)?$"

#: Files of one batch at most: the driver holds a few KB for each file of a batch, and a few hundred bytes for each other one.
FILES = 32_000
#: Characters of text that `_texts` holds before it passes them on.
HELD = 4 << 20


def _session(spark: SparkSession) -> SparkSession:
    """A session with the settings of `spark` but for those that many small files need."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", max(256, spark.sparkContext.defaultParallelism))  # less than 1 MB of each
    own.conf.set("spark.sql.files.openCostInBytes", "16k")
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", 1_000_000)  # all batches of a run are counted
    return own


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents as text: gzip undone where the name says so, with the reason where that or UTF-8 fails."""
    for batch in batches:
        rows, held = [], 0
        for name, size, content in zip(*batch.columns, strict=True):
            name, raw, reason, text = name.as_py(), content.as_py(), None, None
            try:
                text = (gzip.decompress(raw) if name.endswith(".gz") else raw).decode()
            except (OSError, EOFError, zlib.error) as e:
                reason = f"gzip: {e}"
            except UnicodeDecodeError as e:
                reason = f"utf-8: {e.reason}"
            rows.append((name, size.as_py(), text, reason))
            held += len(text or "")
            if held >= HELD:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["file_name", "size", "text", "reason"])


def _opened(files: DataFrame, name: str) -> DataFrame:
    """(id, file_name, size, text, reason) of a batch of binary files."""
    found = files.select("path", "length", "content").mapInArrow(_texts, "file_name string, size long, text string, reason string")
    return found.select(F.regexp_extract("file_name", name, 1).alias("id"), "file_name", "size", "text", "reason")


def _pages(opened: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = opened.filter("reason is null").select("id", F.col("text").alias("html"), "size")
    return good, opened.filter("reason is not null").select("id", "file_name", "size", "reason")


def _json(schema: str) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    def split(opened: DataFrame) -> tuple[DataFrame, DataFrame]:
        parsed = opened.withColumn("j", F.from_json("text", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}))
        wrong = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("j").isNull() | F.col(f"j.{CORRUPT}").isNotNull(), F.lit("json"))
        marked = parsed.withColumn("reason", wrong)
        good = marked.filter("reason is null").select("id", "j.*").drop(CORRUPT)
        return good, marked.filter("reason is not null").select("id", "file_name", "size", "reason")

    return split


def _ingest(spark: SparkSession, source: str, target: str, name: str, split, buckets: int, files: int | None, glob: str) -> dict[str, int]:
    reader = _session(spark).readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)

    def write(batch: DataFrame, epoch: int) -> None:
        opened = _opened(batch, name).persist()  # both tables come from one reading of the files
        try:
            good, corrupt = split(opened)
            bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
            good.withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", "id").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/good/batch={epoch}")
            corrupt.repartition("id").write.mode("overwrite").parquet(f"{target}/corrupt/batch={epoch}")
        finally:
            opened.unpersist()

    query = reader.load(source).writeStream.foreachBatch(write).option("checkpointLocation", f"{target}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["numInputRows"]]
    return {"batches": len(done), "files": sum(p["numInputRows"] for p in done)}


def ingest_pages(spark: SparkSession, source: str, target: str, buckets: int = 64, files: int | None = FILES, name: str = PAGE_NAME, glob: str = "*") -> dict[str, int]:
    """New page files of an archive, plain or gzip, into `target`; how many batches and files the run read.

    The first group of `name` in a file's path is the id.  `files` bounds the files of one batch; None
    makes one batch of them all.
    """
    return _ingest(spark, source, target, name, _pages, buckets, files, glob)


def ingest_extractions(spark: SparkSession, source: str, target: str, buckets: int = 64, files: int | None = FILES, schema: str = EXTRACTION, name: str = JSON_NAME, glob: str = "*") -> dict[str, int]:
    """New cached parses, one JSON per id, likewise."""
    return _ingest(spark, source, target, name, _json(schema), buckets, files, glob)


def ingest_summaries(spark: SparkSession, source: str, target: str, buckets: int = 64, files: int | None = FILES, schema: str = SUMMARY, name: str = JSON_NAME, glob: str = "*") -> dict[str, int]:
    """S3: new cached summaries, one JSON per id, likewise."""
    return _ingest(spark, source, target, name, _json(schema), buckets, files, glob)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_archive(spark: SparkSession, target: str, schema: str = "id string, html string, size long, batch int, bucket int") -> DataFrame:
    """Everything that has been taken in, with the batch it came in; `schema` is that of an archive without files."""
    return _read(spark, f"{target}/good", schema)


def archived(spark: SparkSession, target: str, ids: list[str], buckets: int = 64) -> DataFrame:
    """Rows of a few ids: only the folders of their buckets are read."""
    wanted = spark.createDataFrame([(i,) for i in ids], "id string").select("id", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("b"))
    folders = sorted({r.b for r in wanted.collect()})
    return read_archive(spark, target).filter(F.col("bucket").isin(folders)).join(F.broadcast(wanted.select("id")), "id", "left_semi")


def read_corrupt(spark: SparkSession, target: str) -> DataFrame:
    """Files that could not be read, with size and reason."""
    return _read(spark, f"{target}/corrupt", "id string, file_name string, size long, reason string, batch int")
