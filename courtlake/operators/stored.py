"""Stored tables: changes that rewrite only the buckets they touch, and pages that open only the files that hold them.

A table in buckets lies in folders ``bucket=<n>`` by a hash of its key.  A change finds the buckets in which it alters a row,
writes these anew and leaves all other files as they are.  A change that has been made alters nothing when it is repeated.
One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.operators import catalog as tables
from courtlake.operators import summaries
from courtlake.sources.scratch import delete, new_folder

BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def store(table: DataFrame, path: str, key: str = "id", order: str | None = None, buckets: int = BUCKETS) -> None:
    """Write a table in buckets, one file each, in the order of its key."""
    dealt = table.withColumn("bucket", bucket_of(key, buckets)).repartition(buckets, "bucket")
    dealt.sortWithinPartitions("bucket", key, *([order] if order else [])).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    return (reader.schema(f"{schema}, bucket int") if schema else reader).parquet(path)


def _rewrite(rows: DataFrame, path: str, key: str, touched: list[int]) -> None:
    """Put `rows` in place of the touched buckets; what is left without rows goes."""
    spark, at = rows.sparkSession, new_folder(rows.sparkSession, "rewrite")
    rows.repartition("bucket").sortWithinPartitions("bucket", key).write.parquet(at)  # whole before anything is replaced
    made = spark.read.schema(rows.schema).parquet(at)
    left = {r.bucket for r in made.select("bucket").distinct().collect()}
    made.repartition("bucket").sortWithinPartitions("bucket", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    for n in sorted(set(touched) - left):
        delete(spark, f"{path}/bucket={n}")
    delete(spark, at)


def _kept(df: DataFrame) -> tuple[DataFrame, str]:
    """A change as a table of its own, since it may come from the table that it changes."""
    at = new_folder(df.sparkSession, "change")
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at), at


def _touched(buckets: DataFrame) -> list[int]:
    return sorted(r.bucket for r in buckets.select("bucket").distinct().collect())  # as many as there are buckets at most


def change(spark: SparkSession, path: str, changes: DataFrame, columns: list[str], key: str = "id", buckets: int = BUCKETS) -> int:
    """J8 on a stored table: the listed columns of the rows with the keys of `changes`; how many buckets were written anew."""
    delta, at = _kept(changes.select(key, *columns).withColumn("bucket", bucket_of(key, buckets)))
    table = read(spark, path)
    new = delta.select("bucket", key, *(F.col(c).alias(f"_{c}") for c in columns))
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    touched = _touched(table.join(new, ["bucket", key]).filter(~same))
    if touched:
        rows = table.filter(F.col("bucket").isin(touched))
        _rewrite(tables.apply_updates(rows, delta.filter(F.col("bucket").isin(touched)), columns, key), path, key, touched)
    delete(spark, at)
    return len(touched)


def put(spark: SparkSession, path: str, rows: DataFrame, key: str = "id", buckets: int = BUCKETS) -> int:
    """Whole rows added, in place of those with their keys; how many buckets were written anew."""
    table = read(spark, path)
    columns = [c for c in table.columns if c != "bucket"]
    delta, at = _kept(rows.select(*columns).withColumn("bucket", bucket_of(key, buckets)))
    row = F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias("_row")
    touched = _touched(delta.select("*", row).join(table.select("bucket", key, row), ["bucket", key, "_row"], "left_anti"))
    if touched:
        here = F.col("bucket").isin(touched)
        old = table.filter(here).join(delta.select("bucket", key), ["bucket", key], "left_anti").select(table.columns)
        _rewrite(old.unionByName(delta.filter(here)), path, key, touched)
    delete(spark, at)
    return len(touched)


def remove(spark: SparkSession, path: str, ids: DataFrame, key: str = "id", buckets: int = BUCKETS) -> int:
    """Rows of the ids taken out; how many buckets were written anew."""
    gone, at = _kept(ids.select(key).distinct().withColumn("bucket", bucket_of(key, buckets)))
    table = read(spark, path)
    touched = _touched(table.join(gone, ["bucket", key], "left_semi"))
    if touched:
        rows = table.filter(F.col("bucket").isin(touched)).join(gone, ["bucket", key], "left_anti").select(table.columns)
        _rewrite(rows, path, key, touched)
    delete(spark, at)
    return len(touched)


def write_back_summaries(spark: SparkSession, catalog: str, cache: str, drafts: DataFrame, now: str, model: str, endpoint: str, buckets: int = BUCKETS) -> DataFrame:
    """Q6: drafts (id, draft, n_fragments) finished; those that pass go to the cache and then to the catalogue.

    Gives (id, status, detail) of every draft: ok with the number of characters, or an error with the failed checks for the ledger.
    """
    found, at = _kept(summaries.finish_summaries(drafts).join(drafts.select("id", F.col("n_fragments").cast("int").alias("frags_total")), "id"))
    good = found.filter("passed")
    entry = good.select(F.col("id").alias("judgment_id"), F.lit(now).alias("generated_at"), F.lit(model).alias("model"), F.lit(endpoint).alias("endpoint"), "frags_total", "summary")
    put(spark, cache, entry, "judgment_id", buckets)
    change(spark, catalog, good.select("id", "summary", F.lit(now).alias("summary_generated_at")), ["summary", "summary_generated_at"], buckets=buckets)
    detail = F.when(F.col("passed"), F.concat(F.length("summary").cast("string"), F.lit(" chars"))).otherwise(F.concat(F.lit("smell_test: "), F.array_join("issues", "; ")))
    return found.select("id", F.when(F.col("passed"), "ok").otherwise("error").alias("status"), detail.alias("detail"))


def write_back_audit(spark: SparkSession, catalog: str, cache: str, buckets: int = BUCKETS) -> DataFrame:
    """Q7 with U6: repaired summaries are stored, hopeless ones nulled and their cached copies dropped; the records of the audit."""
    found, at = _kept(summaries.audit_records(read(spark, catalog)))
    fixed = found.filter("action = 'fixed'").select("id", F.col("repaired").alias("summary"))
    change(spark, catalog, fixed, ["summary"], buckets=buckets)
    none = F.lit(None).cast("string")
    hopeless = found.filter("action = 'nullified'").select("id", none.alias("summary"), none.alias("summary_generated_at"))
    # the cache first: a summary that is null and cached would come back
    remove(spark, cache, hopeless.select(F.col("id").alias("judgment_id")), "judgment_id", buckets)
    change(spark, catalog, hopeless, ["summary", "summary_generated_at"], buckets=buckets)
    return found


# pages of a table in order


def store_ordered(table: DataFrame, path: str, files: int, date: str = "decision_date") -> None:
    """A table as files of ranges, newest first, then by id, with the first key and the number of rows of each file."""
    order = [F.desc_nulls_last(date), F.asc("id")]
    table.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/rows")
    named = table.sparkSession.read.parquet(f"{path}/rows").select(F.col("_metadata.file_path").alias("file"), date, "id")
    first = F.min(F.struct(F.col(date).isNull().alias("none"), F.translate(date, "0123456789", "9876543210").alias("back"), "id"))
    named.groupBy("file").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/files")


def ordered_page(spark: SparkSession, path: str, page: int = 1, size: int = 25, date: str = "decision_date") -> DataFrame:
    """One page of a stored table, newest first; only the files that hold its rows are opened."""
    rows = spark.read.parquet(f"{path}/rows")
    begin, before, wanted, skip = (page - 1) * size, 0, [], 0
    for r in spark.read.parquet(f"{path}/files").orderBy("first").toLocalIterator():  # one row a file
        if before < begin + size and before + r.n > begin:
            skip = skip if wanted else begin - before
            wanted.append(r.file)
        before += r.n
        if before >= begin + size:
            break
    if not wanted:
        return rows.limit(0)
    return spark.read.schema(rows.schema).parquet(*wanted).orderBy(F.desc_nulls_last(date), "id").offset(skip).limit(size)
