"""Fragments and catalogue as bucketed, sorted tables, so that joins and windows by judgment need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

BUCKETS = 64


def write_bucketed(table: DataFrame, name: str, path: str, key: str, *order: str, buckets: int = BUCKETS) -> DataFrame:
    """Write `table` in buckets of `key`, each one file sorted by key and `order`, as an external table of the session.

    Rows are dealt by the buckets' own hash first, so that a bucket is written by one task.  The table stays in the session's
    catalogue under `name`; dropping it leaves the files.
    """
    dealt = table.repartition(buckets, key).sortWithinPartitions(key, *order)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name)
    return table.sparkSession.table(name)


def write_bucketed_fragments(fragments: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Fragments by judgment, in reading order."""
    return write_bucketed(fragments, name, path, "judgment_id", "ordinal", buckets=buckets)


def write_bucketed_catalog(catalog: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The catalogue by id, in as many buckets as its fragments."""
    return write_bucketed(catalog, name, path, "id", buckets=buckets)


def write_counted(rows: DataFrame, path: str, mode: str = "append", keep: Column | None = None, **counts: Column) -> dict[str, int]:
    """Write the rows of `keep` (all if none) and count all rows by the given aggregates in the same job.

    Counts come from the tasks that end the write; a stage before it that runs again does not count twice, as they are
    taken behind its shuffle.
    """
    seen = Observation()
    observed = rows.observe(seen, *(c.alias(name) for name, c in counts.items()))
    (observed if keep is None else observed.filter(keep)).write.mode(mode).parquet(path)
    return {k: v or 0 for k, v in seen.get.items()}


def insert_counted(spark: SparkSession, path: str, new: DataFrame, *order: str) -> dict[str, int]:
    """U2 on a stored table: rows with new ids appended, the first by `order` of each; how many were added and ignored."""
    known = spark.read.parquet(path).select("id", F.lit(True).alias("_known")).distinct()
    place = F.row_number().over(Window.partitionBy("id").orderBy(*order, F.xxhash64(*new.columns)))
    marked = new.withColumn("_place", place).join(known, "id", "left")
    added = F.col("_known").isNull() & (F.col("_place") == 1)
    # the filter's columns go after the count
    flagged = marked.select(*new.columns, added.alias("_added"))
    seen = Observation()
    counted = flagged.observe(seen, F.count_if("_added").alias("added"), F.count_if(~F.col("_added")).alias("ignored"))
    counted.filter("_added").drop("_added").write.mode("append").parquet(path)
    return {k: v or 0 for k, v in seen.get.items()}
