"""The corpus pipeline over documents: toxicity, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.  All but the last return the
columns of documents.  Empty tables give empty tables.  Null and empty texts are clean, similar to nothing, hold no passage
and pack as an end token alone, so their rows stay to the end.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtlake.llm import decontaminate, ngram_join, packing, substring, toxicity
from courtlake.llm.common import broadcast_if_small, drop_stored, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model doesn't reject.  The model is fitted to the labels of the documents.

    Every row is judged by its own text, also if its id is null or repeated; equal rows fare alike.  Without labels all stay.
    """
    model = toxicity.fit(docs, toxicity.label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    rows = _keyed(docs)
    return _without(rows, toxicity.severity(rows, model, id_col=ROW).filter("toxic").select("doc_id"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component of the n-gram join: five words, a similarity of 0.8.

    Of rows that repeat an id the one with the smallest hash of its text stays.  Rows with a null id stay.
    """
    linked = stored(ngram_join.link_components(docs, size=5, percent=80))
    copies = stored(linked.filter("component_id <> doc_id").select("doc_id").distinct())
    kept = docs.join(broadcast_if_small(copies), "doc_id", "left_anti").select(docs.columns)
    again = stored(linked.groupBy("doc_id").count().filter("doc_id is not null and count > 1").select("doc_id"))
    drop_stored(linked)
    if again.isEmpty():
        return kept
    repeated = broadcast_if_small(again)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*docs.columns)))
    one = kept.join(repeated, "doc_id", "left_semi").withColumn(ROW, place).filter(F.col(ROW) == 1)
    return kept.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(one.select(docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the document of smallest id only; a document of nothing else goes.

    Ids are unique here, as the stage before leaves one row of each; rows with a null id stay as they are.
    """
    found = substring.repeated_passages(docs, min_words=50, percent=80)
    cut = substring.cut_passages(docs, found)
    touched = found.select(F.col("doc_id").alias("_cut")).distinct()
    joined = cut.join(broadcast_if_small(touched), F.col("doc_id") == F.col("_cut"), "left")
    joined = joined.filter(F.col("_cut").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return joined.withColumn("n_chars", F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any 10-word window of a benchmark item.

    Every row is judged by its own text, also if its id is null or repeated.  Without benchmark items all stay.
    """
    rows = _keyed(docs)
    judged = decontaminate.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, id_col=ROW)
    return _without(rows, judged.filter("contaminated").select("doc_id"), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, rows with a null or repeated id too."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


#: Key of a row by its id and text.
ROW = "_stage_row"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW, F.xxhash64("doc_id", "text"))


def _without(rows: DataFrame, rejected: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, with their key, whose key is not among the rejected."""
    keys = stored(rejected.select(F.col("doc_id").alias(ROW)).distinct())
    return rows.join(broadcast_if_small(keys), ROW, "left_anti").select(columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]
#: Tokenising and the model have no SQL; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            drop_stored(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
