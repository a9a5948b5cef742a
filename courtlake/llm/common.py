"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most rows and bytes of a table that is broadcast; beyond either a shuffled join is used.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
#: Bytes of an Arrow batch between Spark and Python where the session sets no limit of its own.  Its buffers lie outside the JVM's
#: heap, and what is freed of them stays with the executor; buffers of several megabytes leave much more there.
BATCH_BYTES = 1 << 20


def _bytes(value: Column, kind: T.DataType) -> Column:
    """Size of a value in memory, from above."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            each = F.transform(value, lambda x: _bytes(x, kind.elementType))
            return F.coalesce(F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")) + 24
        return F.coalesce(F.size(value), F.lit(0)) * 8 + 24
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind), F.lit(16).cast("long"))
    return F.lit(16 if isinstance(kind, T.DecimalType) else 8)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Mark for broadcast only if a bounded count proves that the table has at most `rows` rows of `size` bytes in all."""
    each = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(24).cast("long"))
    found = df.select(each.alias("b")).limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if found.n <= rows and found.b <= size else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares.  A machine-local one serves only a session whose master is local."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write once to the cluster's shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables made by stored() that no later result reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: its cleaner follows the driver's garbage collection."""
    gc.collect()
    spark._jvm.System.gc()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text columns alone, named doc_id (long) and text: extra columns can't clash with an operator's own.

    Sets the session's limit of bytes in an Arrow batch, unless the user has set one.
    """
    conf, limit = documents.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(limit, None) is None:
        conf.set(limit, str(BATCH_BYTES))
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
