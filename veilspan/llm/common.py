"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more rows than this, and than 1 / HOT_SHARE of all rows, is joined by broadcast: HOT_SHARE keys at most.
HOT_ROWS, HOT_SHARE = 1_000, 100_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share, as spark.checkpoint.dir names it.

    Where none is set, a local session gets a temporary one, removed at exit; a
    cluster, whose machines could not read each other's folders, gets an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not (spark.sparkContext.master or "").split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="veilspan-checkpoint-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back; the files go when the application ends.

    This cuts the lineage like checkpoint() does, but keeps column pruning and
    gives the planner a size, so that small tables are broadcast and large ones
    are not.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    there, files = _hadoop(spark, path)
    files.deleteOnExit(there)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a materialized table that nothing will read again."""
    there, files = _hadoop(df.sparkSession, df._written_to)
    files.delete(there, True)


def _hadoop(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def hot_limit(rows: int) -> int:
    return max(HOT_ROWS, rows // HOT_SHARE)


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, how: str = "left") -> DataFrame:
    """left join right, where right has one row for a key and hot holds the keys of many rows of left.

    Rows of a hot key stay where they are and right's few rows for them are
    broadcast; the others are shuffled. hot has HOT_SHARE rows at most, if its keys
    were chosen by hot_limit().
    """
    hot = materialize(hot.select(*keys).join(right, keys), "hot")
    if hot.isEmpty():
        return left.join(right, keys, how)
    there = left.join(F.broadcast(hot), keys)
    return there.unionByName(left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(right, keys, how))


def n_words(text: Column) -> Column:
    """The number of words without building them: word starts are counted."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of doc_id as text, mod k; a null id falls in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % k, F.lit(0)).cast("int")
