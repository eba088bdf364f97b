"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of a batch that crosses to a Python worker: texts are held few at a time on both sides.
BATCH, BATCH_KEY = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's batches to ``BATCH`` rows, unless they are smaller already."""
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= BATCH:
        spark.conf.set(BATCH_KEY, BATCH)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster must name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="sijill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended; the folder belongs to the cluster
        pass


#: Whether a query's shuffle files go as soon as it ends; otherwise they stay until the driver happens to collect its garbage.
CLEAN_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors. The shuffle files that it took are gone then."""
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark)}/sijill/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    clean = spark.conf.get(CLEAN_KEY)
    spark.conf.set(CLEAN_KEY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_KEY, clean)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(schema).parquet(path)
    out.kept_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes kept tables that nothing will read again."""
    for t in tables:
        if path := getattr(t, "kept_path", None):
            _remove(t.sparkSession, path)


def sent(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``df``, a kept table of numbers, to be broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def settle(spark: SparkSession) -> None:
    """Lets the cluster drop shuffle files that only finished steps needed: it does so when the driver's references are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh(name: str, columns: list[str]) -> str:
    """A column name that starts as ``name`` and clashes with none of ``columns``, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def others(df: DataFrame, *results: str) -> list[str]:
    """Columns of ``df`` that stay beside result columns: one with a result's name is replaced by the result."""
    named = {r.lower() for r in results}
    return [c for c in df.columns if c.lower() not in named]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
