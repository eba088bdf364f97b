"""Tables in the folder that driver and executors share: they cut lineage, and outlive executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local master gets a folder of its own; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="sijill-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Pages of a batch that crosses to a Python worker.
PAGES, BATCH_KEY = 500, "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's batches to ``PAGES`` rows, unless they are smaller already."""
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= PAGES:
        spark.conf.set(BATCH_KEY, PAGES)


def remove_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: what several later steps read is made once. It goes when the process ends, or by :func:`discard`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sijill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)

    def drop() -> None:
        try:
            remove_path(spark, path)
        except Exception:  # the session has ended; the folder belongs to the cluster
            pass

    atexit.register(drop)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes kept tables that nothing reads again."""
    for t in tables:
        if path := getattr(t, "kept_path", None):
            remove_path(t.sparkSession, path)
