"""The corpus as a table partitioned by folder: a merge writes the folders again that it touches, and no others.

``root/files/part=<folder>`` has url, path, text, replaced by dynamic partition overwrite;
``root/manifest/part=<folder>`` has a row a folder: its number of rows, a digest that doesn't
depend on their order, and the merge that wrote it. Files come first, then the manifest: a
merge that dies between them leaves folders that :func:`differing` names; :func:`repair`
takes them up into the manifest, and running the merge again then makes them right, since a
merge by URL gives the same rows twice.

Which folders are touched follows from keys alone (url and path: the texts of other folders
aren't read). Their names come to the driver, as many as there are categories at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corpus
from .tables import discard, kept, remove_path

ROW = "url string, path string, text string"


def part() -> Column:
    """The folder that ``path`` is in."""
    return F.coalesce(F.nullif(F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1), F.lit("")), F.lit(".")).alias("part")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read(spark: SparkSession, root: str) -> DataFrame:
    """url, path, text, part; empty before the first merge."""
    schema = f"{ROW}, part string"
    return spark.read.schema(schema).parquet(f"{root}/files") if _exists(spark, f"{root}/files") else spark.createDataFrame([], schema)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """part, n, digest, merge: what the last merges wrote."""
    schema = "n long, digest string, merge string, part string"
    found = spark.read.schema(schema).parquet(f"{root}/manifest") if _exists(spark, f"{root}/manifest") else spark.createDataFrame([], schema)
    return found.select("part", "n", "digest", "merge")


def digest() -> Column:
    """Of rows in any order: two sums of hashes, wide enough not to overflow."""
    one = lambda *salt: F.sum(F.xxhash64("url", "path", "text", *map(F.lit, salt)).cast("decimal(38,0)")).cast("string")
    return F.concat_ws(":", one(), one(1))


def _overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def merge(spark: SparkSession, root: str, incoming: DataFrame, name: str) -> DataFrame:
    """Merges incoming (ord, url, wanted, text) into the corpus; returns the changes: url, path, old_path, action.

    name: of the merge, for the manifest; a merge that is repeated has its name.
    """
    old = read(spark, root)
    new = kept(incoming.select("ord", "url", "wanted", "text"), "store-incoming")
    # Keys first: an incoming text counts by its digest, and one that isn't there by none.
    marked = lambda df, text: df.withColumn("text", F.when(text.isNotNull(), F.sha2(text, 256)))
    touched = old.select("url", "path").join(new.select("url").distinct(), "url", "left_semi").select(part())
    near = [r.part for r in touched.distinct().collect()]
    same = marked(old.where(F.col("part").isin(near)), F.col("text")).unionByName(old.where(~F.col("part").isin(near)).withColumn("text", F.lit(None).cast("string")))
    changes = kept(corpus.upsert(same.select("url", "path", "text"), marked(new, F.col("text"))).where("action not in ('kept', 'same')").select("url", "path", "old_path", "action"), "store-changes")
    parts = changes.select(part()).unionByName(changes.where("old_path is not null").select(F.col("old_path").alias("path")).select(part())).distinct()
    due = [r.part for r in parts.collect()]
    if not due:
        discard(new)
        return changes
    first = new.groupBy("url").agg(F.min_by("text", F.struct("ord", "wanted")).alias("new_text"))
    held = old.where(F.col("part").isin(due)).select("url", "path", "text").join(changes.select("url"), "url", "left_anti")
    # A document that a name's new owner pushed aside keeps its text, which may lie in any folder.
    pushed = changes.join(first.select("url"), "url", "left_anti").select("url", "path").join(old.select("url", "text"), "url")
    taken = changes.join(first, "url").select("url", "path", F.col("new_text").alias("text"))
    rows = held.unionByName(pushed).unionByName(taken).withColumn("part", part())
    left = {r.part for r in rows.select("part").distinct().collect()}  # of keys alone
    _overwrite(rows.repartition("part", F.pmod(F.xxhash64("url"), F.lit(16))), f"{root}/files")
    for emptied in set(due) - left:
        _drop(spark, root, emptied)
    _record(spark, root, due, name)
    discard(new)
    return changes


def _record(spark: SparkSession, root: str, parts: list[str], name: str) -> None:
    _overwrite(read(spark, root).where(F.col("part").isin(parts)).groupBy("part").agg(F.count("*").alias("n"), digest().alias("digest")).withColumn("merge", F.lit(name)), f"{root}/manifest")


def _drop(spark: SparkSession, root: str, folder: str) -> None:
    """A folder that a merge has emptied: dynamic overwrite leaves folders without a new row as they are."""
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(folder)
    for table in ("files", "manifest"):
        remove_path(spark, f"{root}/{table}/part={named}")


def differing(spark: SparkSession, root: str) -> DataFrame:
    """part of folders that aren't as the manifest has them: a merge died there and is to be run again."""
    now = read(spark, root).groupBy("part").agg(F.count("*").alias("n"), digest().alias("digest"))
    said = manifest(spark, root).select("part", F.col("n").alias("m"), F.col("digest").alias("was"))
    return now.join(said, "part", "full_outer").where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("digest").eqNullSafe(F.col("was")))).select("part")


def repair(spark: SparkSession, root: str, name: str) -> list[str]:
    """Folders that a dead merge left are recorded as they are, those that it emptied dropped; returns their names."""
    parts = [r.part for r in differing(spark, root).collect()]
    if parts:
        there = {r.part for r in read(spark, root).where(F.col("part").isin(parts)).select("part").distinct().collect()}
        for emptied in set(parts) - there:
            _drop(spark, root, emptied)
        _record(spark, root, parts, name)
    return parts
