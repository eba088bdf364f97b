"""Files as DataFrames: corpus, link lists, logs, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.frontmatter import read_field, read_list, read_text
from ..functions.urls import canonical_url, unescape_path

README = "README.md"


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``), text of every Markdown file; an empty frame where there is no such folder."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
        return spark.createDataFrame([], "path string, text string")
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    found = unescape_path(F.col("_metadata.file_path"))
    base = root.split("://")[-1].rstrip("/") + "/"
    return files.select(F.substring_index(found, base, -1).alias("path"), F.col("value").alias("text"))


def fields(corpus: DataFrame) -> DataFrame:
    """path, text and the header's fields. A scan of columns takes the place of reading only the head of a file."""
    names = ("title", "source", "source_url", "doc_type", "category", "status", "etag", "last_modified", "retrieved_at")
    text = F.col("text")
    return corpus.select("path", "text", *(read_text(text, n).alias(n) for n in names), read_list(text, "also_available_from").alias("also_available_from"))


def source_index(corpus: DataFrame) -> DataFrame:
    """url, path, etag, last_modified: one row a canonical URL. The last path wins."""
    text = F.col("text")
    url = read_field(text, "source_url")
    entry = F.struct("path", read_text(text, "etag").alias("etag"), read_text(text, "last_modified").alias("last_modified"))
    return corpus.where(url.isNotNull()).groupBy(canonical_url(url).alias("url")).agg(F.max_by(entry, "path").alias("e")).select("url", "e.*")


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """ord, url of a list of links, or of a folder of lists in the order of their names; blank lines and comments are left out. ord grows along the files, with gaps.

    Lines are numbered within each block that one task reads; no block has more lines than
    bytes. A file's places begin after the bytes of those before it.
    """
    read = spark.read.text(path)
    sizes = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    before = sizes.select("file", (F.sum("size").over(W.orderBy("file")) - F.col("size")).alias("before"))  # a row a file
    lines = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    numbered = lines.withColumn("nth", F.row_number().over(W.partitionBy("file", "block").orderBy("at"))).join(before, "file")
    place = 2 * (F.col("before") + F.col("block")) + F.col("nth")
    return numbered.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(place.alias("ord"), F.trim("value").alias("url"))


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """url: what a log says is done, canonical and distinct."""
    return spark.read.text(path).where(F.trim("value") != "").select(canonical_url(F.col("value")).alias("url")).distinct()


def first_seen(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """The keys, each with its least place."""
    return rows.groupBy(*keys).agg(F.min(place).alias(place))


def union_links(*parts: DataFrame) -> DataFrame:
    """ord, url over several lists, each after the one before, the first of equal URLs kept. ord grows along the lists, with gaps: nothing is sorted."""
    out = None
    for i, part in enumerate(parts):
        own = part.select((F.lit(i << 40) + F.col("ord").cast("long")).alias("ord"), canonical_url(F.col("url")).alias("url"))
        out = own if out is None else out.unionByName(own)
    return first_seen(out, ["url"], "ord").select("ord", "url")


def append_lines(lines: list[str], path: str) -> None:
    """Adds lines to a log on the driver."""
    with open(path, "a", encoding="utf-8") as f:
        f.writelines(f"{x}\n" for x in lines)
