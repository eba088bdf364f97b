"""Aggregates of a run: result rows (ord, url, status, title, doc_type, reason, warnings) to counts and a report."""

from __future__ import annotations

import io
from typing import TextIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the type of documents without one.
NO_TYPE = "غير محدد"

# Headings of the report's parts.
PARTS = {1: "توزيع الأنواع", 2: "الفشل", 3: "التحذيرات"}


def status_counts(results: DataFrame, skipped: int = 0) -> DataFrame:
    ok = F.col("status") == "ok"
    return results.agg(
        F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "unchanged").alias("unchanged"),
        F.count_if(ok & (F.size("warnings") > 0)).alias("warned"), F.lit(skipped).cast("long").alias("skipped"),
    )


def type_histogram(results: DataFrame) -> DataFrame:
    """doc_type, n, first: documents by type, most first, ties as first seen."""
    kind = F.coalesce(F.nullif(F.col("doc_type"), F.lit("")), F.lit(NO_TYPE))
    return results.where("status = 'ok'").groupBy(kind.alias("doc_type")).agg(F.count("*").alias("n"), F.min("ord").alias("first")).orderBy(F.desc("n"), "first")


def lines(results: DataFrame, stamp: str, skipped: int = 0) -> DataFrame:
    """part, rank, ord, n, line: the report as rows, in this order.

    Part 0 has the counts, the others a heading and entries: types by number, failures and
    warnings by link. A part without entries isn't there at all.
    """
    order = lambda part, rank, ord: (F.lit(part).alias("part"), rank.cast("long").alias("rank"), ord.cast("long").alias("ord"))
    listed = lambda *texts: F.posexplode(F.array_compact(F.array(*texts))).alias("n", "line")
    count = lambda label, name: F.format_string(f"- {label}: **%d**", name)
    counts = status_counts(results, skipped).select(
        *order(0, F.lit(0), F.lit(0)),
        listed(
            F.lit(f"# تقرير الاستيراد — {stamp}"), F.lit(""), count("نجح", "ok"), count("فشل", "failed"), count("تُخطّي (مكتمل سابقًا)", "skipped"),
            F.when(F.col("unchanged") > 0, count("بلا تغيير منذ آخر جلب", "unchanged")), count("بتحذيرات", "warned"), F.lit(""),
        ),
    )
    ok, failed = F.col("status") == "ok", F.col("status") == "failed"
    types = type_histogram(results).select(*order(1, -F.col("n"), F.col("first")), listed(F.format_string("- %s: %d", "doc_type", "n")))
    failures = results.where(failed).select(*order(2, F.lit(0), F.col("ord")), listed(F.format_string("- `%s` — %s", "url", "reason")))
    warned = results.where(ok & (F.size("warnings") > 0))
    named = F.concat(F.lit("- **"), F.coalesce(F.nullif("title", F.lit("")), "url"), F.lit("**"))
    warnings = warned.select(*order(3, F.lit(0), F.col("ord")), F.posexplode(F.concat(F.array(named), F.transform("warnings", lambda w: F.concat(F.lit("  - "), w)))).alias("n", "line"))
    entries = types.unionByName(failures).unionByName(warnings)
    heading = F.element_at(F.create_map(*(F.lit(x) for pair in PARTS.items() for x in pair)), F.col("part"))
    ends = entries.groupBy("part").agg(F.max(F.lit(1)).alias("there"))
    above = ends.select("part", F.lit(-(1 << 62)).alias("rank"), F.lit(0).cast("long").alias("ord"), listed(F.concat(F.lit("## "), heading), F.lit("")))
    below = ends.select("part", F.lit(1 << 62).alias("rank"), F.lit(0).cast("long").alias("ord"), listed(F.lit("")))
    return counts.unionByName(entries).unionByName(above).unionByName(below).orderBy("part", "rank", "ord", "n")


def write_summary(results: DataFrame, stamp: str, out: TextIO, skipped: int = 0) -> None:
    """The report as Markdown, line by line; nothing but a partition of it is held. Blank lines at its end are left out."""
    blank = 0
    for r in lines(results, stamp, skipped).toLocalIterator():
        if r.line:
            out.write("\n" * blank + r.line + "\n")
        blank = 0 if r.line else blank + 1


def summary(results: DataFrame, stamp: str, skipped: int = 0) -> str:
    """The report of a run that is known to be small, as one text."""
    out = io.StringIO()
    write_summary(results, stamp, out, skipped)
    return out.getvalue()


def index(corpus_fields: DataFrame) -> DataFrame:
    """path, entry: a JSON object of the fields that are there, by path components. corpus_fields: see sources.files.fields."""
    also = F.when(F.size("also_available_from") > 0, F.col("also_available_from")).alias("also_available_from")
    names = ("title", "doc_type", "category", "status", "source", "source_url")
    files = corpus_fields.where(F.element_at(F.split("path", "/"), -1) != "README.md")
    return files.select("path", F.to_json(F.struct("path", *names, also)).alias("entry")).orderBy(F.split("path", "/"))


def stale(old: DataFrame, new: DataFrame) -> DataFrame:
    """change ('removed' or 'added') and entry: what tells two indexes apart; empty if neither is stale."""
    return old.select("path", "entry").exceptAll(new.select("path", "entry")).withColumn("change", F.lit("removed")).unionByName(new.select("path", "entry").exceptAll(old.select("path", "entry")).withColumn("change", F.lit("added")))


#: Ranges that a folder's files are dealt into.
DEALT = 16


def ranged(entries: DataFrame) -> DataFrame:
    """entries (path, entry) with the range that each belongs to: its folder, and a share of that by hash."""
    return entries.select(F.substring_index("path", "/", 1).alias("folder"), F.pmod(F.xxhash64("path"), F.lit(DEALT)).cast("int").alias("share"), "path", "entry")


def digests(entries: DataFrame, *by: str) -> DataFrame:
    """n, digest of entries by range, by folder or of all: sums of hashes, so that a range's parts are added up wherever they lie."""
    mark = lambda salt: F.sum(F.xxhash64("path", "entry", F.lit(salt)).cast("decimal(38,0)")).cast("string")
    return entries.groupBy(*by).agg(F.count("*").alias("n"), F.concat_ws(":", mark(0), mark(1)).alias("digest"))


def write_ranges(entries: DataFrame, root: str) -> None:
    """The index as a table by ranges, and the digests of these."""
    own = ranged(entries)
    own.repartition("folder", "share").write.mode("overwrite").partitionBy("folder", "share").parquet(f"{root}/entries")
    digests(own, "folder", "share").write.mode("overwrite").parquet(f"{root}/digests")


def changes(entries: DataFrame, root: str) -> DataFrame:
    """change, path, entry: what tells the index at ``root`` from ``entries``.

    Digests are compared range by range; of the stored index only ranges that differ are
    read. The driver gets their names, ``DEALT`` a folder at most.
    """
    spark, own = entries.sparkSession, ranged(entries)
    old = spark.read.schema("path string, entry string, folder string, share int").parquet(f"{root}/entries")
    was = spark.read.parquet(f"{root}/digests").withColumnsRenamed({"n": "m", "digest": "was"})
    now = digests(own, "folder", "share")
    differ = now.join(was, ["folder", "share"], "full_outer").where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("digest").eqNullSafe(F.col("was"))))
    due = [(r.folder, r.share) for r in differ.select("folder", "share").collect()]
    within = F.struct("folder", "share").isin(*(F.struct(F.lit(f), F.lit(s)) for f, s in due)) if due else F.lit(False)
    folders = sorted({f for f, _ in due})  # by themselves, so that the scan leaves out other folders' files
    return stale(old.where(F.col("folder").isin(folders) & within), own.where(within))


def write_index(entries: DataFrame, path: str) -> None:
    """The index as one pretty JSON file: entries are put in form and in order by tasks, and their parts copied together, each entry with its separator before it."""
    import json
    import os

    from ..sources.tables import remove_path, shared_dir

    def formed(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([",\n  " + json.dumps(json.loads(x), ensure_ascii=False, indent=2).replace("\n", "\n  ") for x in b.column(0).to_pylist()], pa.string())], names=["value"])

    spark = entries.sparkSession
    parts = f"{shared_dir(spark)}/sijill/index-{os.urandom(8).hex()}"
    entries.orderBy(F.split("path", "/")).select("entry").mapInArrow(formed, "value string").write.option("lineSep", "\x00").text(parts)
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(parts)
        names = sorted(s.getPath().toString() for s in at.getFileSystem(conf).listStatus(at) if s.getPath().getName().startswith("part-"))
        wrote = False
        with open(path, "wb") as f:
            for block in _blocks(spark, names):
                f.write(block if wrote else b"[" + block[1:])
                wrote = True
            f.write(b"\n]\n" if wrote else b"[\n]\n")
    finally:
        remove_path(spark, parts)


def _blocks(spark, names: list[str]):
    """The bytes of files one after another, without the separators of rows."""
    for name in names:
        for r in spark.read.format("binaryFile").load(name).select("content").toLocalIterator():
            if block := bytes(r.content).replace(b"\x00", b""):
                yield block
