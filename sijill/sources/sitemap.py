"""Discovery of document URLs in sitemaps that are landed as a table (url, xml)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.urls import canonical_url, on_hosts
from .files import first_seen

# Submaps that hold no documents, and those of amendments.
SKIP, UPDATES = "(?i)taxonom|category|post_tag|-tag|author|user", "(?i)nezam_update"


def locations(xml: Column) -> Column:
    """Entries of a map, with entities resolved."""
    raw = F.regexp_extract_all(xml, F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    plain = lambda x: F.replace(F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    return F.transform(raw, lambda x: strip(plain(x)))


def wanted(url: Column, hosts: Sequence[str], updates: bool = False) -> Column:
    out = on_hosts(url, hosts) & ~url.rlike(SKIP)
    return out if updates else out & ~url.rlike(UPDATES)


# Why a map gives no documents.
NOT_LANDED, NO_MAP = "not landed", "not a map"


def _submaps(maps: DataFrame, index: str, hosts: Sequence[str], updates: bool) -> DataFrame:
    """m (its place), url, xml, reason (null if it can be read) of the maps that an index lists and that are wanted; of a flat map, itself; of an index that can't be read, its reason."""
    landed = maps.groupBy("url").agg(F.max("xml").alias("xml")).withColumn("there", F.lit(True))
    top = maps.sparkSession.range(1).select(F.lit(index).alias("url")).join(landed, "url", "left")
    nested = F.coalesce(F.contains("xml", F.lit("<sitemapindex")), F.lit(False))
    subs = top.where(nested).select(F.posexplode(locations(F.col("xml"))).alias("m", "url")).where(wanted(F.col("url"), hosts, updates))
    own = subs.unionByName(top.where(~nested).select(F.lit(0).alias("m"), "url")).join(landed, "url", "left")
    return own.withColumn("reason", F.when(F.col("there").isNull(), NOT_LANDED).when(~F.coalesce(F.col("xml").rlike("<(?:urlset|sitemapindex|loc)\\b"), F.lit(False)), NO_MAP)).drop("there")


def failed(maps: DataFrame, index: str, hosts: Sequence[str], updates: bool = False) -> DataFrame:
    """url, reason of the maps below an index that :func:`discover` passes over because they can't be read."""
    return _submaps(maps, index, hosts, updates).where("reason is not null").select("url", "reason").distinct()


def discover(maps: DataFrame, index: str, hosts: Sequence[str], updates: bool = False) -> DataFrame:
    """ord, url of the documents below one index map. A flat map lists the documents itself; submaps that can't be read give none, see :func:`failed`."""
    listed = _submaps(maps, index, hosts, updates).where("reason is null").select("m", F.posexplode(locations(F.col("xml"))).alias("k", "url"))
    found = listed.where(on_hosts(F.col("url"), hosts)).select(F.struct("m", "k").alias("place"), canonical_url(F.col("url")).alias("url"))
    first = first_seen(found, ["url"], "place").select("place.*", "url")
    # URLs are numbered within their submap, after the counts of those before. The window over all is over submaps, which one file lists.
    counts = first.groupBy("m").agg(F.count("*").alias("n"))
    before = counts.select("m", (F.sum("n").over(W.orderBy("m")) - F.col("n")).alias("before"))
    ord = F.col("before") + F.row_number().over(W.partitionBy("m").orderBy("k"))
    return first.join(before, "m").select(ord.cast("int").alias("ord"), "url")
