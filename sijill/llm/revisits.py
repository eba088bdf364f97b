"""Resolution of not-modified revisit records to the full response that they confirm.

A revisit takes the latest earlier full response of its canonical URL: an as-of join.
Then its validators are checked against that response: entity tags by weak comparison
where both have one, else modification dates; a difference leaves it unresolved. A
resolved revisit has the response's headers, with those that a 304 may update taken
from the revisit.

The join is a window over (URL, slot of time): slots are cut at quantiles of all record
times, so records of one URL, however many, are spread over the slots. Within a slot the
last response is carried forward; what a slot inherits is carried over at most ``SLOTS``
summary rows a URL.

Defined cases: earlier means a smaller (ts, record_id); a null ts is never earlier nor
has anything earlier; a null or empty URL is a URL like any other; repeated records are
resolved each; a revisit without validators is resolved without a check; headers are
maps with lower-case names, null counts as empty; extra columns are ignored. An empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .urlfilter import host_of, path_of

SLOTS = 64
#: The headers that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical(url: Column) -> Column:
    """scheme://host/path?query with scheme and host lower-cased, without default port and fragment."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    host = F.regexp_replace(host_of(url), F.when(scheme == "https", F.lit(":443$")).otherwise(F.lit(":80$")), F.lit(""))
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    return F.coalesce(F.concat(scheme, F.lit("://"), host, path, F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)), F.lit(""))


def _tag(x: Column) -> Column:
    return F.regexp_replace(x, "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """One row a revisit: record_id, url, ts, response_id, outcome, headers.

    records: record_id, kind ('response' or 'revisit'), url, ts (long), headers.
    outcome: resolved, mismatch (response_id names the response that differs) or missing.
    """
    cuts = [int(x) for x in records.approxQuantile("ts", [i / SLOTS for i in range(1, SLOTS)], 0.002)] if SLOTS > 1 else []
    cuts = sorted(set(cuts))
    slot = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("ts"))) if cuts else F.lit(0)
    full = F.when((F.col("kind") == "response") & F.col("ts").isNotNull(), F.struct("ts", "record_id", "headers"))
    rows = records.select("record_id", "kind", "url", "ts", F.coalesce("headers", F.expr("cast(map() as map<string,string>)")).alias("headers"), canonical(F.col("url")).alias("key"), F.coalesce(slot, F.lit(-1)).alias("slot"))
    rows = rows.withColumn("full", full).withColumn("place", F.struct("ts", "record_id"))
    inside = W.partitionBy("key", "slot").orderBy("ts", "record_id", F.col("kind").desc()).rowsBetween(W.unboundedPreceding, -1)
    seen = rows.withColumn("own", F.last("full", ignorenulls=True).over(inside)).where((F.col("kind") == "revisit"))
    ends = rows.where(F.col("full").isNotNull()).groupBy("key", "slot").agg(F.max_by("full", "place").alias("end"))
    slots = ends.unionByName(seen.where(F.col("own").isNull()).select("key", "slot").distinct().withColumn("end", F.lit(None).cast(ends.schema["end"].dataType)))
    slots = slots.groupBy("key", "slot").agg(F.first("end", ignorenulls=True).alias("end"))
    carried = slots.select("key", "slot", F.last("end", ignorenulls=True).over(W.partitionBy("key").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    found = seen.join(carried, ["key", "slot"], "left").withColumn("r", F.when(F.col("ts").isNotNull(), F.coalesce("own", "carried")))
    has = F.col("r.headers")
    tags, dates = (_tag(F.col("headers")["etag"]), _tag(has["etag"])), (F.col("headers")["last-modified"], has["last-modified"])
    both = tags[0].isNotNull() & tags[1].isNotNull()
    differs = F.when(both, tags[0] != tags[1]).otherwise(F.coalesce(dates[0] != dates[1], F.lit(False)))
    outcome = F.when(F.col("r").isNull(), "missing").when(differs, "mismatch").otherwise("resolved")
    allowed = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(has, lambda k, _: ~F.array_contains(F.map_keys(allowed), k)), allowed)
    return found.select("record_id", "url", "ts", F.col("r.record_id").alias("response_id"), outcome.alias("outcome"), F.when(outcome == "resolved", merged).otherwise(F.col("headers")).alias("headers"))
