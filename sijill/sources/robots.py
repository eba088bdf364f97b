"""Robots rules as a relation: which URLs a site lets an agent read, for all URLs at once.

A site's file becomes rows: the rules of the group that is meant for the agent, in order. A
URL's path meets them by equality: it is cut to each length that a rule of its host has, and
the cuts join the rules by host and prefix. So there is no comparison of every URL with every
rule, and a URL has as many rows as its host has rules of different length at most. The first
rule of the group that fits decides (``longest``: the longest one, of equal ones that which
allows). No rule, no file, or one that couldn't be read allows everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import let
from ..functions.urls import PARTS, canonical_url, host, unescape_path

AGENT = "sijill"


def rules(landed: DataFrame, agent: str = AGENT) -> DataFrame:
    """host, n (its place), allow, prefix. landed: host, status, text, one row a host (of several the first by text).

    A group begins with a line that names an agent after one that doesn't; an empty line
    ends it; without a rule it is none. The first group that names the agent counts, else
    the first for all agents.
    """
    one = landed.where("status = 200").groupBy(F.lower("host").alias("host")).agg(F.min("text").alias("text"))
    lines = one.select("host", F.posexplode(F.split("text", r"\r\n|[\n\r]")).alias("n", "line"))
    plain = F.trim(F.regexp_replace("line", "#.*", ""))
    key = F.lower(F.trim(F.substring_index(plain, ":", 1)))
    value = unescape_path(F.trim(F.regexp_replace(plain, "^[^:]*:", "")))
    kind = F.when(F.col("line") == "", "blank").when(~F.contains(plain, F.lit(":")), None).when(key == "user-agent", "agent").when(key.isin("allow", "disallow"), "rule").when(key.isin("crawl-delay", "request-rate"), "other")
    read = lines.select("host", "n", kind.alias("kind"), (key == "allow").alias("allow"), value.alias("value")).where("kind is not null")
    order = W.partitionBy("host").orderBy("n")
    begins = (F.col("kind") == "blank") | ((F.col("kind") == "agent") & ~F.lag("kind").over(order).eqNullSafe("agent"))
    grouped = read.withColumn("begins", begins.cast("int")).withColumn("group", F.sum("begins").over(order))
    named, names = F.lower("value"), F.col("kind") == "agent"
    agents = grouped.groupBy("host", "group").agg(F.max(names & (named == "*")).alias("all"), F.max(names & F.lit(agent.split("/")[0].lower()).contains(named)).alias("own"), F.max(~names & (F.col("kind") != "blank")).alias("ruled"))
    # A group for all agents is never one of an agent's own, even if it names it too.
    meant = agents.where("ruled and (all or own)").groupBy("host").agg(F.min(F.struct("all", "group"))["group"].alias("group"))
    own = grouped.where("kind = 'rule'").join(meant, ["host", "group"])
    return own.select("host", "n", (F.col("allow") | (F.col("value") == "")).alias("allow"), F.col("value").alias("prefix"))


def _file(url: Column) -> Column:
    whole = let(canonical_url(url), lambda u: F.concat(F.regexp_extract(u, PARTS, 3), F.coalesce(F.regexp_extract(u, PARTS, 4), F.lit(""))))
    return let(whole, lambda x: F.when(x == "", "/").otherwise(unescape_path(x)))


def judge(urls: DataFrame, rules: DataFrame, longest: bool = False) -> DataFrame:
    """``urls`` (url, …) with allowed."""
    lengths = rules.groupBy("host").agg(F.collect_set(F.char_length("prefix")).alias("lengths"))
    asked = urls.select("url").distinct().select("url", host(F.col("url")).alias("host"), _file(F.col("url")).alias("file"))
    cuts = asked.join(lengths, "host").select("url", "host", "file", F.explode(F.filter("lengths", lambda n: n <= F.char_length("file"))).alias("length"))
    met = cuts.select("url", "host", "length", F.left("file", F.col("length")).alias("prefix")).join(rules, ["host", "prefix"])
    place = F.struct(-F.col("length"), ~F.col("allow"), "n") if longest else F.struct("n")
    said = met.groupBy("url").agg(F.min_by("allow", place).alias("allowed"))
    return urls.join(said, "url", "left").withColumn("allowed", F.coalesce("allowed", F.lit(True)))
