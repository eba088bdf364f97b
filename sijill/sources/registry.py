"""The sources that documents come from. A new source is a row here and a parser."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host, on_hosts


@dataclass(frozen=True)
class Source:
    """parse: pages (url, html) to documents."""

    name: str
    hosts: tuple[str, ...]
    sitemap: str
    site: str
    parse: Callable[[DataFrame], DataFrame]


def detect(url: Column, sources: Sequence[Source]) -> Column:
    """The first source one of whose hosts the URL is on, else null."""
    out = F.lit(None).cast("string")
    for s in reversed(sources):
        out = F.when(on_hosts(url, s.hosts), s.name).otherwise(out)
    return out


def detect_by(urls: DataFrame, registry: DataFrame) -> DataFrame:
    """``urls`` (url, …) with source: the name of least rank one of whose hosts the URL is on, else null. registry: rank, name, host.

    For registries of any size: every distinct host is cut to the suffixes that a registry's
    host can be, and these join it by equality.
    """
    own = urls.withColumn("_host", host(F.col("url")))
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = own.select("_host").where("_host <> ''").distinct().select("_host", F.explode(suffixes).alias("suffix"))
    known = registry.select("rank", "name", F.lower("host").alias("suffix"))
    found = cuts.join(known, "suffix").groupBy("_host").agg(F.min(F.struct("rank", "name"))["name"].alias("source"))
    return own.join(found, "_host", "left").drop("_host")


def get(name: str, sources: Sequence[Source]) -> Source:
    for s in sources:
        if s.name == name:
            return s
    raise ValueError(f"unknown source: {name}")
