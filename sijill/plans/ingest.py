"""The bulk import and the refresh as one plan: links and landed pages to documents, issues, results and the merged corpus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import doc_type, resolve_category
from ..functions.frontmatter import read_list
from ..functions.paths import document_path
from ..functions.text import present
from ..functions.urls import canonical_url
from ..operators import corpus, parse, quality, render
from ..sources.registry import detect


Keep = Callable[[DataFrame, str], DataFrame]
#: Landed pages, or what lands those of some links.
Pages = DataFrame | Callable[[DataFrame], DataFrame]
NO_LIST = "cast(array() as array<string>)"


@dataclass(frozen=True)
class Ingest:
    """documents: typed and checked; issues; results (ord, url, status, title, doc_type, reason, warnings); marks: url, etag, digest of what was read; asked: links that aren't done; incoming (ord, url, wanted, text): what is to be merged into current."""

    documents: DataFrame
    issues: DataFrame
    results: DataFrame
    marks: DataFrame
    asked: DataFrame
    incoming: DataFrame
    current: DataFrame

    @property
    def merged(self) -> DataFrame:
        """The corpus after the merge."""
        return corpus.upsert(self.current, self.incoming)


def _read(urls: DataFrame, pages: Pages, current: DataFrame, category: str | None, known: DataFrame | None, keep: Keep, name: str, source: str | None) -> tuple[DataFrame, DataFrame | None]:
    """Documents of the links, with the reason where there is none, and the links whose pages haven't changed."""
    blank = F.lit(None).cast("string")
    pages = pages(urls) if callable(pages) else pages
    extra = [F.col(n).alias(n) if n in pages.columns else blank.alias(n) for n in ("etag", "last_modified", "fetched_at", "status", "reason")]
    html = F.when(~F.col("status").eqNullSafe("failed"), F.coalesce("html", F.lit("")))
    captures = pages.select(canonical_url(F.col("url")).alias("url"), "html", *extra).withColumn("html", html).withColumn("digest", F.sha2("html", 256))
    one = F.max_by(F.struct("html", "etag", "last_modified", "digest", F.col("status").alias("landed"), F.col("reason").alias("why")), F.struct("fetched_at", "digest"))
    landed = captures.join(urls.select("url"), "url", "left_semi").groupBy("url").agg(one.alias("c")).select("url", "c.*")
    rows = urls.join(landed, "url", "left").withColumn("source", F.lit(source) if source else detect(F.col("url"), parse.SOURCES))
    same = None
    if known is not None:
        marked = corpus.changed(rows, known).withColumn("status", F.when(F.col("landed") == "unchanged", "unchanged").otherwise(F.col("status")))
        same, rows = marked.where("status = 'unchanged'").select("ord", "url"), marked.where("status <> 'unchanged'").drop("status")
    parsed = parse.parse(rows.select("url", "source", "html"))
    typed = parsed.withColumn("doc_type", doc_type(F.col("title"), F.col("url"), F.col("is_decision")))
    typed = typed.withColumn("category", F.lit(category) if category else resolve_category(F.col("category"), F.col("doc_type")))
    guarded = corpus.guard(typed, current).withColumn("reason", F.coalesce("error", "reason")).withColumn("retrieved_at", F.current_date().cast("string"))
    found = guarded.join(rows.select("url", "ord", "etag", "last_modified", "digest", "why"), "url")
    documents = keep(found.withColumn("reason", F.when(F.col("reason").isNotNull(), F.coalesce("why", "reason"))).drop("why"), name)
    return documents, None if same is None else keep(same, f"{name}-same")


def _rounds(urls: DataFrame, limit: int, read) -> tuple[DataFrame, DataFrame | None]:
    """Reads links in the order of ord, so many a round as the successes so far say are needed for the rest, until there are ``limit`` of them or no link is left.

    A round that finds little lets the next be larger, at least twice as large where nothing
    was found, so rounds are few; no more pages than two times what was needed are read, and
    some. ``read(links, name)`` must keep its results.
    """
    documents = same = None
    found = tried = turn = 0
    size, left = limit, urls
    while True:
        links = corpus.until_successes(left, max(1, size), F.lit(True))
        docs, unchanged = read(links, f"documents-{turn}")
        end = docs.select("ord").unionByName(unchanged.select("ord")) if unchanged is not None else docs.select("ord")
        told = end.agg(F.max("ord").alias("last"), F.count("*").alias("n")).first()
        documents = docs if documents is None else documents.unionByName(docs)
        same = unchanged if same is None else same.unionByName(unchanged)
        found += docs.where("reason is null").count() + (unchanged.count() if unchanged is not None else 0)
        tried += told.n
        if found >= limit or told.n < max(1, size):
            return documents, same
        left, turn = urls.where(F.col("ord") > told.last), turn + 1
        size = 2 * tried if not found else min(2 * tried, ceil(1.1 * (limit - found) * tried / found) + 1)


def plan(links: DataFrame, pages: Pages, current: DataFrame, done: DataFrame | None = None, category: str | None = None, known: DataFrame | None = None, keep: Keep = lambda df, name: df, limit: int | None = None, source: str | None = None) -> Ingest:
    """links: ord, url. pages: url, html[, etag, last_modified, fetched_at, status (ok, unchanged, failed), reason], or what gives them for links, once for each. current: url, path, text. known: url, etag, digest of the last refresh.

    What is done is dropped before a page is parsed, and so is what hasn't changed; a
    failure is a row and never ends the run. Of several captures of a canonical URL the
    latest counts (fetched_at; null and missing are earliest), of equal ones that with the
    greatest digest. keep may write a frame as a table of that name and read it again: the
    documents are used by all that follows, and are parsed once then. With a limit on the
    successes, links are read in rounds, and keep must write. source: of all links, in place
    of the one that their host tells.
    """
    urls = links.select("ord", canonical_url(F.col("url")).alias("url")).groupBy("url").agg(F.min("ord").alias("ord"))
    if done is not None:
        urls = corpus.resume(urls, done)
    blank, none = F.lit(None).cast("string"), F.expr(NO_LIST)
    if limit is None:
        read, same = _read(urls, pages, current, category, known, keep, "documents", source)
    else:
        urls = keep(urls, "asked")
        read, same = _rounds(urls, limit, lambda some, name: _read(some, pages, current, category, known, keep, name, source))
        places = read.select("ord", F.col("reason").isNull().alias("good"))
        places = places if same is None else places.unionByName(same.select("ord", F.lit(True).alias("good")))
        within = keep(corpus.until_successes(places, limit, F.col("good")).select("ord"), "within")
        read, same = read.join(within, "ord", "left_semi"), None if same is None else same.join(within, "ord", "left_semi")
    marks = read.where("reason is null").select("url", "etag", "digest")
    documents = read.drop("digest")
    good = documents.where("reason is null")
    issues = quality.issues(good)
    warned = issues.groupBy("url").agg(F.transform(F.array_sort(F.collect_list(F.struct("rule", "ord", "message"))), lambda x: x["message"]).alias("warnings"))
    results = documents.join(warned, "url", "left").select("ord", "url", F.when(present(F.col("reason")).isNull(), "ok").otherwise("failed").alias("status"), "title", "doc_type", "reason", F.coalesce("warnings", none).alias("warnings"))
    if same is not None:
        results = results.unionByName(same.select("ord", "url", F.lit("unchanged").alias("status"), blank.alias("title"), blank.alias("doc_type"), blank.alias("reason"), none.alias("warnings")))
    # A list of siblings is kept over an import: it lives in the files alone.
    siblings = current.select("url", read_list(F.col("text"), "also_available_from").alias("also_available_from"))
    rendered = render.render(good.join(siblings, "url", "left"))
    incoming = rendered.select("ord", "url", document_path(F.col("title"), F.col("category")).alias("wanted"), "text")
    return Ingest(documents, issues, results, marks, urls, incoming, current)
