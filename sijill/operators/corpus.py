"""The maintained corpus: merge, names, reclassification, siblings, canonical URLs, resume and refresh.

Every function returns a plan, and none writes to the corpus: a caller does. Names alone
are settled in rounds that keep tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.classify import doc_type, resolve_category
from ..functions.paths import NAME_BYTES, cut_bytes, document_path, file_name
from ..functions.urls import canonical_url, slug
from ..sources.tables import kept
from .parse import CLAUSES

ARTICLE_HEADING = r"(?md)^#{2,3}[ \t]*المادة\s"
CLAUSE_HEADING = rf"(?md)^#{{2,3}}[ \t]*(?:{'|'.join(CLAUSES)})ً?[ \t]*$"
#: Files of a title that one task lists, about.
DEAL = 200
# Fixed value: why a text isn't merged.
WORSE = "ناتج نثري بلا مواد سيطمس ملفًا قائمًا يحوي مواد (يُحتمل تغيّر بنية المصدر)"


def resume(links: DataFrame, done: DataFrame) -> DataFrame:
    """Links (ord, url) that are not done; equal URLs once."""
    first = links.groupBy(canonical_url(F.col("url")).alias("url")).agg(F.min("ord").alias("ord"))
    return first.join(done.select("url").distinct(), "url", "left_anti").select("ord", "url")


def changed(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """incoming (url, etag, digest) with status 'new', 'changed' or 'unchanged' against known (url, etag, digest). Validators decide where both have one, else digests."""
    old = known.select("url", F.col("etag").alias("old_etag"), F.col("digest").alias("old_digest"), F.lit(True).alias("there"))
    tags = F.col("etag").isNotNull() & F.col("old_etag").isNotNull()
    same = F.when(tags, F.col("etag") == F.col("old_etag")).otherwise(F.col("digest").eqNullSafe(F.col("old_digest")))
    return incoming.join(old, "url", "left").withColumn("status", F.when(F.col("there").isNull(), "new").when(same, "unchanged").otherwise("changed")).drop("old_etag", "old_digest", "there")


def until_successes(results: DataFrame, limit: int, success) -> DataFrame:
    """Results, by ord (not null), up to the one that completes ``limit`` successes.

    Successes are counted in intervals of ord of 2^20, these in intervals of 2^40 and 2^60.
    From the widest on, intervals that begin after the limit is met are left out, and those
    within one interval are summed up in a window of their own: however ord is spread, no
    window holds more than 2^20 rows, and nothing is sorted in one task.
    """
    count, levels = F.col("_n"), (20, 40, 60)
    part = results.withColumn("_in20", F.shiftright(F.col("ord").cast("long"), 20))
    counts = {20: part.groupBy("_in20").agg(F.count_if(success).alias("_n"))}
    for low, high in zip(levels, levels[1:]):
        counts[high] = counts[low].groupBy(F.shiftright(f"_in{low}", high - low).alias(f"_in{high}")).agg(F.sum("_n").alias("_n"))
    top = counts[60].groupBy().agg(F.array_sort(F.collect_list(F.struct("_in60", "_n"))).alias("all"))  # 16 rows at most
    earlier = lambda x: F.aggregate(F.filter("all", lambda y: y["_in60"] < x["_in60"]), F.lit(0).cast("long"), lambda s, y: s + y["_n"])
    begun = top.select(F.inline(F.transform("all", lambda x: F.struct(x["_in60"].alias("_in60"), earlier(x).alias("_before")))))
    for high, low in ((60, 40), (40, 20)):
        inner = counts[low].withColumn(f"_in{high}", F.shiftright(f"_in{low}", high - low)).join(begun.where(F.col("_before") < limit), f"_in{high}")
        sofar = F.sum(count).over(W.partitionBy(f"_in{high}").orderBy(f"_in{low}")) - count
        begun = inner.select(f"_in{low}", (F.col("_before") + sofar).alias("_before"))
    near = part.join(begun.where(F.col("_before") < limit), "_in20")
    prior = F.col("_before") + F.coalesce(F.sum(success.cast("long")).over(W.partitionBy("_in20").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return near.withColumn("_prior", prior).where(F.col("_prior") < limit).drop("_in20", "_before", "_prior")


def guard(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """incoming (url, articles, body, …) with reason set where prose would replace a file with articles or clauses."""
    had = current.select("url", (F.col("text").rlike(ARTICLE_HEADING) | F.col("text").rlike(CLAUSE_HEADING)).alias("_had"))
    prose = (F.size("articles") == 0) & (F.coalesce("body", F.lit("")) != "")
    return incoming.join(had, "url", "left").withColumn("reason", F.when(prose & F.coalesce("_had", F.lit(False)), WORSE)).drop("_had")


#: Numbers, and places in an order, that one window or one task holds.
SPAN = 1 << 16


def _ranked(rows: DataFrame, key: list[str], place: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``, the place within the key (from 1) by ``place`` (a long), then ``order``.

    Rows are counted in spans of ``place``, and ranked within one: a key that a third of all
    rows have is in as many windows as it has spans, and none but a row a span is in all.
    """
    part = rows.withColumn("_span", F.shiftright(F.col(place), 16))
    counts = part.groupBy(*key, "_span").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(W.partitionBy(*key).orderBy("_span")) - F.col("_n")).drop("_n")
    inner = F.row_number().over(W.partitionBy(*key, "_span").orderBy(place, *order))
    return part.withColumn("_inner", inner).join(before, [*key, "_span"]).withColumn(name, F.col("_before") + F.col("_inner")).drop("_span", "_inner", "_before")


def _first(claims: DataFrame, path: str) -> DataFrame:
    """url, path: who gets each path: who has it, else the first claim. A minimum, so that no path's claims meet in one task."""
    other = (~F.coalesce(F.col(path) == F.col("owned"), F.lit(False))).alias("other")
    return claims.groupBy(F.col(path).alias("path")).agg(F.min(F.struct(other, "ord", "url"))["url"].alias("url")).select("url", "path")


def settle_paths(claims: DataFrame) -> DataFrame:
    """url, path for claims (url, wanted, owned (the path it has, or null), ord): every URL gets a path of its own.

    The claims left over are settled against all paths given out so far, in three rounds:

    1. the wanted path goes to the document that has it, else to the first claim;
    2. the others claim their slug in the name, with bytes reserved so that it can't be cut
       off; names that the first round gave out are refused;
    3. the rest claim a number behind that name, from 2. Who has such a path keeps it if the
       first round didn't give it out; the others get, in order, the numbers that are free.

    A fourth round is never needed: what the second gives out ends in a bracket and what the
    third does in a number, and equal numbered paths have equal names, whose claims are
    settled together; so only the first round's paths can be in the way of the others.
    Free numbers are made by spans, and meet claims by rank.

    What a round leaves is kept as a table, since all that follows reads it; mostly it is
    empty after the first.
    """
    claims = claims.select("url", "wanted", "owned", F.col("ord").cast("long").alias("ord"))
    given = kept(_first(claims, "wanted"), "names-first")
    extra = F.concat(F.lit(" ("), cut_bytes(file_name(slug(F.col("url"))), 60), F.lit(")"))
    folder, stem = F.regexp_extract("wanted", r"(?s)^(.*/)?([^/]*)\.md$", 1), F.regexp_extract("wanted", r"(?s)^(.*/)?([^/]*)\.md$", 2)
    name = F.concat(folder, F.trim(cut_bytes(stem, F.lit(NAME_BYTES - 8) - F.octet_length(extra))), extra)
    rest = kept(claims.join(given.select("url"), "url", "left_anti").select("url", "owned", "ord", name.alias("name")), "names-left")
    if rest.isEmpty():
        return given
    # Paths of the first round that can be in the way: a name that is left, alone or with a number.
    number = F.expr(r"coalesce(try_cast(regexp_extract(path, '(?s) ([1-9]\\d{0,8})\\.md$', 1) AS int), 0)")
    bare = given.select("path", F.regexp_replace("path", r"\.md$", "").alias("name"), F.lit(0).alias("number"))
    cut = given.select("path", F.regexp_extract("path", r"(?s)^(.*) [1-9]\d{0,8}\.md$", 1).alias("name"), number.alias("number")).where("number >= 2")
    taken = kept(bare.unionByName(cut).join(rest.select("name").distinct(), "name", "left_semi"), "names-taken")
    second = _first(rest.join(taken.where("number = 0").select("name"), "name", "left_anti").withColumn("named", F.concat("name", F.lit(".md"))), "named")
    second = kept(second, "names-second")
    left = kept(rest.join(second.select("url"), "url", "left_anti"), "names-third")
    if left.isEmpty():
        return given.unionByName(second)
    named = lambda c: F.concat("name", F.lit(" "), c.cast("string"), F.lit(".md"))
    had = left.withColumn("path", F.col("owned")).withColumn("number", number).where((F.col("number") >= 2) & (F.col("path") == named(F.col("number"))))
    keeps = had.join(taken.select("path"), "path", "left_anti").groupBy("path", "name", "number").agg(F.min(F.struct("ord", "url"))["url"].alias("url"))
    new = _ranked(left.join(keeps.select("url"), "url", "left_anti"), ["name"], "ord", ["url"], "rank")
    held = keeps.select("name", "number").unionByName(taken.where("number >= 2").select("name", "number"))
    # As many numbers as there are claims and numbers held, so that enough are free; each span of them is made by itself.
    needed = left.groupBy("name").agg(F.count("*").alias("m")).join(held.groupBy("name").agg(F.count("*").alias("h")), "name", "left")
    spans = needed.select("name", (F.col("m") + F.coalesce("h", F.lit(0)) + 1).alias("last")).select("name", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright("last", 16))).alias("span"))
    numbers = spans.repartition("name", "span").select("name", F.explode(F.sequence(F.greatest(F.col("span") * SPAN, F.lit(2)), F.least(F.col("last"), F.col("span") * SPAN + (SPAN - 1)))).alias("number"))
    free = _ranked(numbers.join(held.select("name", F.col("number").cast("long").alias("number")), ["name", "number"], "left_anti"), ["name"], "number", [], "rank")
    third = new.join(free, ["name", "rank"]).select("url", named(F.col("number")).alias("path"))
    return given.unionByName(second).unionByName(keeps.select("url", "path")).unionByName(third)


def upsert(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """The corpus after a merge by URL: url, path, text, old_path, action (kept, added, updated, moved, same).

    current: url, path, text. incoming: ord, url, wanted (path), text; of equal URLs the
    first. Names are settled on keys; texts meet once, by URL, when paths are known.
    """
    first = incoming.groupBy("url").agg(F.min(F.struct("ord", "wanted")).alias("n"))
    keys = current.select("url", F.col("path").alias("owned")).join(first, "url", "full_outer")
    places = settle_paths(keys.select("url", F.coalesce("n.wanted", "owned").alias("wanted"), "owned", F.coalesce("n.ord", F.lit(-1)).cast("long").alias("ord")))
    new = incoming.groupBy("url").agg(F.min_by(F.struct("ord", "wanted", "text"), F.struct("ord", "wanted")).alias("n"))
    merged = current.select("url", F.col("path").alias("old_path"), F.col("text").alias("old_text")).join(new, "url", "full_outer").join(places, "url")
    action = F.when(F.col("n").isNull() & (F.col("path") == F.col("old_path")), "kept").when(F.col("old_path").isNull(), "added").when(F.col("path") != F.col("old_path"), "moved").when(F.col("n.text").eqNullSafe(F.col("old_text")), "same").otherwise("updated")
    return merged.select("url", "path", F.coalesce("n.text", "old_text").alias("text"), "old_path", action.alias("action"))


#: What becomes of a file.
ACTIONS = ("unchanged", "fields", "move", "conflict", "skipped")


def reclassify(files: DataFrame) -> DataFrame:
    """path, new_path, new_type, new_category, action ('unchanged', 'fields', 'move', 'conflict', 'skipped') for files (path, title, source_url, doc_type, category, is_decision).

    A move conflicts with a file at its target or with the first of several moves there.
    """
    kind = doc_type(F.col("title"), F.col("source_url"), F.col("is_decision"))
    typed = files.withColumn("new_type", kind).withColumn("new_category", resolve_category(F.col("category"), F.col("new_type")))
    planned = typed.withColumn("new_path", document_path(F.col("title"), F.col("new_category")))
    there = files.select(F.col("path").alias("new_path"), F.lit(True).alias("there"))
    rank = F.row_number().over(W.partitionBy("new_path").orderBy((F.col("path") != F.col("new_path")).cast("int"), "path"))
    ranked = planned.withColumn("rank", rank).join(there, "new_path", "left")
    same = F.col("path") == F.col("new_path")
    still = F.col("new_type").eqNullSafe(F.col("doc_type")) & F.col("new_category").eqNullSafe(F.col("category"))
    action = F.when(F.col("title").isNull(), "skipped").when(same & still, "unchanged").when(same, "fields").when(F.col("there") | (F.col("rank") > 1), "conflict").otherwise("move")
    return ranked.select("path", "new_path", "new_type", "new_category", action.alias("action"))


def duplicate_groups(files: DataFrame) -> DataFrame:
    """title, n, paths of titles that several files have."""
    return files.where(F.col("title").isNotNull()).groupBy("title").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("path")).alias("paths")).where("n > 1")


def siblings(files: DataFrame) -> DataFrame:
    """path, title, siblings (canonical URLs of the other files of the title, sorted), touched (the stored list differs).

    files: path, title, source_url, also_available_from. Sets are gathered and sorted once a
    title, so there is no pair of files in the plan; a file's list is its title's without
    its own URL. Files of a hot title are dealt over tasks, ``DEAL`` a task, each with a copy
    of the title's list: the lists themselves are as long as a title has URLs.
    """
    own = files.where(F.col("title").isNotNull()).withColumn("url", canonical_url(F.col("source_url")))
    sets = own.groupBy("title").agg(F.count("*").alias("n"), F.array_sort(F.filter(F.collect_set("url"), lambda u: u != "")).alias("urls")).where("n > 1")
    hot = own.groupBy("title").agg(F.ceil(F.count("*") / DEAL).cast("int").alias("deals")).where("deals > 1")
    dealt = own.join(hot, "title", "left").withColumn("deal", F.coalesce(F.pmod(F.xxhash64("path"), F.col("deals")).cast("int"), F.lit(0)))
    copies = sets.select("title", "urls", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / DEAL).cast("int") - 1)).alias("deal"))
    others = F.filter("urls", lambda u: ~u.eqNullSafe(F.col("url")))
    return dealt.join(copies, ["title", "deal"]).select("path", "title", "url", others.alias("siblings"), (~others.eqNullSafe(F.col("also_available_from"))).alias("touched"))


def sibling_sets(files: DataFrame) -> DataFrame:
    """path, title, url, n_siblings, touched: as :func:`siblings`, without the lists, for titles that any number of files share.

    A title's set of URLs is a sum of hashes, over distinct pairs of title and URL, so that a
    hot title is added up in parts; without a file's own hash it is what its stored list must
    add up to (two sums and the size; the list must be sorted and without repeats). Lists
    are made by :func:`siblings`, for the files that are to be written.
    """
    own = files.where(F.col("title").isNotNull()).select("path", "title", canonical_url(F.col("source_url")).alias("url"), "also_available_from")
    mark = lambda salt, u: F.xxhash64(u, F.lit(salt)).cast("decimal(38,0)")
    total = lambda salt: F.sum(mark(salt, F.col("url"))).alias(f"sum{salt}")
    sets = own.where("url <> ''").select("title", "url").distinct().groupBy("title").agg(F.count("*").alias("n"), total(0), total(1))
    many = own.groupBy("title").agg(F.count("*").alias("files")).where("files > 1").join(sets, "title", "left")
    zero = F.lit(0).cast("decimal(38,0)")
    mine = F.col("url") != ""
    rest = lambda salt: F.coalesce(f"sum{salt}", zero) - F.when(mine, mark(salt, F.col("url"))).otherwise(zero)
    n = F.coalesce("n", F.lit(0)) - F.coalesce(mine.cast("int"), F.lit(0))
    held = F.coalesce("also_available_from", F.expr("cast(array() as array<string>)"))
    stored = lambda salt: F.aggregate(held, zero, lambda s, u: (s + mark(salt, u)).cast("decimal(38,0)"))
    same = (F.size(held) == n) & (stored(0) == rest(0)) & (stored(1) == rest(1)) & (held == F.array_sort(F.array_distinct(held)))
    return own.join(many, "title").select("path", "title", "url", n.cast("long").alias("n_siblings"), (~F.coalesce(same & F.col("also_available_from").isNotNull(), F.lit(False))).alias("touched"))


def canonicalise(files: DataFrame) -> DataFrame:
    """files (path, source_url, also_available_from) with canonical fields and what changed: own URL dropped from the list, repeats too, order kept."""
    url = canonical_url(F.col("source_url"))
    clean = F.filter(F.array_distinct(F.transform("also_available_from", canonical_url)), lambda u: ~u.eqNullSafe(url))
    return files.select("path", url.alias("source_url"), clean.alias("also_available_from"), (~url.eqNullSafe(F.col("source_url"))).alias("url_changed"), (clean != F.col("also_available_from")).alias("list_changed"))
