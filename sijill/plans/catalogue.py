"""The registered queries: each operator on the driver's tables, beside the SQL that has the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import classify, frontmatter, ordinals, paths, text, urls
from ..operators import corpus, parse, quality, render, report
from ..sources import files, html, registry, robots, sitemap, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def literal(x) -> str:
    return "NULL" if x is None else str(x).upper() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def expected(rows: list[tuple], names: str) -> str:
    """A SELECT of literal rows: the values an operator must give."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS t({names})"


# Parts of SQL that several queries share.
S_HOST = "lower(regexp_extract(url, '://([^/?#]*)', 1))"
S_PATH = "regexp_extract(url, '://[^/?#]*([^?#]*)', 1)"
S_CANON = rf"lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '://' || {S_HOST} || {S_PATH} || regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)"
S_H1 = "trim(regexp_replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '\\s+', ' ', 'g'))"
S_SLUG = f"coalesce(nullif(list_filter(string_split({S_PATH}, '/'), lambda x: x <> '')[-1], ''), 'نسخة')"


def h1(page: Column) -> Column:
    return text.squeeze(F.regexp_extract(page, "<h1>([^<]*)</h1>", 1))


@query(f"""
WITH p AS (SELECT page_id, url, {S_H1} AS title, {S_CANON} AS own FROM pages),
g AS (SELECT title FROM p GROUP BY title HAVING count(*) > 1)
SELECT CAST(a.page_id AS VARCHAR) AS path, a.title,
       coalesce((SELECT string_agg(own, '|' ORDER BY own) FROM (SELECT DISTINCT own FROM p b WHERE b.title = a.title AND b.own <> a.own)), '') AS siblings
FROM p a JOIN g USING (title)""")
def sibling_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), h1(F.col("html")).alias("title"), F.col("url").alias("source_url"), F.expr("cast(array() as array<string>)").alias("also_available_from"))
    return corpus.siblings(files).select("path", "title", F.array_join("siblings", "|").alias("siblings"))


@query(f"SELECT page_id, {S_CANON} AS canonical, regexp_replace({S_HOST}, ':[0-9]*$', '') AS host FROM pages")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"), urls.host(F.col("url")).alias("host"))


HOSTS = ("example.com", "example.org")


@query(f"SELECT page_id, ({S_HOST} IN ('example.com', 'example.org') OR suffix({S_HOST}, '.example.com') OR suffix({S_HOST}, '.example.org')) AS allowed FROM pages")
def host_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.on_hosts(F.col("url"), HOSTS).alias("allowed"))


@query(f"SELECT page_id, {S_SLUG} AS slug FROM pages")
def url_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.slug(F.col("url")).alias("slug"))


@query(f"""
SELECT CASE WHEN suffix({S_HOST}, 'example.com') THEN 'first' WHEN suffix({S_HOST}, 'example.net') THEN 'second' END AS source, count(*) AS n
FROM pages GROUP BY 1""")
def source_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [registry.Source(n, (h,), "", n, parse.parse) for n, h in (("first", "example.com"), ("second", "example.net"))]
    return table(spark, sf_dir, "pages").groupBy(registry.detect(F.col("url"), sources).alias("source")).agg(F.count("*").alias("n"))


@query("""
WITH r AS (SELECT 'c' || c_custkey || '.test' AS host, c_custkey AS rank, c_mktsegment AS name FROM customer UNION ALL SELECT 'c' || n_nationkey || '.test', -1 - n_nationkey, n_name FROM nation),
f AS (SELECT host, arg_min(name, rank) AS name FROM r GROUP BY host)
SELECT o_orderkey, f.name AS source FROM orders LEFT JOIN f ON o_orderkey % 7 <> 0 AND f.host = 'c' || o_custkey || '.test'""")
def source_detect_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with a host for every customer, in which nations come first; orders' URLs are on subdomains of these, or of none."""
    key, rank = F.col("c_custkey"), F.col("c_custkey").cast("long")
    named = table(spark, sf_dir, "customer").select(rank.alias("rank"), F.col("c_mktsegment").alias("name"), F.concat(F.lit("c"), key, F.lit(".test")).alias("host"))
    first = table(spark, sf_dir, "nation").select((-1 - F.col("n_nationkey").cast("long")).alias("rank"), F.col("n_name").alias("name"), F.concat(F.lit("C"), "n_nationkey", F.lit(".test")).alias("host"))
    sub = F.when(F.col("o_orderkey") % 7 == 0, "a.x").when(F.col("o_orderkey") % 3 == 0, "a.b.").when(F.col("o_orderkey") % 3 == 1, "").otherwise("www.")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("https://"), sub, F.lit("c"), "o_custkey", F.lit(".test:8080/"), "o_orderkey").alias("url"))
    return registry.detect_by(orders, named.unionByName(first)).select("o_orderkey", "source")


#: Files of three kinds of hosts: one with groups for several agents, one with an empty rule, one that isn't there.
ROBOTS = ("User-agent: Other\nDisallow: /\n\n# ours\nUser-Agent: SIJ\nUser-agent: more\nAllow: /%65n/a\nDisallow: /en\nCrawl-delay: 3\n\nDisallow: /fr\nUser-agent: *\nDisallow: /", "User-agent: *\nDisallow: /fr/\nDisallow:\nDisallow: /de/", "gone")


@query(f"""
WITH p AS (SELECT page_id, length({S_HOST}) % 3 AS kind, {S_PATH} AS path FROM pages)
SELECT page_id, CASE kind WHEN 0 THEN starts_with(path, '/en/a') OR NOT starts_with(path, '/en') WHEN 1 THEN NOT starts_with(path, '/fr/') ELSE true END AS allowed FROM p""")
def robots_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    kind = F.char_length(urls.authority(F.col("url"))) % 3
    sites = pages.select(urls.host(F.col("url")).alias("host"), kind.alias("kind")).distinct()
    text = F.when(F.col("kind") == 0, ROBOTS[0]).when(F.col("kind") == 1, ROBOTS[1]).otherwise(ROBOTS[2])
    landed = sites.select("host", F.when(F.col("kind") == 2, 404).otherwise(200).alias("status"), text.alias("text"))
    return robots.judge(pages, robots.rules(landed)).select("page_id", "allowed")


@query(f"""
WITH p AS (SELECT page_id, {S_H1} AS title, {S_CANON} AS own FROM pages),
g AS (SELECT title, count(*) AS files, count(DISTINCT own) AS n FROM p GROUP BY title HAVING count(*) > 1)
SELECT CAST(page_id AS VARCHAR) AS path, n - 1 AS n_siblings, CASE WHEN page_id % 2 = 0 THEN n <> 1 ELSE true END AS touched FROM p JOIN g USING (title)""")
def sibling_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other file has an empty list, the rest a list of one URL that isn't of its set."""
    listed = F.when(F.col("page_id") % 2 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array(F.lit("https://none.test/")))
    own = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), h1(F.col("html")).alias("title"), F.col("url").alias("source_url"), listed.alias("also_available_from"))
    return corpus.sibling_sets(own).select("path", "n_siblings", "touched")


@query("""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) - 1 AS pos FROM pages)
SELECT page_id, href, min(pos)::INTEGER AS pos FROM l GROUP BY page_id, href""")
def link_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "href"))
    return files.first_seen(links, ["page_id", "href"], "pos").select("page_id", "href", "pos")


@query(f"SELECT page_id, url FROM pages WHERE (suffix({S_HOST}, '.example.com') OR suffix({S_HOST}, '.example.org')) AND NOT regexp_matches(url, '(?i)taxonom|category|post_tag|-tag|author|user') AND NOT regexp_matches(url, '(?i)nezam_update')")
def submap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url").where(sitemap.wanted(F.col("url"), HOSTS))


SUBMAPS = 8
S_SUBMAP = f"CASE page_id % {SUBMAPS} WHEN 3 THEN 'https://example.com/category-' WHEN 4 THEN 'https://example.com/nezam_update-' WHEN 6 THEN 'https://other.test/post-' ELSE 'https://www.example.org/post-' END || page_id % {SUBMAPS} || '.xml'"
S_ON = f"({S_HOST} IN ('example.com', 'example.org') OR suffix({S_HOST}, '.example.com') OR suffix({S_HOST}, '.example.org'))"


@query(f"""
WITH p AS (SELECT page_id % {SUBMAPS} AS m, page_id, {S_CANON} AS url FROM pages WHERE page_id % {SUBMAPS} NOT IN (3, 4, 5, 6) AND {S_ON}),
f AS (SELECT url, min({{'m': m, 'k': page_id}}) AS place FROM p GROUP BY url)
SELECT row_number() OVER (ORDER BY place)::INTEGER AS ord, url FROM f""")
def sitemap_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as maps: an index of submaps, of which one is of categories, one of updates, one of another host, and one isn't landed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.expr(S_SUBMAP).alias("map"))
    entry = F.struct("page_id", F.concat(F.lit("<url><loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("\n</loc></url>")).alias("x"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda e: e["x"]), "")
    submaps = pages.where(f"page_id % {SUBMAPS} <> 5").groupBy("map").agg(joined(entry).alias("inner")).select(F.col("map").alias("url"), F.concat(F.lit("<urlset>"), "inner", F.lit("</urlset>")).alias("xml"))
    listed = pages.groupBy("map").agg(F.min(F.col("page_id") % SUBMAPS).alias("page_id")).select("page_id", F.concat(F.lit("<sitemap><loc>"), "map", F.lit("</loc></sitemap>")).alias("x"))
    index = listed.agg(joined(F.struct("page_id", "x")).alias("inner")).select(F.lit("https://example.com/index.xml").alias("url"), F.concat(F.lit("<sitemapindex>"), "inner", F.lit("</sitemapindex>")).alias("xml"))
    return sitemap.discover(submaps.unionByName(index), "https://example.com/index.xml", HOSTS)


@query(f"""
WITH l AS (SELECT {S_CANON} AS url, min(page_id) AS ord FROM pages GROUP BY 1)
SELECT ord, url FROM l WHERE url NOT IN (SELECT {S_CANON} FROM pages WHERE page_id % 2 = 0)""")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return corpus.resume(pages.select(F.col("page_id").alias("ord"), "url"), pages.where("page_id % 2 = 0").select(urls.canonical_url(F.col("url")).alias("url")))


@query("""
SELECT page_id::VARCHAR AS url, CASE page_id % 4 WHEN 0 THEN 'unchanged' WHEN 1 THEN 'changed' WHEN 2 THEN 'unchanged' ELSE 'new' END AS status FROM pages""")
def conditional_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, digest = F.col("page_id").cast("string").alias("url"), F.md5(F.col("html").cast("binary"))
    pages = table(spark, sf_dir, "pages")
    tag = lambda x: F.when(F.col("page_id") % 4 == 2, F.lit(x)).cast("string").alias("etag")
    known = pages.where("page_id % 4 <> 3").select(key, tag("same"), F.when(F.col("page_id") % 4 == 0, digest).otherwise("other").alias("digest"))
    return corpus.changed(pages.select(key, tag("same"), digest.alias("digest")), known).select("url", "status")


@query("""
WITH e AS (SELECT event_id, event_type, count(*) FILTER (event_type <> 'error') OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events)
SELECT event_id, event_type FROM e WHERE before < 5000""")
def success_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), "event_type")
    return corpus.until_successes(results, 5000, F.col("event_type") != "error").select(F.col("ord").alias("event_id"), "event_type")


@query("SELECT md5(text) AS title, count(*) AS n, string_agg(doc_id::VARCHAR, '|' ORDER BY doc_id::VARCHAR) AS paths FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("title"), F.col("doc_id").cast("string").alias("path"))
    return corpus.duplicate_groups(files).select("title", "n", F.array_join("paths", "|").alias("paths"))


@query(f"""
WITH p AS (SELECT page_id, {S_H1} AS title, url, {S_CANON} AS own FROM pages),
l AS (SELECT title, min(own) AS own, list(own ORDER BY page_id) AS urls FROM p GROUP BY title),
u AS (SELECT title, own, unnest(urls) AS u, generate_subscripts(urls, 1) AS i FROM l),
f AS (SELECT title, own, u, min(i) AS i FROM u WHERE u <> own GROUP BY ALL)
SELECT l.title AS path, l.own AS source_url, coalesce(string_agg(f.u, '|' ORDER BY f.i), '') AS urls FROM l LEFT JOIN f ON l.title = f.title GROUP BY ALL""")
def canonicalize_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", h1(F.col("html")).alias("title"), "url", urls.canonical_url(F.col("url")).alias("own"))
    lists = pages.groupBy("title").agg(F.min("own").alias("own"), F.transform(F.array_sort(F.collect_list(F.struct("page_id", "url"))), lambda x: x["url"]).alias("also_available_from"))
    return corpus.canonicalise(lists.select(F.col("title").alias("path"), F.concat("own", F.lit("#top")).alias("source_url"), "also_available_from")).select("path", "source_url", F.array_join("also_available_from", "|").alias("urls"))


S_TURNS = "SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN NULL ELSE turn END AS number, turn % 4 = 3 AS bis FROM conversations WHERE (conv_id * 7 + turn) % 5 <> 0"


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").where("(conv_id * 7 + turn) % 5 <> 0")
    return rows.select("conv_id", "turn", F.when(F.col("turn") % 5 != 4, F.col("turn")).alias("number"), (F.col("turn") % 4 == 3).alias("bis"))


@query(f"""
WITH t AS ({S_TURNS}),
p AS (SELECT *, last_value(CASE WHEN NOT bis THEN number END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM t)
SELECT conv_id, turn, coalesce(prev, -1) AS prev, CASE WHEN number IS NULL THEN 'unknown' WHEN bis AND number <> prev THEN 'repeat' WHEN NOT bis AND number <> prev + 1 THEN 'gap' ELSE '' END AS gap FROM p""")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sequence_gaps(_turns(spark, sf_dir), "conv_id", "turn", "number", "bis").select("conv_id", "turn", F.coalesce("prev", F.lit(-1)).cast("long").alias("prev"), "gap")


@query(f"""
WITH t AS ({S_TURNS}), p AS (SELECT *, lag(number) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM t WHERE number IS NOT NULL AND NOT bis)
SELECT conv_id, turn, prev FROM p WHERE number <> prev + 1""")
def sequence_gaps_lint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sequence_breaks(_turns(spark, sf_dir), "conv_id", "turn", "number", "bis").select("conv_id", "turn", "prev")


@query("""
WITH r AS (SELECT conv_id, turn, turn AS rank FROM conversations WHERE (conv_id + turn) % 4 <> 1 AND turn < 6),
p AS (SELECT *, lag(rank, 1, -1) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM r)
SELECT conv_id, turn, 'n' || (prev + 1) AS expected FROM p WHERE rank <> prev + 1""")
def clause_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").where("(conv_id + turn) % 4 <> 1").select("conv_id", "turn", F.concat(F.lit("n"), F.col("turn").cast("string")).alias("name"))
    return quality.clause_breaks(rows, "conv_id", "turn", "name", [f"n{i}" for i in range(6)]).select("conv_id", "turn", "expected")


@query("""
WITH e AS (SELECT *, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id) AS part_no FROM events)
SELECT event_id, coalesce(last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id), -1) AS part,
       coalesce(last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, part_no ORDER BY event_id), -1) AS chapter
FROM e""")
def section_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "signup", "part").when(F.col("event_type") == "purchase", "chapter")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_id").alias("ord"), kind.alias("kind"), F.col("event_id").alias("text"))
    return parse.carried(rows, "user_id").select("event_id", *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("part", "chapter")))


@query("""
WITH s AS (SELECT event_id, user_id, CASE WHEN event_type IN ('signup', 'purchase') THEN event_type END AS section FROM events),
p AS (SELECT *, last_value(section IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT event_id, section IS NOT NULL AND section IS DISTINCT FROM before AS headed FROM p""")
def section_break_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    section = F.when(F.col("event_type").isin("signup", "purchase"), F.col("event_type"))
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", section.alias("section")))).alias("e"))
    flags = users.select("e", render.starts(F.transform("e", lambda x: x["section"])).alias("headed"))
    return flags.select(F.inline(F.arrays_zip("e", "headed"))).select("e.event_id", "headed")


@query("""
WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' \t\r')), lambda x: x <> '') AS p FROM documents)
SELECT doc_id FROM l WHERE len(list_filter(range(2, len(p) + 1), lambda i: p[i] = p[i - 1] AND length(p[i]) > 25 AND NOT regexp_matches(p[i], '^[#|>-]'))) > 0""")
def duplicate_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("p", quality.paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n"))))
    return docs.where(quality.repeated_paragraph(F.col("p"))).select("doc_id")


@query("SELECT doc_id, CASE WHEN contains(text, 'Licensed under') THEN 'Licensed under' WHEN contains(text, '###') THEN '###' WHEN contains(text, ' the ') THEN ' the ' END AS found FROM documents")
def noise_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", quality.first_match(F.col("text"), ("Licensed under", "###", " the ")).alias("found"))


TITLES = ["#REF!", "#DIV/0!", " #N/A ", "#REF x", "REF", "", "#NUM", "a #NAME?"]


@query(f"""
WITH k AS ({expected(list(enumerate(TITLES)), 'i, title')})
SELECT doc_id, regexp_matches(trim(title || CASE WHEN doc_id % 5 = 0 THEN lang ELSE ' ' END), '^#(REF|N/A|VALUE|DIV/0|NAME|NULL|NUM)[!?]?$') AS broken FROM documents JOIN k ON k.i = doc_id % {len(TITLES)}""")
def broken_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = values(spark, list(enumerate(TITLES)), "i int, title string")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.col("doc_id") % len(TITLES)).cast("int").alias("i")).join(F.broadcast(known), "i")
    return rows.select("doc_id", quality.broken_title(F.concat("title", F.when(F.col("doc_id") % 5 == 0, F.col("lang")).otherwise("\u2003 "))).alias("broken"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 AND doc_id % 3 <> 0 THEN 'مصنَّف لكنه في غير-مصنف'
  WHEN doc_id % 3 <> 0 AND doc_id % 5 <> 1 THEN 'التصنيف «' || source || '» لا يطابق المجلد «' || lang || '»'
  WHEN doc_id % 3 = 0 AND doc_id % 5 <> 0 THEN 'بلا حقل category رغم وجوده في مجلد مصنَّف' END AS issue FROM documents""")
def category_folder_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    folder = F.when(F.col("doc_id") % 5 == 0, paths.UNCATEGORIZED).when(F.col("doc_id") % 5 == 1, F.col("source")).otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", quality.category_issue(category, folder).alias("issue"))


def _corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as corpus files: every seventh without title, every eleventh with a broken one."""
    docs = table(spark, sf_dir, "documents")
    title = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 11 == 0, '"#REF!"').otherwise(F.concat(F.lit('"doc \\"'), F.col("doc_id").cast("string"), F.lit('\\""')))
    head = F.concat(F.lit("---\ntitle: "), title, F.lit('\nsource_url: "https://x.test/'), F.col("doc_id").cast("string"), F.lit('"\ncategory: "'), F.col("lang"), F.lit('"\n---\n\n# '))
    return docs.select(F.concat(F.lit("root/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("path"), F.concat(head, F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("text"), "doc_id")


S_REPEATED = """
  SELECT doc_id FROM (SELECT doc_id, list_filter(list_transform(string_split('# ' || text, chr(10)), lambda x: trim(x, ' \t\r')), lambda x: x <> '') AS p FROM documents)
  WHERE len(list_filter(range(2, len(p) + 1), lambda i: p[i] = p[i - 1] AND length(p[i]) > 25 AND NOT regexp_matches(p[i], '^[#|>-]'))) > 0"""


@query(f"""
SELECT 'V8' AS rule, 'error' AS severity, count(*) AS n FROM documents WHERE doc_id % 7 = 0
UNION ALL SELECT 'V3', 'error', count(*) FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 = 0
UNION ALL SELECT 'V9', 'error', count(*) FROM ({S_REPEATED})
UNION ALL SELECT 'V10', 'warning', count(*) FROM documents""")
def lint_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.lint(_corpus(spark, sf_dir).select("path", "text")).groupBy("rule", "severity").agg(F.count("*").alias("n"))


@query(f"""
WITH r AS ({S_REPEATED}), e AS (SELECT doc_id, (doc_id % 7 = 0)::INT + (doc_id % 7 <> 0 AND doc_id % 11 = 0)::INT + (doc_id IN (FROM r))::INT AS n FROM documents)
SELECT count(*) AS files, sum(n)::BIGINT AS errors, count(*) AS warnings, count(*) FILTER (n > 0) AS files_with_errors, sum(n) > 0 AS failed FROM e""")
def lint_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _corpus(spark, sf_dir).select("path", "text")
    return quality.lint_summary(quality.lint(files), files)


@query("""
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '#REF!' ELSE 'doc "' || doc_id || '"' END AS title, 'https://x.test/' || doc_id AS source_url, lang AS category,
       md5(chr(10) || '# ' || replace(text, chr(10), chr(10) || chr(10))) AS body FROM documents""")
def front_matter_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return _corpus(spark, sf_dir).select("doc_id", frontmatter.read_text(t, "title").alias("title"), frontmatter.read_field(t, "source_url").alias("source_url"), frontmatter.read_field(t, "category").alias("category"), F.md5(frontmatter.body(t).cast("binary")).alias("body"))


@query("SELECT doc_id, 'new \"' || source || '\"' AS category, 'a, b|' || lang AS urls FROM documents")
def front_matter_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _corpus(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    changed = frontmatter.set_list(frontmatter.set_field(F.col("text"), "category", F.concat(F.lit('new "'), "source", F.lit('"'))), "also_available_from", F.array(F.lit("a, b"), "lang"))
    return files.select("doc_id", changed.alias("t")).select("doc_id", frontmatter.read_text(F.col("t"), "category").alias("category"), F.array_join(frontmatter.read_list(F.col("t"), "also_available_from"), "|").alias("urls"))


TYPES = [
    ("نظام العمل", "", False, "نظام"), ("تنظيم الهيئة", "", False, "نظام"), ("نظاميات", "", False, "أخرى"), ("اللائحة التنفيذية", "", False, "لائحة"), ("دليل", "", False, "لائحة"),
    ("مرسوم  ملكي رقم", "", False, "مرسوم ملكي"), ("أمر ملكي", "", False, "أمر ملكي"), ("وزارة: قرار رقم ١", "", False, "قرار"), ("مذكرة تفاهم", "", False, "اتفاقية"),
    ("ضوابط", "", False, "معايير"), ("نص", "", True, "قرار"), ("نص", "", False, "أخرى"), ("نظام العمل", "https://x.test/nezam_update/1", False, "تعديل"),
]


@query(f"WITH k AS ({expected([(i, *x) for i, x in enumerate(TYPES)], 'i, title, url, is_decision, doc_type')}) SELECT doc_id, k.doc_type FROM documents JOIN k ON k.i = doc_id % {len(TYPES)}")
def doc_type_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under one of the titles, with its own number behind where that changes nothing."""
    known = values(spark, [(i, *x[:3]) for i, x in enumerate(TYPES)], "i int, title string, url string, is_decision boolean")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % len(TYPES)).cast("int").alias("i")).join(F.broadcast(known), "i")
    return rows.select("doc_id", classify.doc_type(F.concat("title", F.lit("  "), F.col("doc_id")), F.col("url"), F.col("is_decision")).alias("doc_type"))


CATEGORIES = [
    ("الأنظمة السعودية – أنظمة العمل والرعاية الاجتماعية", "نظام", "أنظمة العمل والرعاية الاجتماعية"), ("الأنظمة السعودية", "لائحة", "لائحة"), ("", "نظام", "التنظيمات"), (None, "أخرى", None),
    ("الرياضة والشباب.", "نظام", "أنظمة الشباب والرياضة"), ("الأنظمة السعودية - أ – ب", None, "أ"), ("لوائح وقواعد", None, "لائحة"),
]


@query(f"WITH k AS ({expected([(i, *x) for i, x in enumerate(CATEGORIES)], 'i, raw, doc_type, category')}) SELECT doc_id, k.category FROM documents JOIN k ON k.i = doc_id % {len(CATEGORIES)}")
def category_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = values(spark, [(i, *x[:2]) for i, x in enumerate(CATEGORIES)], "i int, raw string, doc_type string")
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % len(CATEGORIES)).cast("int").alias("i")).join(F.broadcast(known), "i")
    return rows.select("doc_id", classify.resolve_category(F.col("raw"), F.col("doc_type")).alias("category"))


LABELS = [
    ("الأولى", 1, False), ("الثانية", 2, False), ("التاسعة", 9, False), ("العاشرة", 10, False), ("الحادية عشرة", 11, False), ("التاسعة عشرة", 19, False), ("العشرون", 20, False), ("الحادية والعشرون", 21, False),
    ("الخامسة والثلاثون", 35, False), ("التاسعة والسبعون", 79, False), ("التسعون", 90, False), ("المائة", 100, False), ("الأولى بعد المائة", 101, False), ("الحادية عشرة بعد المائة", 111, False),
    ("الخامسة والعشرون بعد المائتين", 225, False), ("٧٩", 79, False), ("245", 245, False), ("٧٩ مكرر", 79, True), ("الثالثة مكرر", 3, True), ("الثالثة نطاق سريان اللائحة", 3, False), ("غير معروف", None, False), ("", None, False),
]


@query(f"""
WITH k AS ({expected([(i, *x) for i, x in enumerate(LABELS)], 'i, label, number, is_bis')})
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id % 1000 + 1 ELSE k.number END AS number, CASE WHEN doc_id % 2 = 0 THEN doc_id % 3 = 0 ELSE k.is_bis END AS is_bis
FROM documents JOIN k ON k.i = doc_id % {len(LABELS)}""")
def ordinal_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other document has a number of its own in digits, some of them repeated, the rest a label in words."""
    known = values(spark, [(i, x[0]) for i, x in enumerate(LABELS)], "i int, label string")
    id = F.col("doc_id")
    digits = F.concat(F.translate((id % 1000 + 1).cast("string"), "0123456789", text.ARABIC_DIGITS), F.when(id % 3 == 0, " مكرر").otherwise(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (id % len(LABELS)).cast("int").alias("i")).join(F.broadcast(known), "i")
    parsed = rows.select("doc_id", ordinals.parse_label(F.when(id % 2 == 0, digits).otherwise(F.col("label"))).alias("p"))
    return parsed.select("doc_id", F.col("p.number").cast("long").alias("number"), "p.is_bis")


#: Labels that prose can name: those with a number, without what follows it.
NAMED = [x[0] for x in LABELS if x[1] is not None and "نطاق" not in x[0]]


@query(f"""
WITH k AS ({expected(list(enumerate(NAMED)), 'i, label')})
SELECT doc_id, a.label || '|' || b.label AS labels, 2 AS n FROM documents JOIN k a ON a.i = doc_id % {len(NAMED)} JOIN k b ON b.i = doc_id * 7 % {len(NAMED)}""")
def label_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two articles are named in every document's whole text, one in its middle and one at its end."""
    known = values(spark, list(enumerate(NAMED)), "i int, label string")
    id, body = F.col("doc_id"), F.col("text")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", (id % len(NAMED)).cast("int").alias("i"), (id * 7 % len(NAMED)).cast("int").alias("j"))
    rows = rows.join(F.broadcast(known), "i").join(F.broadcast(known.select(F.col("i").alias("j"), F.col("label").alias("other"))), "j")
    half = (F.char_length(body) / 2).cast("int")
    said = F.concat(F.left(body, half), F.lit(" وفق المادة "), "label", F.lit(" و"), F.substr(body, half + 1), F.lit(" والمادة "), "other", F.lit(" من"))
    named = rows.select("doc_id", said.alias("said"))
    return named.select("doc_id", F.array_join(ordinals.labels_in(F.col("said")), "|").alias("labels"), F.regexp_count("said", F.lit(ordinals.label_pattern())).alias("n"))


def s_file_names(of: str) -> str:
    return rf"""
WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[/\\:*?"<>|]', ' ', 'g'), '\s+', ' ', 'g')) AS n FROM {of}),
c AS (SELECT doc_id, trim(left(n, list_max(list_filter(range(0, 201), lambda k: strlen(left(n, k)) <= 200)))) AS c FROM n)
SELECT doc_id, coalesce(nullif(regexp_replace(c, '^\.*$', ''), ''), 'بدون-عنوان') AS name FROM c"""


@query(s_file_names("documents"))
def sanitize_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", paths.file_name(F.col("text")).alias("name"))


@query(r"""
WITH d AS (SELECT doc_id, 'نظام/' || doc_id || ':  "' || source || '"' AS title, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN lang || ' <أ>' ELSE '..' END AS category FROM documents),
n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(title, '[/\\:*?"<>|]', ' ', 'g'), '\s+', ' ', 'g')) AS t, category,
  trim(regexp_replace(regexp_replace(category, '[/\\:*?"<>|]', ' ', 'g'), '\s+', ' ', 'g')) AS c FROM d)
SELECT doc_id, CASE WHEN category IS NULL THEN 'غير-مصنف' WHEN c = '..' THEN 'بدون-عنوان' ELSE c END || '/' || t || '.md' AS path FROM n""")
def document_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    id = F.col("doc_id")
    title = F.concat(F.lit("نظام/"), id, F.lit(':  "'), "source", F.lit('"'))
    category = F.when(id % 3 == 1, F.concat("lang", F.lit(" <أ>"))).when(id % 3 == 2, "..")
    return table(spark, sf_dir, "documents").select("doc_id", paths.document_path(title, category).alias("path"))


#: Long values beside the documents, at each place of the limit within a character.
LONG_TITLES = [(-1 - k, "a" * k + "نظام المرافعات الشرعية ولائحته التنفيذية " * 12) for k in range(4)] + [(-5, "\U0001f600" * 80), (-6, "é" * 100 + "...")]


@query(s_file_names(f"(SELECT doc_id, text FROM documents UNION ALL {expected(LONG_TITLES, 'doc_id, text')})"))
def sanitize_filename_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of whole texts, with the cut at the limit of bytes that prefixes never reach."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.unionByName(values(spark, LONG_TITLES, "doc_id long, text string")).select("doc_id", paths.file_name(F.col("text")).alias("name"))


@query("""
WITH l AS (SELECT user_id, list(event_id::VARCHAR ORDER BY event_id) AS ids FROM events WHERE event_type = 'purchase' GROUP BY user_id)
SELECT user_id, array_to_string(ids[1:5], '، ') || CASE WHEN len(ids) > 5 THEN ' (+' || (len(ids) - 5) || ')' ELSE '' END AS preview FROM l""")
def empty_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").where("event_type = 'purchase'").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string")).alias("ids"))
    return ids.select("user_id", quality.preview(F.col("ids")).alias("preview"))


S_RESULTS = "SELECT event_id AS ord, CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 10 = 1 THEN 'unchanged' ELSE 'ok' END AS status, CASE WHEN event_id % 6 <> 0 THEN event_type END AS doc_type FROM events"


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 10 == 0, "failed").when(F.col("event_id") % 10 == 1, "unchanged").otherwise("ok")
    warned = F.when(F.col("event_id") % 4 == 0, F.array(F.lit("w"))).otherwise(F.expr("cast(array() as array<string>)"))
    return e.select(F.col("event_id").alias("ord"), status.alias("status"), F.when(F.col("event_id") % 6 != 0, F.col("event_type")).alias("doc_type"), warned.alias("warnings"))


@query(f"WITH r AS ({S_RESULTS}) SELECT coalesce(doc_type, 'غير محدد') AS doc_type, count(*) AS n, min(ord) AS first FROM r WHERE status = 'ok' GROUP BY 1")
def run_report_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.type_histogram(_results(spark, sf_dir))


@query(f"WITH r AS ({S_RESULTS}) SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'unchanged') AS unchanged, count(*) FILTER (status = 'ok' AND ord % 4 = 0) AS warned, 4::BIGINT AS skipped FROM r")
def run_report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.status_counts(_results(spark, sf_dir), 4)


@query(f"""
WITH p AS (SELECT page_id AS ord, url || '/' || page_id AS url, 'k/' || left(md5({S_H1}), 2) || '.md' AS wanted, page_id % 3 = 0 AS mine FROM pages),
a AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY mine DESC, ord) AS r FROM p),
n AS (SELECT *, 'k/' || wanted[3:4] || ' (' || ord || ')' AS name FROM a)
SELECT url, CASE WHEN r = 1 THEN wanted ELSE name || '.md' END AS path FROM n""")
def collision_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    wanted = F.concat(F.lit("k/"), F.left(F.md5(h1(F.col("html")).cast("binary")), F.lit(2)), F.lit(".md"))
    url = F.concat(F.regexp_replace("url", "[?#].*", ""), F.lit("/"), F.col("page_id").cast("string"), F.regexp_extract("url", "([?#].*)", 1))
    claims = pages.select(url.alias("own"), F.concat("url", F.lit("/"), F.col("page_id").cast("string")).alias("url"), wanted.alias("wanted"), F.when(F.col("page_id") % 3 == 0, wanted).alias("owned"), F.col("page_id").alias("ord"))
    settled = corpus.settle_paths(claims.select(F.col("own").alias("url"), "wanted", "owned", "ord"))
    return settled.join(claims.select(F.col("own"), F.col("url").alias("named")), F.col("own") == settled["url"]).select(F.col("named").alias("url"), "path")


@query("""
WITH c AS (SELECT doc_id AS ord, 'https://x.test/' || doc_id || '/' || lang AS url, CASE WHEN doc_id % 10 = 3 THEN 'k/' || source || ' (' || lang || ') ' || (doc_id // 10 + 2) || '.md' ELSE 'k/' || source || '.md' END AS wanted, lang FROM documents),
a AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY ord) AS r FROM c),
s AS (SELECT *, replace(wanted, '.md', '') || ' (' || lang || ')' AS name FROM a WHERE r > 1),
b AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord) AS k FROM s),
n AS (SELECT *, count(*) OVER (PARTITION BY name) AS m FROM b),
q AS (SELECT name, unnest(range(2, 2 + m + (SELECT count(*) FROM a WHERE r = 1))) AS x FROM (SELECT DISTINCT name, m FROM n)),
f AS (SELECT name, x, row_number() OVER (PARTITION BY name ORDER BY x) AS k FROM q WHERE name || ' ' || x || '.md' NOT IN (SELECT wanted FROM a WHERE r = 1))
SELECT url, wanted AS path FROM a WHERE r = 1
UNION ALL SELECT url, n.name || '.md' FROM n WHERE k = 1
UNION ALL SELECT url, n.name || ' ' || x || '.md' FROM n JOIN f ON f.name = n.name AND f.k = n.k - 1""")
def collision_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few names that all documents want, few slugs, and numbered names that a tenth of the documents want themselves."""
    id = F.col("doc_id")
    numbered = F.concat(F.lit("k/"), "source", F.lit(" ("), "lang", F.lit(") "), F.expr("doc_id div 10 + 2").cast("string"), F.lit(".md"))
    wanted = F.when(id % 10 == 3, numbered).otherwise(F.concat(F.lit("k/"), "source", F.lit(".md")))
    url = F.concat(F.lit("https://x.test/"), id.cast("string"), F.lit("/"), "lang")
    claims = table(spark, sf_dir, "documents").select(url.alias("url"), wanted.alias("wanted"), F.lit(None).cast("string").alias("owned"), id.alias("ord"))
    return corpus.settle_paths(claims)


@query("""
WITH f AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'نظام ' || doc_id WHEN 1 THEN 'قرار ' || doc_id // 8 WHEN 2 THEN 'نص ' || doc_id ELSE NULL END AS title,
  CASE doc_id % 4 WHEN 0 THEN 'نظام' WHEN 1 THEN 'قرار' WHEN 2 THEN 'أخرى' ELSE 'أخرى' END AS kind FROM documents),
g AS (SELECT *, CASE WHEN doc_id % 4 = 2 THEN 'غير-مصنف' WHEN doc_id % 4 = 0 THEN 'التنظيمات' ELSE kind END AS folder FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY folder, title ORDER BY 'old/' || doc_id || '.md') AS r FROM g)
SELECT 'old/' || doc_id || '.md' AS path, CASE WHEN title IS NULL THEN 'skipped' WHEN r > 1 THEN 'conflict' ELSE 'move' END AS action FROM r""")
def reclassify_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, id = F.col("doc_id") % 4, F.col("doc_id").cast("string")
    title = F.when(n == 0, F.concat(F.lit("نظام "), id)).when(n == 1, F.concat(F.lit("قرار "), F.expr("doc_id div 8").cast("string"))).when(n == 2, F.concat(F.lit("نص "), id))
    none = F.lit(None).cast("string")
    files = table(spark, sf_dir, "documents").select(F.concat(F.lit("old/"), id, F.lit(".md")).alias("path"), title.alias("title"), none.alias("source_url"), F.lit("أخرى").alias("doc_type"), none.alias("category"), F.lit(False).alias("is_decision"))
    return corpus.reclassify(files).select("path", "action")


@query("""
WITH c AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0), i AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0),
u AS (SELECT coalesce(c.k, i.k) AS k, c.k AS a, i.k AS b FROM c FULL JOIN i ON c.k = i.k)
SELECT k::VARCHAR AS url, CASE WHEN b IS NOT NULL AND k % 10 = 0 THEN 'new/' ELSE 'k/' END || k || '.md' AS path, CASE WHEN b IS NULL THEN 'kept' WHEN a IS NULL THEN 'added' WHEN k % 10 = 0 THEN 'moved' WHEN k % 4 = 0 THEN 'same' ELSE 'updated' END AS action FROM u""")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("url"), F.concat(F.lit("k/"), key, F.lit(".md")).alias("path"), F.lit("old").alias("text"))
    wanted = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("new/"), key, F.lit(".md"))).otherwise(F.col("path"))
    incoming = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("ord"), "url", wanted.alias("wanted"), F.when(F.col("o_orderkey") % 4 == 0, "old").otherwise("new").alias("text"))
    return corpus.upsert(orders.where("o_orderkey % 3 <> 0").select("url", "path", "text"), incoming).select("url", "path", "action")


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    own = pages.select(F.concat(F.lit("d/"), F.col("page_id").cast("string"), F.lit(".md")).alias("path"), h1(F.col("html")).alias("title"), F.when(F.col("page_id") % 2 == 0, "نظام").alias("doc_type"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("status"), F.lit("s").alias("source"), F.col("url").alias("source_url"), F.when(F.col("page_id") % 5 == 0, F.array(F.lit("u"), F.lit("v"))).otherwise(F.expr("cast(array() as array<string>)")).alias("also_available_from"))
    return report.index(own)


S_INDEX = f"""SELECT 'd/' || page_id || '.md' AS path, '{{"path":"d/' || page_id || '.md","title":' || to_json({S_H1}) || CASE WHEN page_id % 2 = 0 THEN ',"doc_type":"نظام"' ELSE '' END || ',"source":"s","source_url":' || to_json(url)
  || CASE WHEN page_id % 5 = 0 THEN ',"also_available_from":["u","v"]' ELSE '' END || '}}' AS entry FROM pages"""


@query(S_INDEX)
def metadata_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir)


@query(f"WITH i AS ({S_INDEX}) SELECT path, entry, 'added' AS change FROM i WHERE path LIKE '%7.md'")
def index_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _index(spark, sf_dir)
    return report.stale(new.where(~F.col("path").like("%7.md")), new).select("path", "entry", "change")


@query("""
WITH a AS (SELECT conv_id, md5('---' || chr(10) || 'title: "conv ' || conv_id || '"' || chr(10) || 'source: s' || chr(10) || 'source_url: "u/' || conv_id || '"' || chr(10) || 'status: "x \\\\ \\"y\\""' || chr(10)
  || 'note: "نسخة غير رسمية مستخرجة آليًا من موقع s. لا يُعتد بها كمصدر رسمي؛ للتحقق يُرجى الرجوع إلى جريدة أم القرى (uqn.gov.sa) وبوابة الأنظمة السعودية لدى هيئة الخبراء (laws.boe.gov.sa)."' || chr(10) || '---' || chr(10) || chr(10) || '# conv ' || conv_id
  || string_agg(CASE WHEN turn % 4 = 0 THEN chr(10) || chr(10) || '## part ' || turn ELSE '' END || chr(10) || chr(10) || '### المادة ' || turn || chr(10) || chr(10) || trim(text, ' ' || chr(10) || chr(9) || chr(13)), '' ORDER BY turn) || chr(10)) AS digest FROM conversations GROUP BY conv_id)
SELECT * FROM a""")
def render_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("turn").cast("string")
    entry = F.struct(n.alias("number"), "text", F.lit(None).cast("bigint").alias("number_int"), F.lit(False).alias("is_bis"), F.when(F.col("turn") % 4 < 2, F.concat(F.lit("part "), (F.col("turn") - F.col("turn") % 4).cast("string"))).alias("section"), F.expr("cast(array() as array<string>)").alias("amendment_history"))
    arts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", entry.alias("a")))), lambda x: x["a"]).alias("articles"))
    id = F.col("conv_id").cast("string")
    docs = arts.select("conv_id", F.concat(F.lit("u/"), id).alias("url"), F.lit("s").alias("source"), F.concat(F.lit("conv "), id).alias("title"), F.lit('x \\ "y"').alias("status"), F.lit(False).alias("is_decision"), "articles", F.lit(None).cast("string").alias("body"))
    return render.render(docs).select("conv_id", F.md5(F.col("text").cast("binary")).alias("digest"))


# The given pages have one article of a heading and paragraphs, some of which nothing closes, among menus, scripts and comments.
S_PAGE_BLOCKS = r"""a AS (SELECT page_id, html, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1', 1) AS h, string_split_regex(regexp_extract(html, '(?is)<article[^>]*>(.*?)</article', 1), '(?i)<p(\s[^>]*)?>') AS p FROM pages),
raw AS (SELECT page_id, 0 AS ord, 'h1' AS kind, 'h1' AS tag, h AS t FROM a WHERE regexp_matches(html, '(?i)<h1[\s>]')
  UNION ALL SELECT page_id, i, 'block', 'p', regexp_extract(p[i + 1], '(?is)^(.*?)(</p|$)', 1) FROM a, unnest(range(1, len(p))) AS u(i)),
plain AS (SELECT * EXCLUDE (t), regexp_replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t FROM raw),
block AS (SELECT page_id, ord::INT AS ord, kind, tag, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM plain)"""


@query(f"WITH {S_PAGE_BLOCKS} SELECT page_id, ord, kind, tag, false AS in_list, false AS in_table, text FROM block")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.bound_batches(spark)
    found = table(spark, sf_dir, "pages").select("page_id", F.posexplode(html.blocks(F.col("html"))).alias("ord", "b"))
    return found.select("page_id", "ord", "b.kind", "b.tag", "b.in_list", "b.in_table", "b.text")


@query(f"""
WITH {S_PAGE_BLOCKS}
SELECT page_id::VARCHAR AS url, max(text) FILTER (kind = 'h1') AS title, string_agg(text, chr(10) || chr(10) ORDER BY ord) FILTER (kind = 'block' AND text <> '') AS body, NULL::VARCHAR AS error FROM block GROUP BY page_id""")
def html_prose_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("url"), "html")
    return parse.headed_documents(pages, "s").select("url", "title", "body", "error")


@query("""
WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 4 THEN NULL ELSE turn + (turn >= 3)::INT END AS number FROM conversations),
p AS (SELECT *, last_value(number IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM t)
SELECT conv_id::VARCHAR AS url, 'V1' AS rule, CASE WHEN number IS NULL THEN 'تعذر تحويل رقم المادة إلى عدد: «' || turn || '»' ELSE 'خلل في التسلسل: بعد المادة ' || prev || ' جاءت المادة ' || number END AS message FROM p WHERE number IS NULL OR number <> prev + 1
UNION ALL SELECT conv_id::VARCHAR, 'V7', 'مواد بلا متن: 0' FROM conversations WHERE turn = 0""")
def import_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("turn")
    entry = F.struct(t.cast("string").alias("number"), F.when(t == 0, " ").otherwise("x").alias("text"), F.when(t % 5 != 4, t + (t >= 3).cast("long")).alias("number_int"), F.lit(False).alias("is_bis"))
    docs = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("url")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", entry.alias("a")))), lambda x: x["a"]).alias("articles"))
    return quality.issues(docs.select("url", F.lit("t").alias("title"), F.lit(False).alias("is_decision"), "articles", F.lit(None).cast("string").alias("body"))).select("url", "rule", "message")


# Pages made of the conversations: a page each, its turns as paragraphs, articles, items or rows.
S_SAID = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"


def _pages_of(spark: SparkSession, sf_dir: str, piece: Callable[[Column], Column], before: str, after: str) -> DataFrame:
    """url, html: ``piece`` of each turn's text between two literals; texts are escaped."""
    said = text.squeeze(F.coalesce("text", F.lit("")))
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        said = F.replace(said, F.lit(sign), F.lit(name))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", said.alias("said"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece(F.col("said")).alias("x")))), lambda e: e["x"]), "\n")
    return turns.groupBy("conv_id").agg(joined.alias("x")).select(F.col("conv_id").cast("string").alias("url"), F.concat(F.lit(before), "x", F.lit(after)).alias("html"))


def _turn() -> Column:
    return F.col("turn").cast("string")


@query(f"""
WITH t AS (SELECT conv_id, turn, '| ' || role || ' | ' || CASE WHEN turn % 3 = 2 THEN '' ELSE replace({S_SAID}, '|', '\\|') END || ' |' AS line FROM conversations)
SELECT conv_id::VARCHAR AS url, '| role | said |' || chr(10) || '| --- | --- |' || chr(10) || string_agg(line, chr(10) ORDER BY turn) || chr(10) || chr(10) || 'x' AS body FROM t GROUP BY conv_id""")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row is a cell short."""
    row = lambda said: F.concat(F.lit("<tr><td> "), "role", F.when(F.col("turn") % 3 == 2, F.lit("")).otherwise(F.concat(F.lit("<td>"), said)), F.lit("</tr>"))
    pages = _pages_of(spark, sf_dir, row, "<h1>t</h1><article><table><tr><th>role</th><th>said</th></tr>", "</table><p>x<table></table></article>")
    return parse.headed_documents(pages, "s").select("url", "body")


@query(f"""
WITH t AS (SELECT conv_id, turn, {S_SAID} AS said, max(CASE WHEN turn % 4 = 0 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS part, max(CASE WHEN turn % 4 = 2 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS chapter FROM conversations)
SELECT conv_id::VARCHAR AS url, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS ord, turn || CASE WHEN turn % 5 = 3 THEN ' مكرر' ELSE '' END AS number, turn::BIGINT AS number_int, turn % 5 = 3 AS is_bis,
       'الباب ' || part || CASE WHEN chapter > part THEN ' — الفصل ' || chapter ELSE '' END AS section, md5(said || CASE WHEN said = '' THEN '' ELSE chr(10) || chr(10) END || 'نص ' || turn) AS text
FROM t WHERE part IS NOT NULL""")
def headed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn is an article of two paragraphs; parts begin at every fourth, chapters two later, other headings are passed over."""
    n = _turn()
    heads = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("<h2>الباب "), n, F.lit("</h2>"))).when(F.col("turn") % 4 == 2, F.concat(F.lit("<h3>الفصل "), n, F.lit("</h3>"))).otherwise("")
    tail = F.when(F.col("turn") % 3 == 1, "<h4>عنوان</h4><p>متروك</p>").otherwise("")
    entry = lambda said: F.concat(heads, F.lit("<h3>المادة "), n, F.when(F.col("turn") % 5 == 3, " مكرر").otherwise(""), F.lit("</h3><p>"), said, F.lit("</p><ul><li>نص <b>"), n, F.lit("</b></li></ul>"), tail)
    docs = parse.headed_documents(_pages_of(spark, sf_dir, entry, '<h1>نظام</h1><nav><p>x</p></nav><div class="entry-content">', "</div>"), "s")
    return docs.select("url", F.posexplode("articles").alias("ord", "a")).where("a.section is not null").select("url", "ord", "a.number", "a.number_int", "a.is_bis", "a.section", F.md5(F.col("a.text").cast("binary")).alias("text"))


S_FIRST_LAST = "SELECT conv_id::VARCHAR AS url, 'نظام ' || min(turn) AS title, arg_min(role, turn) || ' ' || min(turn) AS issued_by, arg_max(role, turn) || ' ' || max(turn) AS issued_date, 'نشر في عدد جريدة أم القرى رقم ' || max(turn) AS gazette_ref"


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _turn()
    entry = lambda said: F.concat(F.lit("<h1>Arabic Full Name: نظام "), n, F.lit("</h1><p>صدر بموجب: "), "role", F.lit(" "), n, F.lit("..</p><p>صدر في "), "role", F.lit(" "), n, F.lit("</p><p>نشر في عدد جريدة أم القرى رقم "), n, F.lit("</p><p>رئيس مجلس الوزراء</p><p>"), said, F.lit("</p>"))
    return parse.headed_documents(_pages_of(spark, sf_dir, entry, "", "<h3>أولا</h3><p>x</p>"), "s")


@query(f"{S_FIRST_LAST}, true AS is_decision, CAST(NULL AS VARCHAR) AS error FROM conversations GROUP BY conv_id")
def headed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).select("url", "title", "issued_by", "issued_date", "gazette_ref", "is_decision", "error")


@query(f"WITH f AS ({S_FIRST_LAST} FROM conversations GROUP BY conv_id) SELECT url, issued_by AS first, issued_date AS last FROM f")
def first_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a page's lines on who issued it the first counts, of those on when the last."""
    return _facts(spark, sf_dir).select("url", F.col("issued_by").alias("first"), F.col("issued_date").alias("last"))


@query(f"""
WITH t AS (SELECT conv_id, turn, {S_SAID} AS said FROM conversations)
SELECT conv_id::VARCHAR AS url, md5(coalesce(string_agg(said, chr(10) || chr(10) ORDER BY turn) FILTER (said <> ''), '')) AS text, count(*) FILTER (said <> '') AS n FROM t GROUP BY conv_id""")
def article_text_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of a conversation as the paragraphs of one article."""
    docs = parse.headed_documents(_pages_of(spark, sf_dir, lambda said: F.concat(F.lit("<p>"), said, F.lit("</p>")), "<h1>t</h1><h3>المادة الأولى</h3>", ""), "s")
    whole = F.get("articles", F.lit(0))["text"]
    return docs.select("url", F.md5(whole.cast("binary")).alias("text"), F.when(whole == "", 0).otherwise(F.size(F.split(whole, "\n\n"))).cast("long").alias("n"))


@query(f"""
SELECT conv_id::VARCHAR AS url, 'قرار؛ ' || conv_id AS issued_by, turn::VARCHAR || CASE WHEN turn % 4 = 1 THEN ' مكرر' ELSE '' END AS number, turn::BIGINT AS number_int, turn % 4 = 1 AS is_bis,
       md5(CASE WHEN turn % 3 = 0 THEN '' ELSE {S_SAID} || CASE WHEN {S_SAID} = '' THEN '' ELSE chr(10) || chr(10) END END || 'ثان') AS text,
       CASE WHEN turn % 3 = 0 THEN 'تم بموجب المرسوم الملكي رقم م/2 تعديل هذه المادة لتكون بالنص الآتي:' ELSE '' END AS history FROM conversations""")
def listed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A turn is a list item of two lines; of every third the first line is an amendment's clause."""
    n = _turn()
    past = F.lit("تم بموجب المرسوم الملكي رقم م/2 تعديل هذه المادة لتكون بالنص الآتي:")
    item = lambda said: F.concat(F.lit('<li class="subject"><h4>المادة '), n, F.when(F.col("turn") % 4 == 1, " مكرر").otherwise(""), F.lit('</h4><div class="content">'), F.when(F.col("turn") % 3 == 0, past).otherwise(said), F.lit("<br>ثان</div></li>"))
    pages = _pages_of(spark, sf_dir, item, "<ul>", "</ul>")
    card = F.concat(F.lit('<h1>نظام</h1><p class="heading-system-single">بطاقة</p><div><table><tr><td>الاعتماد :</td><td>قرار<br>'), "url", F.lit(".</td></tr></table></div>"))
    docs = parse.listed_documents(pages.select("url", F.concat(card, "html").alias("html")), "s")
    return docs.select("url", "issued_by", F.explode("articles").alias("a")).select("url", "issued_by", "a.number", "a.number_int", "a.is_bis", F.md5(F.col("a.text").cast("binary")).alias("text"), F.array_join("a.amendment_history", "|").alias("history"))


@query("""
WITH b AS (SELECT doc_id::VARCHAR AS url, doc_id % 6 AS k, coalesce(text, '') AS body FROM documents)
SELECT url, 'V4' AS rule, 'الوثيقة بلا محتوى: لا مواد ولا متن' AS message FROM b WHERE k = 0
UNION ALL SELECT url, 'V5', 'وثيقة نثرية تحوي عدة نصوص «المادة …»؛ يُحتمل فشل تقطيع المواد (تغيّر بنية المصدر؟)' FROM b WHERE k = 1
UNION ALL SELECT url, 'V6', 'بقايا ضجيج واجهة في المتن: «' || CASE k WHEN 2 THEN 'حجم الخط' ELSE 'رابط المادة' END || '»' FROM b WHERE k IN (2, 4)
UNION ALL SELECT url, 'V3', 'عنوان يشبه خطأ صيغة جدول بيانات: «#N/A»' FROM b WHERE k = 5""")
def import_issues_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as documents without articles: one in six is empty, the others name articles, carry page controls or have a broken title."""
    k, body = F.col("doc_id") % 6, F.coalesce("text", F.lit(""))
    said = (
        F.when(k == 0, " ").when(k == 1, F.concat(F.lit("وفق المادة الأولى "), body, F.lit(" و المادة الثانية من")))
        .when(k == 2, F.concat(body, F.lit(" حجم الخط"))).when(k == 3, F.concat(body, F.lit(" المادة الثالثة من")))
        .when(k == 4, F.concat(F.lit("جميع الحقوق محفوظة "), body, F.lit(" رابط المادة"))).otherwise(F.concat(body, F.lit("x")))
    )
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("url"), F.when(k == 5, "#N/A").otherwise("t").alias("title"), F.lit(False).alias("is_decision"), F.expr(f"cast(array() as array<{parse.ARTICLE_TYPE}>)").alias("articles"), said.alias("body"))
    return quality.issues(docs).select("url", "rule", "message")


@query("""
WITH t AS (SELECT conv_id, turn, turn + (turn >= 2)::INT AS n FROM conversations WHERE turn % 5 <> 4),
p AS (SELECT *, lag(n) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM t)
SELECT 'k/' || conv_id || '.md' AS path, 'خلل تسلسل: بعد ' || prev || ' جاءت ' || n AS message FROM p WHERE n <> prev + 1""")
def lint_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of articles: numbers leave a place out, repeats and headings without a number are passed over."""
    t = F.col("turn")
    heading = F.when(t % 5 == 4, F.concat(F.lit("### المادة غير معلومة "), t)).otherwise(F.concat(F.lit("## المادة "), t + (t >= 2).cast("int")))
    again = F.when(t % 3 == 0, F.concat(F.lit("\n\n## المادة "), t + 40, F.lit(" مكرر\n"))).otherwise("")
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.concat(heading, F.lit("\n\n"), F.coalesce("text", F.lit("")), again).alias("x")))), lambda x: x["x"]), "\n\n").alias("x"))
    made = turns.select(F.concat(F.lit("k/"), "conv_id", F.lit(".md")).alias("path"), F.concat(F.lit('---\ntitle: "t"\nsource_url: "u"\ncategory: "k"\n---\n\n# t\n\n'), "x").alias("text"))
    return quality.lint(made).where("rule = 'V11'").select("path", "message")


@query(f"SELECT doc_id::VARCHAR AS url, CASE WHEN doc_id % 3 <> 1 AND doc_id % 2 = 0 THEN '{corpus.WORSE}' END AS reason FROM documents")
def article_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of three files have articles or clauses in their whole text; every other page comes as prose."""
    id, body = F.col("doc_id"), F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(id.cast("string").alias("url"), id, body.alias("said"))
    there = F.when(id % 3 == 0, F.concat("said", F.lit("\n\n### المادة الأولى\n"))).when(id % 3 == 2, F.concat("said", F.lit("\n## أولاً \n\nx"))).otherwise(F.concat("said", F.lit("\nالمادة الأولى")))
    new = docs.select("url", F.expr(f"cast(array() as array<{parse.ARTICLE_TYPE}>)").alias("articles"), F.when(id % 2 == 0, F.concat("said", F.lit("x"))).alias("body"))
    return corpus.guard(new, docs.select("url", there.alias("text"))).select("url", "reason")


@query(f"""
SELECT doc_id::VARCHAR AS url, CASE doc_id % 7 WHEN 0 THEN '{parse.NOT_LANDED}' WHEN 1 THEN '{parse.UNKNOWN}' WHEN 2 THEN '{parse.NO_TITLE}' WHEN 3 THEN '{parse.NO_ITEMS}' WHEN 4 THEN '{parse.NOTHING}' WHEN 5 THEN 'prose instead of articles' END AS reason
FROM documents WHERE doc_id % 7 < 6""")
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why pages of whole texts give no articles: of either source, of none, and of links without a page."""
    id, said = F.col("doc_id"), F.concat(F.lit("<p>x "), F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("</p>"))
    k, title = id % 7, F.lit("<h1>t</h1>")
    html = (
        F.when(k == 0, None).when(k == 2, said).when(k == 4, F.concat(title, F.lit("<nav>"), said, F.lit("</nav>")))
        .when(k == 6, F.concat(title, F.lit("<article><h3>المادة الأولى</h3>"), said, F.lit("</article>"))).otherwise(F.concat(title, F.lit("<article>"), said, F.lit("</article>")))
    )
    source = F.when(k == 1, "none").when((k == 3) | (k == 2), "nezams").otherwise("qanoonsa")
    pages = table(spark, sf_dir, "documents").select(id.cast("string").alias("url"), source.alias("source"), html.alias("html"))
    return quality.canary(parse.parse(pages))
