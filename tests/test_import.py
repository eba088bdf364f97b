"""The import in rounds, by stream, and the command's ways through it."""

import os

import pytest
from pyspark.sql import functions as F

from sijill.operators import parse
from sijill.plans import ingest as plans
from sijill.sources import files, sitemap, store, tables
from sijill.streaming import ingest

PAGE = '<h1>نظام العمل</h1><ul><li class="subject"><h4>المادة الأولى</h4><div class="content">نص</div></li></ul>'
EMPTY = "url string, path string, text string"


def page(name, text="نص"):
    return PAGE.replace("العمل", name).replace("نص", text)


@pytest.mark.parametrize("every, most", [(1, 12), (4, 120)])
def test_limit_reads_a_few_pages(spark, every, most):
    """Of 10,000 links few are read until ten succeed; the results end with the tenth."""
    links = spark.range(10_000).select((3 * F.col("id")).alias("ord"), F.concat(F.lit("https://nezams.com/"), "id").alias("url"))
    pages = links.select("url", F.when(F.col("ord") / 3 % every == every - 1, F.replace(F.lit(PAGE), F.lit("العمل"), F.col("ord").cast("string"))).otherwise("<p>x</p>").alias("html"))
    read = []

    def keep(df, name):
        out = tables.kept(df, f"test-{name}")
        if name.startswith("documents") and not name.endswith("same"):
            read.append(out.count())
        return out

    made = plans.plan(links, pages, spark.createDataFrame([], EMPTY), keep=keep, limit=10)
    rows = made.results.orderBy("ord").collect()
    assert sum(r.status == "ok" for r in rows) == 10 and rows[-1].status == "ok" and len(rows) == 10 * every
    assert [r.ord for r in rows] == [3 * i for i in range(10 * every)]
    assert sum(read) <= most and made.incoming.count() == 10


def test_limit_beyond_the_links(spark):
    links = spark.createDataFrame([(i, f"https://nezams.com/{i}") for i in range(5)], "ord int, url string")
    pages = spark.createDataFrame([(f"https://nezams.com/{i}", page(str(i))) for i in (1, 4)], "url string, html string")
    made = plans.plan(links, pages, spark.createDataFrame([], EMPTY), keep=lambda df, n: tables.kept(df, n), limit=3)
    said = {r.ord: r.reason for r in made.results.collect()}
    assert said == {0: parse.NOT_LANDED, 1: None, 2: parse.NOT_LANDED, 3: parse.NOT_LANDED, 4: None}


def test_stream_sheds_repeats_and_older_captures(spark, tmp_path):
    """Batches that are repeated, or come out of order, leave what one run over all rows leaves."""
    url = "https://nezams.com/"
    batches = [
        [(f"{url}a", page("أ", "ثان"), None, None, "2022-01-02"), (f"{url}%62", page("ب"), "e1", None, "2022-01-01"), ("https://other.test/", "x", None, None, None)],
        [(f"{url}a", page("أ", "أول"), None, None, "2022-01-01"), (f"{url}b", page("ب"), "e1", None, "2022-01-05")],
        [(f"{url}a", page("أ", "ثان"), None, None, "2022-01-02"), (f"{url}c", page("ج"), None, None, None), (f"{url}b", page("ب", "جديد"), "e2", None, "2022-01-06")],
    ]
    rows_of = lambda root: {(r.url, r.path, r.text) for r in store.read(spark, root).collect()}
    landing, root = str(tmp_path / "landing"), str(tmp_path / "corpus")
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, ingest.PAGES).coalesce(1).write.mode("append").parquet(landing)
        ingest.run(spark, landing, root).awaitTermination()
        seen.append({r.url: r.merge for r in store.read(spark, root).join(store.manifest(spark, root), "part").collect()})
    assert seen[1] == seen[0]  # a batch of repeats and older captures writes nothing
    assert len(rows_of(root)) == 3 and store.differing(spark, root).isEmpty()
    whole = str(tmp_path / "whole")
    spark.createDataFrame([r for rows in batches for r in rows], ingest.PAGES).coalesce(1).write.parquet(str(tmp_path / "all"))
    ingest.run(spark, str(tmp_path / "all"), whole).awaitTermination()
    assert rows_of(whole) == rows_of(root)
    failed = spark.read.parquet(f"{root}/failed")
    assert [(r.url, r.reason) for r in failed.collect()] == [("https://other.test/", parse.UNKNOWN)]


def cli(*argv):
    from sijill import cli

    return cli.main(list(argv))


def land(spark, at, rows):
    spark.createDataFrame(rows, "url string, html string").write.mode("overwrite").parquet(str(at))


def test_command_resumes_with_updates_and_logs_failures(spark, tmp_path, monkeypatch, capsys):
    out, pages = str(tmp_path / "laws"), tmp_path / "pages"
    monkeypatch.chdir(tmp_path)
    urls = ["https://nezams.com/a", "https://nezams.com/b", "https://nezams.com/none", "https://other.test/c"]
    land(spark, pages, [(urls[0], page("أ")), (urls[1], "<p>x</p>")])
    assert cli("import", "--pages", str(pages), "--out", out, "--failed", "failed", "--report", "--", *urls) == 1
    logged = [x.split("\t") for x in (tmp_path / "failed").read_text().splitlines()]
    assert [x[1:] for x in logged] == [[urls[1], parse.NO_TITLE], [urls[2], parse.NOT_LANDED], [urls[3], parse.UNKNOWN]]
    assert all(len(x[0]) == 19 and x[0][10] == "T" for x in logged)
    assert parse.NOT_LANDED in (tmp_path / "logs" / "summary.md").read_text()
    # What the corpus has is passed over by --resume alone, and looked at again with --check-updates.
    land(spark, pages, [(urls[0], page("أ", "تغير"))])
    text = lambda: [r.text for r in files.read_corpus(spark, out).collect()]
    assert cli("import", "--pages", str(pages), "--out", out, "--resume", urls[0]) == 0 and "تغير" not in text()[0]
    capsys.readouterr()
    assert cli("import", "--pages", str(pages), "--out", out, "--resume", "--check-updates", urls[0]) == 0 and "تغير" in text()[0]
    assert "نجح: **1**" in capsys.readouterr().out


def test_command_reads_a_file_of_a_named_source(spark, tmp_path):
    (tmp_path / "one.html").write_text(page("الملف"))
    out = str(tmp_path / "laws")
    assert cli("import", "--html", str(tmp_path / "one.html"), "--source", "nezams", "--url", "https://mirror.test/p", "--out", out) == 0
    row = files.fields(files.read_corpus(spark, out)).first()
    assert (row.source, row.source_url, row.title) == ("nezams", "https://mirror.test/p", "نظام الملف")
    with pytest.raises(ValueError):
        cli("import", "--html", str(tmp_path / "one.html"), "--source", "unheard", "--out", out)


def test_command_discovers_several_sources(spark, tmp_path, capsys):
    """A source that is unknown, and a submap that isn't landed, are said; the others are imported."""
    index = "https://nezams.com/sitemap_index.xml"
    maps = [(index, "<sitemapindex><loc>https://nezams.com/post.xml</loc><loc>https://nezams.com/gone.xml</loc><loc>https://nezams.com/bad.xml</loc></sitemapindex>"), ("https://nezams.com/post.xml", "<urlset><loc>https://nezams.com/a</loc></urlset>"), ("https://nezams.com/bad.xml", "busy")]
    spark.createDataFrame(maps, "url string, xml string").write.parquet(str(tmp_path / "maps"))
    land(spark, tmp_path / "pages", [("https://nezams.com/a", page("أ"))])
    out = str(tmp_path / "laws")
    assert cli("import", "--pages", str(tmp_path / "pages"), "--out", out, "--discover", "unheard,qanoonsa,nezams", "--maps", str(tmp_path / "maps")) == 0
    said = capsys.readouterr().err
    assert len(files.read_corpus(spark, out).collect()) == 1 and "unheard" in said and "gone.xml" in said and "bad.xml" in said and "qanoonsa.com/wp-sitemap.xml" in said
    bad = sitemap.failed(spark.createDataFrame(maps, "url string, xml string"), index, ("nezams.com",))
    assert {(os.path.basename(r.url), r.reason) for r in bad.collect()} == {("gone.xml", sitemap.NOT_LANDED), ("bad.xml", sitemap.NO_MAP)}


def site():
    """A site of a few pages: one is refused by its rules, one can't be reached, one is gone, one hasn't changed. Workers get it by value."""
    from sijill.sources.fetch import Answer

    pages = {"/same": page("ثابت"), "/a": page("أ"), "/no": page("لا")}

    def served(url, headers, timeout):
        place = url.split("nezams.com")[-1]
        if place == "/robots.txt":
            return Answer(200, "User-agent: *\nDisallow: /no")
        if place == "/same" and headers.get("If-None-Match") == "e1":
            return Answer(304)
        if place == "/down":
            raise OSError("no route")
        return Answer(200, pages[place], headers={"ETag": "e1"}) if place in pages else Answer(404)

    return served


def test_command_lands_live_pages(spark, tmp_path, monkeypatch, capsys):
    from sijill import cli as command

    monkeypatch.setattr(command, "TRANSPORT", site())
    out, failed = str(tmp_path / "laws"), tmp_path / "failed"
    urls = [f"https://nezams.com/{n}" for n in ("same", "a", "no", "down", "gone")]
    assert cli("import", "--out", out, "--delay", "0", "--failed", str(failed), *urls[:4:2]) == 1
    assert [x.split("\t")[1:] for x in failed.read_text().splitlines()] == [[urls[2], f"robots.txt disallows {urls[2]}"]]
    assert cli("import", "--out", out, "--delay", "0", "--ignore-robots", "--check-updates", "--limit", "3", *urls[:3], urls[4]) == 0
    said = capsys.readouterr().out
    assert "بلا تغيير منذ آخر جلب: **1**" in said and "نجح: **2**" in said
    rows = files.fields(files.read_corpus(spark, out)).collect()
    assert {r.source_url: r.etag for r in rows} == {u: "e1" for u in urls[:3]}


def test_landing_reads_hosts_in_order(spark):
    from sijill.sources import landing

    links = spark.createDataFrame([(i, f"https://nezams.com/{n}", "e1") for i, n in enumerate(("same", "down", "gone", "a"))], "ord int, url string, etag string")
    rows = landing.land(links, site(), delay=0, attempts=2, backoff=0).collect()
    assert [(r.url.rsplit("/", 1)[1], r.status) for r in rows] == [("same", "unchanged"), ("down", "failed"), ("gone", "failed"), ("a", "ok")]
    assert "no route" in rows[1].reason and "404" in rows[2].reason and rows[3].html and all(r.fetched_at for r in rows)
