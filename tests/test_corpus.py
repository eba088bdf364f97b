"""Corpus maintenance: merge, names, siblings, files, and what must hold when they run twice."""

import os

import pytest
from pyspark.sql import functions as F

from sijill.functions.paths import file_name
from sijill.operators import corpus, parse, quality, render, report
from sijill.sources import files
from sijill.sources.fetch import Answer, Fetcher, FetchError


def test_upsert_resolves_names_and_is_stable(spark):
    current = spark.createDataFrame([("u1", "k/T.md", "a"), ("u9", "k/Z.md", "z")], "url string, path string, text string")
    incoming = spark.createDataFrame([(0, "https://x/p/7", "k/T.md", "b"), (1, "https://x/q/7", "k/T.md", "c"), (2, "u1", "k/T.md", "a2"), (3, "u1", "k/T.md", "late")], "ord int, url string, wanted string, text string")
    first = corpus.upsert(current, incoming)
    rows = {r.url: (r.path, r.text, r.action) for r in first.collect()}
    assert rows == {"u1": ("k/T.md", "a2", "updated"), "u9": ("k/Z.md", "z", "kept"), "https://x/p/7": ("k/T (7).md", "b", "added"), "https://x/q/7": ("k/T (7) 2.md", "c", "added")}
    again = corpus.upsert(first.select("url", "path", "text"), incoming)
    assert {r.url: r.path for r in again.collect()} == {u: v[0] for u, v in rows.items()}
    assert not again.where("action in ('moved', 'added')").count()


def test_long_names_keep_their_slug(spark):
    long = "k/" + "ن" * 100 + ".md"
    claims = spark.createDataFrame([(f"https://x/{i}", long, None, i) for i in range(4)], "url string, wanted string, owned string, ord int")
    paths = [r.path for r in corpus.settle_paths(claims).collect()]
    assert len(set(paths)) == 4 and all(len(p.split("/")[1].encode()) <= 203 for p in paths)


@pytest.mark.parametrize("name, most", [("ن" * 300, 200), ("a" * 199 + "ن", 199), ("..", 19), ("a/b:c", 5)])
def test_file_name(spark, name, most):
    got = spark.range(1).select(file_name(F.lit(name)).alias("n")).first().n
    assert len(got.encode()) == most


def test_siblings_are_idempotent(spark):
    f = spark.createDataFrame([("a", "T", "https://x/%61", []), ("b", "T", "https://y/b", ["https://x/a"]), ("c", "S", "https://z", [])], "path string, title string, source_url string, also_available_from array<string>")
    rows = {r.path: (r.siblings, r.touched) for r in corpus.siblings(f).collect()}
    assert rows == {"a": (["https://y/b"], True), "b": (["https://x/a"], False)}


def test_prose_does_not_replace_articles(spark):
    current = spark.createDataFrame([("u", "---\n---\n## المادة الأولى\nx"), ("v", "text")], "url string, text string")
    incoming = parse._shaped(spark.createDataFrame([("u", "b"), ("v", "b")], "url string, body string").withColumn("articles", F.array()))
    assert {r.url: r.reason for r in corpus.guard(incoming, current).collect()} == {"u": corpus.WORSE, "v": None}


def test_render_export_scan_index(spark, tmp_path):
    pages = spark.createDataFrame([("https://nezams.com/p", "nezams", '<h1>نظام "أ"</h1><ul><li class="subject"><h4>المادة الأولى</h4><div class="content">نص</div></li></ul>')], "url string, source string, html string")
    docs = parse.parse(pages).withColumn("category", F.lit("ف"))
    out = render.render(docs.withColumn("path", F.lit("ف/a b.md")))
    render.export(out, str(tmp_path))
    text = (tmp_path / "ف" / "a b.md").read_text()
    assert text.startswith('---\ntitle: "نظام \\"أ\\""\nsource: nezams\nsource_url: "https://nezams.com/p"\ncategory: "ف"\nnote: ') and text.endswith("---\n\n# نظام \"أ\"\n\n## المادة الأولى\n\nنص\n")
    scanned = files.read_corpus(spark, str(tmp_path))
    assert [r.path for r in scanned.collect()] == ["ف/a b.md"]
    assert files.source_index(scanned).first().url == "https://nezams.com/p"
    assert quality.lint(scanned).count() == 0
    index = report.index(files.fields(scanned))
    report.write_index(index, str(tmp_path / "index.json"))
    assert '"title": "نظام \\"أ\\""' in (tmp_path / "index.json").read_text()
    assert report.stale(index, index).isEmpty()
    render.prune(str(tmp_path / "none"), str(tmp_path))


def test_links_and_report(spark, tmp_path):
    (tmp_path / "l").write_text("https://X.com/a\n\n# no\nhttps://x.com/a\nhttps://x.com/b\n")
    links = files.read_links(spark, str(tmp_path / "l"))
    assert [r.url for r in files.union_links(links, links).orderBy("ord").collect()] == ["https://x.com/a", "https://x.com/b"]
    results = spark.createDataFrame([(0, "u", "ok", "T", "نظام", None, ["w"]), (1, "v", "failed", None, None, "why", []), (2, "w", "ok", None, None, None, [])], "ord int, url string, status string, title string, doc_type string, reason string, warnings array<string>")
    said = report.summary(results, "now", 4)
    assert "- نجح: **2**" in said and "- `v` — why" in said and "- **T**\n  - w" in said and "- غير محدد: 1" in said


def test_report_has_its_parts_in_order(spark):
    schema = "ord long, url string, status string, title string, doc_type string, reason string, warnings array<string>"
    rows = [(2, "c", "ok", "", "ب", None, ["w2", "w3"]), (0, "a", "ok", "T", "أ", None, []), (1, "b", "ok", None, "ب", None, []), (9, "y", "failed", None, None, "why", []), (3, "x", "failed", None, None, "first", [])]
    said = report.summary(spark.createDataFrame(rows, schema), "now")
    assert said.split("\n")[8 - 1 :] == ["## توزيع الأنواع", "", "- ب: 2", "- أ: 1", "", "## الفشل", "", "- `x` — first", "- `y` — why", "", "## التحذيرات", "", "- **c**", "  - w2", "  - w3", ""]
    none = report.summary(spark.createDataFrame([], schema), "now")
    assert "##" not in none and none.endswith("**0**\n") and none.startswith("# ")


@pytest.mark.parametrize("limit", [0, 1, 700, 5000])
def test_success_limit_over_spread_places(spark, limit):
    """Against a plain count: places over all 64 bits, close together, and at both ends."""
    import random

    rng = random.Random(limit)
    places = sorted({*(rng.randrange(-(1 << 63), 1 << 63) for _ in range(800)), *range(-300, 300), -(1 << 63), (1 << 63) - 1})
    rows = [(p, rng.random() < 0.6) for p in places]
    want, n = [], 0
    for p, ok in rows:
        if n >= limit:
            break
        want.append(p)
        n += ok
    got = corpus.until_successes(spark.createDataFrame(rows, "ord long, ok boolean"), limit, F.col("ok"))
    assert got.columns == ["ord", "ok"]
    assert sorted(r.ord for r in got.collect()) == want


def test_links_keep_their_order_over_blocks(spark, tmp_path):
    (tmp_path / "l").write_text("".join(f"https://x.com/{i}\n# {i}\r\n\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = files.read_links(spark, str(tmp_path / "l")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r.ord for r in rows}) == 3000
    assert [r.url for r in sorted(rows, key=lambda r: r.ord)] == [f"https://x.com/{i}" for i in range(3000)]


def test_links_of_a_folder_follow_its_files(spark, tmp_path):
    (tmp_path / "lists").mkdir()
    for name in "bac":
        (tmp_path / "lists" / name).write_text("".join(f"https://x.com/{name}{i}\n" for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        rows = files.read_links(spark, str(tmp_path / "lists")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r.ord for r in rows}) == 3000
    assert [r.url for r in sorted(rows, key=lambda r: r.ord)] == [f"https://x.com/{n}{i}" for n in "abc" for i in range(1000)]


def test_files_go_to_mounted_folders_only(spark):
    with pytest.raises(ValueError):
        render.export(spark.createDataFrame([("a", "b")], "path string, text string"), "hdfs://host/x")
    assert render._mounted("file:///a/b") == render._mounted("/a/b") == render._mounted("file:/a/b") == "/a/b"


def test_fetcher():
    waits, seen = [], []

    def transport(url, headers, timeout):
        seen.append((url, headers))
        if url.endswith("robots.txt"):
            return Answer(200, "User-agent: *\nDisallow: /no")
        return {"/ok": Answer(200, "x", headers={"ETag": "e"}), "/flaky": Answer(503) if len(seen) < 4 else Answer(200, "y"), "/gone": Answer(404), "/same": Answer(304)}[url[9:]]

    f = Fetcher(transport, delay=0, sleep=waits.append)
    assert f.fetch("https://x/ok").etag == "e" and f.fetch("https://x/same", etag="q").not_modified
    assert f.fetch("https://x/flaky").html == "y" and waits == [2] or waits == [2, 4]
    with pytest.raises(FetchError):
        f.fetch("https://x/gone")
    with pytest.raises(FetchError):
        Fetcher(transport, delay=0, robots=True, sleep=waits.append).fetch("https://x/no")


PAGE = '<h1>نظام العمل</h1><ul><li class="subject"><h4>المادة الأولى</h4><div class="content">نص</div></li></ul>'


def test_import_command_and_refresh(spark, tmp_path):
    from sijill import cli

    pages = spark.createDataFrame([("https://nezams.com/a", PAGE), ("https://qanoonsa.com/b", PAGE.replace("<ul>", "<article><p>المادة").replace("</ul>", "</article>")), ("https://other.test/c", PAGE)], "url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    out = str(tmp_path / "laws")
    urls = ["https://nezams.com/%61", "https://qanoonsa.com/b", "https://other.test/c"]
    assert cli.main(["import", "--pages", str(tmp_path / "pages"), "--out", out, *urls]) == 1
    found = {r.path for r in files.read_corpus(spark, out).collect()}
    assert len(found) == 2 and "التنظيمات/نظام العمل.md" in found
    assert cli.main(["import", "--pages", str(tmp_path / "pages"), "--out", out, "--resume", *urls[:2]]) == 0
    assert cli.main(["audit-duplicates", "--out", out]) == 0 and cli.main(["index", "--out", out, "--to", str(tmp_path / "i.json")]) == 0
    assert cli.main(["index", "--out", out, "--to", str(tmp_path / "i.json"), "--check"]) == 0
    assert cli.main(["reclassify", "--out", out, "--dry-run"]) == 0 and cli.main(["canonicalize-urls", "--out", out]) == 0
    assert cli.main(["lint", "--out", out]) == 0


def landed(spark, at, rows):
    spark.createDataFrame(rows, "url string, html string, fetched_at string").write.mode("overwrite").parquet(str(at))
    return str(at)


def test_import_moves_updates_and_runs_again(spark, tmp_path, capsys):
    """A page under a new title moves its file; the report comes after, whole; logs and skips are kept; unchanged pages aren't read again."""
    from sijill import cli

    out, pages, url = str(tmp_path / "laws"), tmp_path / "pages", "https://nezams.com/a"
    run = lambda *more: cli.main(["import", "--pages", str(pages), "--out", out, *more, url])
    texts = lambda: {r.path: r.text for r in files.read_corpus(spark, out).collect()}
    landed(spark, pages, [(url, PAGE, None)])
    assert run() == 0 and list(texts()) == ["التنظيمات/نظام العمل.md"]
    landed(spark, pages, [(url, PAGE.replace("نظام العمل", "لائحة أخرى"), None)])
    assert run("--report", str(tmp_path / "report.md")) == 0
    moved = texts()
    assert len(moved) == 1 and "لائحة أخرى" in next(iter(moved)) and "# لائحة أخرى" in next(iter(moved.values()))
    assert "- نجح: **1**" in (tmp_path / "report.md").read_text()
    landed(spark, pages, [(url, PAGE.replace("نظام العمل", "لائحة أخرى").replace("نص", "نص جديد"), None)])
    assert run("--done", str(tmp_path / "done")) == 0 and "نص جديد" in next(iter(texts().values()))
    assert (tmp_path / "done").read_text() == url + "\n"
    capsys.readouterr()
    assert run("--check-updates") == 0 and "بلا تغيير منذ آخر جلب: **1**" in capsys.readouterr().out
    assert run("--done", str(tmp_path / "done")) == 0 and "(مكتمل سابقًا): **1**" in capsys.readouterr().out
    (tmp_path / "one.html").write_text(PAGE.replace("العمل", "الملف"))
    assert cli.main(["import", "--html", str(tmp_path / "one.html"), "--url", "https://nezams.com/b", "--out", out, "--failed", str(tmp_path / "failed")]) == 0
    assert len(texts()) == 2 and (tmp_path / "failed").read_text() == ""
    assert not [x for x in (tmp_path / "laws").iterdir() if x.name.startswith(("_import", "_settled"))]
    assert cli.main(["import", "--html", "x", "--out", out]) == cli.main(["import", "--discover", "--out", out, url]) == 2


def test_two_captures_of_a_page_are_one_document(spark):
    from sijill.plans.ingest import plan

    one = "<article><h1>نظام</h1><h3>المادة الأولى</h3><p>{0} أ</p><h3>المادة الثانية</h3><p>{0} ب</p></article>"
    rows = [("https://qanoonsa.com/%61", one.format("قديم"), "2020"), ("https://qanoonsa.com/a", one.format("جديد"), "2021"), ("https://qanoonsa.com/a#x", one.format("أقدم"), None)]
    pages = spark.createDataFrame(rows, "url string, html string, fetched_at string")
    links = spark.createDataFrame([(0, "https://qanoonsa.com/a")], "ord int, url string")
    made = plan(links, pages, spark.createDataFrame([], "url string, path string, text string"))
    assert [[a.text for a in r.articles] for r in made.documents.collect()] == [["جديد أ", "جديد ب"]]
    assert made.results.count() == made.merged.count() == 1
    arrow = made.documents._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")
    assert arrow <= 2  # one a source


def test_reclassify_moves_files(spark, tmp_path):
    from sijill import cli

    (tmp_path / "laws" / "x").mkdir(parents=True)
    (tmp_path / "laws" / "x" / "نظام.md").write_text("---\ntitle: نظام العمل\nsource: s\nsource_url: https://nezams.com/a\ndoc_type: x\ncategory: x\n---\n\n# نظام العمل\n")
    assert cli.main(["reclassify", "--out", str(tmp_path / "laws")]) == 0
    assert [(r.path, 'doc_type: "نظام"' in r.text) for r in files.read_corpus(spark, str(tmp_path / "laws")).collect()] == [("x/نظام العمل.md", True)]


def test_entry_without_the_training_data_subpackage(tmp_path):
    """queries() and oracle_sql() keep all others where the subpackage is gone, with the pipeline or without it."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "sijill"), tmp_path / "sijill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    said = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [q for q in e.queries() if q.startswith('op') or q == 'pipeline'])"
    for name in (None, "corpus_pipeline.py"):
        if name and os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
        found = subprocess.run([sys.executable, "-c", said], cwd=tmp_path, env={**os.environ, "PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.abspath(p) != root)}, capture_output=True, text=True, check=True)
        n, sql, left = found.stdout.strip().split(" ", 2)
        assert int(n) >= 49 and int(sql) >= 40 and left == "[]"
