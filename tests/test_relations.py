"""Robots rules, registries, sibling sets, headers and the index as relations, each against a plain version."""

import os
import random
from urllib.robotparser import RobotFileParser

import pytest

from sijill.operators import corpus, quality, report
from sijill.sources import files, headers, registry, robots


def test_robots_against_the_standard_parser(spark):
    rng = random.Random(4)
    names, paths = ["*", "*", "*", "sijill", "sij", "Other", "other\nUser-agent: SIJILL", "x\n\nUser-agent: *"], ["/", "/a", "/a/b", "/%61/b", "/ö", "", "/a?x=1", "/b c", "/a#k"]
    sites, urls = [], []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(1, 4)):
            lines += [f"{rng.choice(['User-agent', 'USER-AGENT '])}: {rng.choice(names)}", *(rng.choice([*[f"{rng.choice(['Allow', 'Disallow', 'disallow'])}: {rng.choice(paths)} # c"] * 7, "Crawl-delay: 1", "", "# x", "junk", "Sitemap: /s"]) for _ in range(rng.randint(0, 6)))]
        sites.append((f"h{i}.test", rng.choice([200, 200, 200, 404]), rng.choice(["\n", "\r\n"]).join("\n".join(lines).split("\n"))))
        urls += [f"https://H{i}.test{p}" for p in ["", "/", "/a", "/a/b/c", "/%61/b", "/%C3%B6x", "/a?x=1&y", "/b%20c", "/z"]]
    urls.append("https://nowhere.test/a")
    want = {}
    for u in urls:
        host = u.split("/")[2].lower()
        found = [t for h, s, t in sites if h == host and s == 200]
        parser = RobotFileParser()
        parser.parse(found[0].splitlines() if found else [])
        want[u] = not found or parser.can_fetch("sijill", u.replace(u.split("/")[2], host))
    rules = robots.rules(spark.createDataFrame(sites, "host string, status int, text string"))
    rows = robots.judge(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()
    got = {r.url: r.allowed for r in rows}
    assert {u: (got[u], want[u]) for u in urls if got[u] != want[u]} == {} and 20 < sum(want.values()) < len(urls) - 20


def test_longest_rule(spark):
    rules = robots.rules(spark.createDataFrame([("h", 200, "User-agent: *\nDisallow: /a\nAllow: /a/b\nDisallow: /a/b/c")], "host string, status int, text string"))
    urls = spark.createDataFrame([(f"https://h{p}",) for p in ("/a", "/a/b", "/a/b/c")], "url string")
    assert [r.allowed for r in robots.judge(urls, rules, longest=True).orderBy("url").collect()] == [False, True, False]
    assert [r.allowed for r in robots.judge(urls, rules).orderBy("url").collect()] == [False, False, False]


def test_registry_by_suffix(spark):
    known = spark.createDataFrame([(2, "late", "b.test"), (1, "first", "B.test"), (3, "sub", "x.b.test"), (0, "other", "est")], "rank int, name string, host string")
    urls = spark.createDataFrame([("https://b.test/1",), ("https://a.x.b.test/",), ("https://xb.test/",), ("no url",), (None,)], "url string")
    out = registry.detect_by(urls, known)
    assert {r.url: r.source for r in out.collect()} == {"https://b.test/1": "first", "https://a.x.b.test/": "first", "https://xb.test/": None, "no url": None, None: None}
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_sibling_sets_say_what_the_lists_say(spark):
    rng = random.Random(2)
    urls = [f"https://x/{i}" for i in range(9)] + [None, ""]
    rows = []
    for i in range(150):
        rows.append((str(i), rng.choice(["A", "B", "C", f"t{i % 40}", None]), rng.choice(urls), rng.choice([None, [], sorted(rng.sample(urls[:9], rng.randint(1, 8)))])))
    for t, members in (("D", urls[:4]), ("E", urls[:3])):
        rows += [(f"{t}{j}", t, u, sorted(x for x in members if x != u)[:: 1 if t == "D" else -1]) for j, u in enumerate(members)]
    df = spark.createDataFrame(rows, "path string, title string, source_url string, also_available_from array<string>")
    lists = {r.path: (len(r.siblings), r.touched) for r in corpus.siblings(df).collect()}
    got = {r.path: (r.n_siblings, r.touched) for r in corpus.sibling_sets(df).collect()}
    assert got == lists and {t for _, t in got.values()} == {True, False}


def test_a_title_of_many_files(spark):
    """100,000 files of one title: no row of the plan holds more than its own file's list."""
    many = spark.range(100_000).selectExpr("concat('k/', id, '.md') AS path", "'T' AS title", "concat('https://x/', id) AS source_url", "CAST(array() AS array<string>) AS also_available_from")
    out = corpus.sibling_sets(many)
    row = out.selectExpr("count(*) AS n", "min(n_siblings) AS least", "count_if(touched) AS touched").first()
    assert (row.n, row.least, row.touched) == (100_000, 99_999, 100_000)
    assert "collect_" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_headers_read_little(spark, tmp_path):
    long = "---\ntitle: \"T\"\nsource_url: \"https://x/1\"\nalso_available_from: [\"a, b\"]\n---\n\n" + "نص طويل " * 50_000
    texts = {"k/a.md": long, "k/no.md": "text\n---\n" * 9000, "k/open.md": "---\n" + "".join(f"f{i}: 1\n" for i in range(300)), "d.md": "---\r\ntitle: D\r\n---\r\n", "k/e.md": "", "k/short.md": "---\ntitle: S", "x.txt": "---\n---\n"}
    for p, t in texts.items():
        os.makedirs(tmp_path / "c" / os.path.dirname(p), exist_ok=True)
        (tmp_path / "c" / p).write_bytes(t.encode())
    (tmp_path / "c" / "k" / "bad.md").write_bytes(b"---\n\xff\xfe\n---\n")
    (tmp_path / "c" / "gone.md").symlink_to(tmp_path / "nowhere")
    rows = {r.path: r for r in headers.read_headers(spark, str(tmp_path / "c")).collect()}
    assert set(rows) >= {*texts} - {"x.txt"} | {"k/bad.md"}
    assert rows["k/a.md"].header == long[4 : long.index("---", 4)] and rows["k/no.md"].header == rows["k/e.md"].header == ""
    assert rows["k/open.md"].header == "".join(f"f{i}: 1\n" for i in range(100)) and rows["d.md"].header == "title: D\n" and rows["k/short.md"].header == "title: S"
    assert rows["k/bad.md"].header == "" and rows["k/bad.md"].error
    assert sum(r.bytes_read for r in rows.values()) < 0.02 * sum(len(t.encode()) for t in texts.values())
    whole = {r.path: (r.title, r.source_url, r.also_available_from) for r in files.fields(files.read_corpus(spark, str(tmp_path / "c"))).where("path = 'k/a.md'").collect()}
    assert whole == {r.path: (r.title, r.source_url, r.also_available_from) for r in headers.fields(headers.read_headers(spark, str(tmp_path / "c"))).where("path = 'k/a.md'").collect()}
    assert headers.read_headers(spark, str(tmp_path / "none")).count() == 0


def test_index_by_ranges(spark, tmp_path):
    import json

    rows = [(f"f{i % 7}/{i}.md", json.dumps({"path": f"f{i % 7}/{i}.md", "title": "عنوان"}, ensure_ascii=False)) for i in range(300)]
    made = spark.createDataFrame(rows, "path string, entry string")
    report.write_index(made.repartition(5), str(tmp_path / "i.json"))
    text = (tmp_path / "i.json").read_text(encoding="utf-8")
    want = [json.loads(e) for _, e in sorted(rows, key=lambda r: r[0].split("/"))]
    assert text == json.dumps(want, ensure_ascii=False, indent=2) + "\n"
    root = str(tmp_path / "ranges")
    report.write_ranges(made, root)
    assert report.changes(made, root).isEmpty()
    new = spark.createDataFrame([(p, e.replace("عنوان", "آخر") if p == "f3/3.md" else e) for p, e in rows if p != "f2/2.md"] + [("new/x.md", "{}")], "path string, entry string")
    found = report.changes(new, root)
    assert sorted((r.change, r.path) for r in found.collect()) == [("added", "f3/3.md"), ("added", "new/x.md"), ("removed", "f2/2.md"), ("removed", "f3/3.md")]
    read = found.where("change = 'removed'").inputFiles()
    assert not any("folder=f5" in f for f in report.changes(new, root)._jdf.queryExecution().executedPlan().toString().split() if "PartitionFilters" in f) and read
    report.write_index(made.limit(0), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []


@pytest.mark.parametrize("text", ["---\ntitle: \"a\"\n---\nbody", "---\ntitle: a\n---", "no header\ntitle: x", "", "---\n---\nx\n---\ny", "---\na\n---x\n---\nz"])
def test_a_file_is_cut_as_its_parts_say(spark, text):
    from pyspark.sql import functions as F

    from sijill.functions.frontmatter import body, cut, header

    t = F.lit(text)
    row = spark.range(1).select(cut(t).alias("c"), header(t).alias("h"), body(t).alias("b")).first()
    assert (row.c.header, row.c.body) == (row.h, row.b)
    assert quality.lint(spark.createDataFrame([("k/a.md", text)], "path string, text string")).count() >= 0


def test_files_of_a_hot_title_are_dealt(spark, monkeypatch):
    """Lists of a title's files, over several tasks: each file once, with all other URLs in order, repeated ones once."""
    monkeypatch.setattr(corpus, "DEAL", 7)
    rows = [(f"p{i}", "hot" if i < 50 else f"own{i}", None if i in (3, 4) else f"https://x/{i // 2 * 2 if i < 10 else i}", None) for i in range(60)]
    df = spark.createDataFrame(rows, "path string, title string, source_url string, also_available_from array<string>")
    out = corpus.siblings(df)
    assert "array_except" not in out._jdf.queryExecution().optimizedPlan().toString()  # lists are sorted and compared once a title, not once a file
    got = {r.path: (r.siblings, r.touched) for r in out.collect()}
    urls = {f"p{i}": u for i, (_, _, u, _) in enumerate(rows)}
    every = {urls[f"p{i}"] for i in range(50)} - {None}
    assert got == {f"p{i}": (sorted(every - {urls[f"p{i}"]}), True) for i in range(50)}
    assert out.count() == 50
