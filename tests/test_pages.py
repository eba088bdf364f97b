"""Pages whose documents are known, and maps with all that is passed over."""

import gc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sijill.operators import parse
from sijill.plans import catalogue
from sijill.sources import html, sitemap

MAPS = [
    ("https://a.example/index.xml", "<sitemapindex><loc> https://a.example/post.xml </loc><loc>https://a.example/category.xml</loc><loc>https://a.example/nezam_update.xml</loc><loc>https://b.test/post.xml</loc><loc>https://a.example/gone.xml</loc></sitemapindex>"),
    ("https://a.example/post.xml", "<urlset><loc>https://a.example/p/2</loc><loc>https://A.example/p/%31?a=1&amp;b=2#x</loc><loc>https://c.test/p</loc><loc>https://a.example/p/2</loc></urlset>"),
    ("https://a.example/category.xml", "<urlset><loc>https://a.example/c</loc></urlset>"),
    ("https://a.example/nezam_update.xml", "<urlset><loc>https://a.example/u</loc></urlset>"),
]
HTML_TABLE = "<h1>t</h1><article><table><tr><th>أ</th><th>ب</th></tr><tr><td>a|b</table><p>x<table></table></article>"
HEADED = """<h1>Arabic Full Name: نظام</h1><nav><p>x</p></nav><div class="entry-content"><p>صدر بموجب: مرسوم.</p><h2>الباب الأول</h2><h3>الفصل الأول</h3><h3>المادة الأولى</h3><p>نص <b>أ</b></p><ul><li>ب<p>ج</p></li></ul>
<h2>الباب الثاني</h2><h3>المادة الثالثة</h3><h4>عنوان</h4><p>متروك</p><h3>المادة الرابعة مكرر</h3><p>نشر في عدد جريدة أم القرى رقم ١</p><p>صدر في: أمس</p><p>رئيس مجلس الوزراء</p></div>"""
LISTED = """<h1>نظام</h1><p class="heading-system-single">بطاقة</p><div><table><tr><td>الاعتماد :</td><td>مرسوم<br>م/1.</td></tr><tr><td>التعديلات</td><td>أ<br>ب</td></tr><tr><td>غير ذلك</td><td>x</td></tr></table></div><ul>
<li class="subject"><h4>المادة الأولى</h4><div class="content">نص<br>ثان</div></li><li class="subject"><h4>المادة التاسعة والسبعون مكرر</h4><div class="content">تم بموجب المرسوم الملكي رقم م/2 تعديل هذه المادة لتكون بالنص الآتي:«يعاقب»</div></li></ul>"""


def page(spark, html):
    return spark.createDataFrame([("u", html)], "url string, html string")


def test_map(spark):
    rows = sitemap.discover(spark.createDataFrame(MAPS, "url string, xml string"), MAPS[0][0], ("a.example",)).orderBy("ord").collect()
    assert [tuple(r) for r in rows] == [(1, "https://a.example/p/2"), (2, "https://a.example/p/1?a=1&b=2")]


def test_table(spark):
    assert parse.headed_documents(page(spark, HTML_TABLE), "s").first().body == "| أ | ب |\n| --- | --- |\n| a\\|b |  |\n\nx"


def test_headed(spark):
    d = parse.headed_documents(page(spark, HEADED), "s").first()
    assert [(a.number, a.number_int, a.is_bis, a.section, a.text) for a in d.articles] == [("الأولى", 1, False, "الباب الأول — الفصل الأول", "نص أ\n\nب ج"), ("الثالثة", 3, False, "الباب الثاني", ""), ("الرابعة مكرر", 4, True, "الباب الثاني", "")]
    assert (d.title, d.issued_by, d.issued_date, d.gazette_ref, d.is_decision, d.error) == ("نظام", "مرسوم", "أمس", "نشر في عدد جريدة أم القرى رقم ١", False, None)


def test_listed(spark):
    d = parse.listed_documents(page(spark, LISTED), "s").select("issued_by", "amendments", F.col("articles")).first()
    past = "تم بموجب المرسوم الملكي رقم م/2 تعديل هذه المادة لتكون بالنص الآتي:"
    assert (d.issued_by, d.amendments) == ("مرسوم؛ م/1", ["أ", "ب"])
    assert [(a.number, a.number_int, a.is_bis, a.text, a.amendment_history) for a in d.articles] == [("الأولى", 1, False, "نص\n\nثان", []), ("التاسعة والسبعون مكرر", 79, True, "«يعاقب»", [past])]


def test_pages_are_read_a_few_at_a_time(spark, monkeypatch):
    """Blocks go on before a batch of pages is through, pages keep their blocks, and no tree waits for the collector."""
    monkeypatch.setattr(html, "STEP", 5000)
    pages = [f"<h1>t{i}</h1><p>x{i}</p>" if i % 5 else None for i in range(40)]
    taken = []
    read = html.read_blocks
    monkeypatch.setattr(html, "read_blocks", lambda page: taken.append(page) or read(page))
    sizes, waiting = [], []
    for part in html._run(iter([pa.array(pages), pa.array(pages[:3])])):
        sizes.append(len(part))
        waiting.append(len(taken) - sum(sizes))
    assert sum(sizes) == 43 and max(sizes) <= 5 and max(waiting) == 0
    gc.collect()
    gc.disable()
    try:
        read("<div><p>a<b>b</b></p></div>" * 50)
        assert not [o for o in gc.get_objects() if isinstance(o, html.Node)]
    finally:
        gc.enable()
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").repartition(3)
    got = {r.i: [b.text for b in r.b] for r in df.select("i", html.blocks(F.col("html")).alias("b")).collect()}
    assert got == {i: [f"t{i}", f"x{i}"] if i % 5 else [] for i in range(40)}
    parse.headed_documents(df.selectExpr("string(i) AS url", "html"), "s").count()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 500


#: What a title or paragraph may end in when it is cut inside a character's name.
CUT = ["&quot", "&quo", "&lt", "&gt", "&amp", "&am", "&", "&quot; &lt;b&gt;", "&amp;quot", "&ampquot;", "&amp;quot;", "&quotx;", "&ltx", "?a=1&copy=2", "&lt&gt;"]


def cut_pages(spark, tmp_path):
    """Pages of texts that are cut inside a reference, and those of ``S_PAGE_BLOCKS`` in DuckDB."""
    duckdb = pytest.importorskip("duckdb")
    rows = [(i, f"https://x.test/{i}", f"<html><h1>a {x}</h1><article><p>b {x}<p>c {x} d</p></article></html>") for i, x in enumerate(CUT)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    return lambda name: duck.sql(catalogue.SQL[name]).fetchall()


def test_blocks_of_cut_references_equal_their_sql(spark, tmp_path):
    want = cut_pages(spark, tmp_path)("html_blocks")
    got = [tuple(r) for r in catalogue.QUERIES["html_blocks"](spark, str(tmp_path)).collect()]
    assert len(want) == 3 * len(CUT) and sorted(got) == sorted(want)
    assert html.read_blocks("<p>&nbsp;&eacute;&#233;&#xe9;&ltimes; &eacute</p>")[0]["text"] == "\xe9\xe9\xe9\u22c9 &eacute"


def test_prose_of_cut_references_equals_its_sql(spark, tmp_path):
    want = cut_pages(spark, tmp_path)("html_prose_body")
    got = [tuple(r) for r in catalogue.QUERIES["html_prose_body"](spark, str(tmp_path)).collect()]
    assert len(want) == len(CUT) and sorted(got, key=repr) == sorted(want, key=repr)
