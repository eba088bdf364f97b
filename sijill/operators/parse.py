"""Pages to documents. HTML is read once, as blocks; everything on them is declarative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ordinals import parse_label
from ..functions.text import SPACE, clean_line, let, present, squeeze, strip, strip_cms_label
from ..sources.html import HEADINGS, blocks
from ..sources.registry import Source
from ..sources.tables import bound_batches

# Clause names by rank, line patterns, labels of a details table.
CLAUSES = ("أولا", "ثانيا", "ثالثا", "رابعا", "خامسا", "سادسا", "سابعا", "ثامنا", "تاسعا", "عاشرا")
ARTICLE = rf"^المادة{SPACE}+(.+)$"
CLAUSE = rf"^({'|'.join(CLAUSES)})ً?$"
PART, CHAPTER = "الباب", "الفصل"
GAZETTE = rf"ن?ُ?شر{SPACE}+في{SPACE}+عدد{SPACE}+جريدة{SPACE}+[أا]م{SPACE}+القرى"
ISSUED_BY = rf"^صدر{SPACE}+بموجب{SPACE}*:?{SPACE}*(.+)$"
ISSUED_IN = rf"^صدر{SPACE}+في{SPACE}*:?{SPACE}*(.+)$"
SIGNER = rf"^(?:رئيس|نائب رئيس){SPACE}+مجلس{SPACE}+الوزراء$"
AMENDED = (
    rf"^(تم{SPACE}+(?:بموجب{SPACE}+(?:المرسوم{SPACE}+الملكي|قرار){SPACE}.*?(?:تعديل|إلغاء|إضافة)"
    rf"|(?:تعديل|إلغاء|إضافة){SPACE}+هذه{SPACE}+المادة{SPACE}+بموجب)"
    rf"[^:]*?(?:لتكون{SPACE}+بالنص{SPACE}+الآتي{SPACE}*:|$))"
)
DETAILS = {
    "approval_date_hijri": ["تاريخ النظام"],
    "issued_by": ["الاعتماد", "الإعتماد"],
    "publish_date": ["تاريخ النشر"],
    "status": ["النفاذ", "النفاد", "الحالة"],
    "category": ["التصنيف"],
    "attachments": ["الملحقات"],
    "amendments": ["التعديلات"],
}
SKIPPED = "English"
# Why a page gives no document.
NO_TITLE, NO_ITEMS = "لم يُعثر على عنوان الصفحة (h1)", "لم يُعثر على أي مادة في الصفحة (li.subject)"
NOTHING, UNKNOWN = "لم يُستخرج أي مادة أو بند أو متن من الصفحة", "مصدر غير معروف"
#: A link without a landed page, which the reference knows as a failed request.
NOT_LANDED = "لم تصل الصفحة"

ARTICLE_TYPE = "struct<number:string,text:string,number_int:bigint,is_bis:boolean,section:string,amendment_history:array<string>>"
#: Columns of a parsed document.
DOCUMENT = "url string, source string, title string, issued_by string, issued_date string, approval_date_hijri string, publish_date string, gazette_ref string, status string, category string, attachments array<string>, amendments array<string>, is_decision boolean, articles array<" + ARTICLE_TYPE + ">, body string, error string"


def markdown_table(rows: Column) -> Column:
    """The first row is the header; shorter rows are filled up; null without rows."""
    width = F.array_max(F.transform(rows, F.size))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    lines = F.transform(rows, line)
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.size(lines))), "\n"))


def markdown_prose(found: Column, skip: Column) -> Column:
    """Blocks of a page without articles as Markdown, without the texts in ``skip``."""
    prose = F.filter(found, lambda b: (b["kind"] == "block") & ((b["tag"] == "table") | (~b["in_list"] & ~b["in_table"] & (b["text"] != "") & ~F.array_contains(skip, b["text"]))))
    one = lambda b: F.when(b["tag"] == "table", F.coalesce(markdown_table(b["rows"]), F.lit(""))).when(b["tag"].isin(*HEADINGS), F.concat(F.lit("### "), b["text"])).when(b["tag"] == "li", F.concat(F.lit("- "), b["text"])).otherwise(b["text"])
    return F.array_join(F.filter(F.transform(prose, one), lambda x: x != ""), "\n\n")


def _read(pages: DataFrame) -> DataFrame:
    """url, found (blocks): one call of the tokenizer a page."""
    bound_batches(pages.sparkSession)
    return pages.select("url", blocks(F.col("html")).alias("found"))


def _title(found: Column) -> Column:
    return F.get(F.filter(found, lambda b: b["kind"] == "h1"), F.lit(0))["text"]


def _shaped(df: DataFrame) -> DataFrame:
    fields = [f.strip().split(" ", 1) for f in DOCUMENT.split(", ")]
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields))


def carried(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` (key, ord, kind, text) with the last part and the last chapter so far, a part's chapters ending with it."""
    order = W.partitionBy(key).orderBy("ord")
    of = lambda kind: F.when(F.col("kind") == kind, F.col("text"))
    rows = rows.withColumns({"part_no": F.count_if(F.col("kind") == "part").over(order), "part": F.last(of("part"), True).over(order)})
    return rows.withColumn("chapter", F.last(of("chapter"), True).over(W.partitionBy(key, "part_no").orderBy("ord")))


def headed_documents(pages: DataFrame, source: str) -> DataFrame:
    """Pages whose articles are headings followed by paragraphs; url is unique.

    A heading starts a segment (a running count), its kind is carried over the segment,
    and parts and chapters are carried forward to the articles after them: windows over
    one page. A page's lines then meet in one row, beside its blocks, which travel with a
    line of their own, so that a page is read once and nothing is joined. All windows and
    the one aggregate share a partitioning by URL.
    """
    none = F.lit(None).cast("string")
    lines = F.filter(F.transform("found", lambda b, i: F.struct(i.alias("ord"), b.alias("b"))), lambda x: (x["b"]["kind"] == "block") & (x["b"]["tag"] != "table") & ~x["b"]["in_list"])
    lines = F.transform(lines, lambda x: F.struct(x["ord"].alias("ord"), x["b"]["tag"].alias("tag"), strip_cms_label(x["b"]["text"]).alias("text"), F.when(F.lit(False), F.col("found")).alias("page")))
    first = F.struct(F.lit(-1).alias("ord"), none.alias("tag"), none.alias("text"), F.col("found").alias("page"))
    rows = _read(pages).select("url", F.explode(F.concat(F.array(first), lines)).alias("line")).select("url", "line.*").where("page is not null or text <> ''")
    order = W.partitionBy("url").orderBy("ord")
    t, heading = F.col("text"), F.coalesce(F.col("tag").isin(*HEADINGS), F.lit(False))
    kind = (
        F.when(heading & t.rlike(ARTICLE), "article").when(heading & t.rlike(CLAUSE), "clause").when(heading & t.startswith(PART), "part").when(heading & t.startswith(CHAPTER), "chapter").when(heading, "other")
        .when(t.rlike(GAZETTE), "gazette").when(t.rlike(ISSUED_IN), "issued").when(t.rlike(SIGNER), "signer").when(t.isNotNull(), "text")
    )
    rows = rows.withColumns({"heading": heading, "kind": kind})
    rows = carried(rows.withColumn("segment", F.sum(F.col("heading").cast("int")).over(order)), "url")
    rows = rows.withColumn("of", F.first(F.when(F.col("heading"), F.col("kind")), True).over(W.partitionBy("url", "segment")))
    line = F.when(t.isNotNull(), F.struct("ord", "kind", "heading", "segment", "of", F.concat_ws(" — ", "part", "chapter").alias("section"), "text"))
    whole = rows.groupBy("url").agg(F.array_sort(F.collect_list(line)).alias("lines"), F.first("page", ignorenulls=True).alias("found"))

    def texts(condition) -> Column:
        return F.transform(F.filter("lines", condition), lambda x: x["text"])

    def listed(of: str, pattern: str) -> Column:
        def entry(h: Column) -> Column:
            own = F.array_join(texts(lambda x: (x["segment"] == h["segment"]) & (x["kind"] == "text")), "\n\n")
            number = strip(F.regexp_extract(h["text"], pattern, 1))
            parsed = parse_label(number) if of == "article" else F.lit(None).cast("struct<number:bigint,is_bis:boolean>")
            section = present(h["section"]) if of == "article" else none
            return let(parsed, lambda p: F.struct(number.alias("number"), own.alias("text"), p["number"].alias("number_int"), F.coalesce(p["is_bis"], F.lit(False)).alias("is_bis"), section.alias("section"), F.expr("cast(array() as array<string>)").alias("amendment_history")))

        return F.transform(F.filter("lines", lambda x: x["heading"] & (x["kind"] == of)), entry)

    last = lambda kind: F.try_element_at(texts(lambda x: x["kind"] == kind), F.lit(-1))
    intro = lambda x: (x["kind"] == "text") & ~F.coalesce(x["of"].isin("article", "clause"), F.lit(False))
    facts = whole.select("url", "found", listed("article", ARTICLE).alias("arts"), listed("clause", CLAUSE).alias("clauses"), last("gazette").alias("gazette_ref"), strip(F.regexp_extract(last("issued"), ISSUED_IN, 1)).alias("issued_date"), texts(lambda x: intro(x) & x["text"].rlike(ISSUED_BY)).alias("issuers"))
    chosen = F.when(F.size("arts") > 0, F.col("arts")).otherwise(F.col("clauses"))
    skip = F.concat(F.array(F.lit(SKIPPED)), "issuers", F.when(F.col("gazette_ref").isNotNull(), F.array("gazette_ref")).otherwise(F.expr("cast(array() as array<string>)")))
    title = strip_cms_label(_title(F.col("found")))
    body = F.when(F.size(chosen) == 0, present(markdown_prose(F.col("found"), skip)))
    return _shaped(facts.select(
        "url", F.lit(source).alias("source"), title.alias("title"), "gazette_ref", "issued_date",
        F.regexp_replace(strip(F.regexp_extract(F.get("issuers", F.lit(0)), ISSUED_BY, 1)), r"\.+\z", "").alias("issued_by"),
        ((F.size("arts") == 0) & (F.size("clauses") > 0)).alias("is_decision"), chosen.alias("articles"), body.alias("body"),
        F.when(title.isNull(), NO_TITLE).when((F.size(chosen) == 0) & body.isNull(), NOTHING).alias("error"),
    ))


def _amendments(lines: Column) -> tuple[Column, Column]:
    """Lines of an article as (its text, its amendments). What follows an amendment's clause on one line is text."""
    past = F.filter(F.transform(lines, lambda x: strip(F.regexp_extract(x, AMENDED, 1))), lambda x: x != "")
    text = F.filter(F.transform(lines, lambda x: F.when(x.rlike(AMENDED), strip(F.regexp_replace(x, AMENDED, ""))).otherwise(x)), lambda x: x != "")
    return F.array_join(text, "\n\n"), past


def listed_documents(pages: DataFrame, source: str) -> DataFrame:
    """Pages whose articles are list items beside a table of details: no row leaves its page, so nothing is shuffled."""
    read = _read(pages)
    found = F.col("found")
    items = F.filter(found, lambda b: b["kind"] == "item")

    def article(b: Column) -> Column:
        label = squeeze(b["label"])
        number = F.when(label.rlike(ARTICLE), strip(F.regexp_extract(label, ARTICLE, 1))).otherwise(label)
        text, past = _amendments(b["lines"])
        return let(parse_label(number), lambda p: F.struct(number.alias("number"), text.alias("text"), p["number"].alias("number_int"), p["is_bis"].alias("is_bis"), F.lit(None).cast("string").alias("section"), past.alias("amendment_history")))

    details = F.transform(F.filter(found, lambda b: b["kind"] == "detail"), lambda b: F.struct(clean_line(b["label"]).alias("label"), F.filter(F.transform(b["lines"], clean_line), lambda x: x != "").alias("lines")))
    value = lambda labels: F.get(F.filter(details, lambda d: d["label"].isin(*labels) & (F.size(d["lines"]) > 0)), F.lit(0))["lines"]
    scalars = {k: F.regexp_replace(F.array_join(value(v), "؛ "), r"\.+\z", "") for k, v in DETAILS.items() if k not in ("attachments", "amendments")}
    title, articles = _title(found), F.transform(items, article)
    return _shaped(read.select(
        "url", F.lit(source).alias("source"), title.alias("title"), *(c.alias(k) for k, c in scalars.items()),
        *(F.coalesce(value(DETAILS[k]), F.expr("cast(array() as array<string>)")).alias(k) for k in ("attachments", "amendments")),
        F.lit(False).alias("is_decision"), articles.alias("articles"),
        F.when(title.isNull(), NO_TITLE).when(F.size(items) == 0, NO_ITEMS).alias("error"),
    ))


# The two sites, their hosts and maps, and how they are named to readers.
SOURCES = (
    Source("nezams", ("nezams.com",), "https://nezams.com/sitemap_index.xml", "نظام (nezams.com)", lambda p: listed_documents(p, "nezams")),
    Source("qanoonsa", ("qanoonsa.com",), "https://qanoonsa.com/wp-sitemap.xml", "قانون (qanoonsa.com)", lambda p: headed_documents(p, "qanoonsa")),
)


def parse(pages: DataFrame) -> DataFrame:
    """pages: url, source, html. Each source's pages by its parser; rows of an unknown source, and links without a page (html is null), as errors of their own."""
    out = None
    for s in SOURCES:
        own = s.parse(pages.where((F.col("source") == s.name) & F.col("html").isNotNull()))
        out = own if out is None else out.unionByName(own)
    known = F.coalesce(F.col("source").isin(*(s.name for s in SOURCES)), F.lit(False))
    missing = pages.where(known & F.col("html").isNull())
    out = out.unionByName(_shaped(missing.select("url", "source", F.lit(NOT_LANDED).alias("error"))))
    unknown = pages.where(~known)
    return out.unionByName(_shaped(unknown.select("url", "source", F.lit(UNKNOWN).alias("error"))))
