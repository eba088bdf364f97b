"""Data-quality rules as an issues table: key, severity, rule, message, in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.frontmatter import cut, field_in
from ..functions.ordinals import label_pattern, parse_label
from ..functions.paths import UNCATEGORIZED, file_name
from ..functions.text import SPACE, present, strip, unquoted
from ..sources.files import README
from .parse import CLAUSES

# What page controls leave in texts, and titles that are spreadsheet errors.
NOISE = ("مشاركة المادة", "رابط المادة", "النص والرابط", "حجم الخط", "عدد القراءات", "جميع الحقوق محفوظة")
BROKEN_TITLE = r"^#(REF|N/A|VALUE|DIV/0|NAME|NULL|NUM)[!?]?$"
HEADING = rf"(?md)^#{{2,3}}{SPACE}+المادة{SPACE}+(.+?){SPACE}*$"
REQUIRED = ("title", "source_url")
PREVIEW, LONG_PARAGRAPH = 5, 25


def first_match(text: Column, literals) -> Column:
    """The first of the literals that a text contains, else null."""
    out = F.lit(None).cast("string")
    for x in reversed(list(literals)):
        out = F.when(F.contains(text, F.lit(x)), x).otherwise(out)
    return out


def broken_title(title: Column) -> Column:
    return F.coalesce(strip(title).rlike(BROKEN_TITLE), F.lit(False))


def sequence_gaps(rows: DataFrame, key: str, ord: str, number: str, bis: str) -> DataFrame:
    """``rows`` with prev (the last known number before, repeats left out) and gap: '', 'unknown', 'repeat' or 'gap'."""
    before = W.partitionBy(key).orderBy(ord).rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumn("prev", F.last(F.when(~F.col(bis), F.col(number)), True).over(before))
    n, prev = F.col(number), F.col("prev")
    return out.withColumn("gap", F.when(n.isNull(), "unknown").when(F.col(bis) & (n != prev), "repeat").when(~F.col(bis) & (n != prev + 1), "gap").otherwise(""))


def sequence_breaks(rows: DataFrame, key: str, ord: str, number: str, bis: str) -> DataFrame:
    """Rows that don't follow on; unknown and repeated numbers are passed over."""
    known = rows.where(F.col(number).isNotNull() & ~F.col(bis))
    return known.withColumn("prev", F.lag(number).over(W.partitionBy(key).orderBy(ord))).where(F.col(number) != F.col("prev") + 1)


def clause_breaks(rows: DataFrame, key: str, ord: str, name: str, names=CLAUSES) -> DataFrame:
    """Clauses whose rank isn't the next, with the name expected; unranked names are passed over."""
    ranks = F.create_map(*(x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))))
    ranked = rows.withColumn("rank", F.try_element_at(ranks, F.trim(F.col(name)))).where("rank is not null")
    out = ranked.withColumn("prev", F.lag("rank", 1, -1).over(W.partitionBy(key).orderBy(ord))).where("rank <> prev + 1")
    return out.withColumn("expected", F.coalesce(F.get(F.array(*map(F.lit, names)), F.col("prev") + 1), F.lit("?")))


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, rf"\n{SPACE}*\n"), strip), lambda p: p != "")


def repeated_paragraph(parts: Column) -> Column:
    """Whether two long neighbours are equal. The pair is found by zipping the array with itself, one place on."""
    pairs = F.zip_with(parts, F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.coalesce(F.exists(pairs, lambda p: (p["a"] == p["b"]) & (F.length(p["a"]) > LONG_PARAGRAPH) & ~p["a"].rlike(r"^[#|>\-]")), F.lit(False))


def preview(labels: Column, most: int = PREVIEW) -> Column:
    """The first labels, and how many more."""
    more = F.when(F.size(labels) > most, F.concat(F.lit(" (+"), (F.size(labels) - most).cast("string"), F.lit(")"))).otherwise("")
    return F.concat(F.array_join(F.slice(labels, 1, most), "، "), more)


def _issue(severity: str, rule: str, ord: int, message: Column) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.lit(ord).alias("ord"), message.alias("message"))


def issues(documents: DataFrame) -> DataFrame:
    """url, rule, ord, message: warnings of parsed documents (url, title, is_decision, articles, body)."""
    docs = documents.select("url", "title", "is_decision", "articles", "body")
    arts = docs.select("url", "is_decision", F.posexplode("articles").alias("ord", "a")).select("url", "is_decision", "ord", "a.*").withColumn("is_bis", F.coalesce("is_bis", F.lit(False)))
    text = lambda *parts: F.concat(*(F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts))
    gaps = sequence_gaps(arts.where(~F.col("is_decision")), "url", "ord", "number_int", "is_bis").where("gap <> ''")
    gap_said = (
        F.when(F.col("gap") == "unknown", text("تعذر تحويل رقم المادة إلى عدد: «", F.col("number"), "»"))
        .when(F.col("gap") == "repeat", text("مادة مكررة برقم ", F.col("number_int"), " لا تلي أصلها (السابقة: ", F.col("prev"), ")"))
        .otherwise(text("خلل في التسلسل: بعد المادة ", F.col("prev"), " جاءت المادة ", F.col("number_int")))
    )
    clauses = clause_breaks(arts.where("is_decision"), "url", "ord", "number")
    n = F.size("articles")
    title, prose = F.col("title"), F.coalesce("body", F.lit(""))
    empty = F.transform(F.filter("articles", lambda a: strip(a["text"]) == ""), lambda a: a["number"])
    flat = F.array(
        F.when(broken_title(title), _issue("warning", "V3", 0, text("عنوان يشبه خطأ صيغة جدول بيانات: «", title, "»"))),
        F.when((n == 0) & (strip(prose) == ""), _issue("warning", "V4", 0, F.lit("الوثيقة بلا محتوى: لا مواد ولا متن"))),
        F.when((n == 0) & (F.regexp_count(prose, F.lit(label_pattern())) >= 2), _issue("warning", "V5", 0, F.lit("وثيقة نثرية تحوي عدة نصوص «المادة …»؛ يُحتمل فشل تقطيع المواد (تغيّر بنية المصدر؟)"))),
        F.when(F.size(empty) > 0, _issue("warning", "V7", 0, text("مواد بلا متن: ", preview(empty)))),
    )
    single = docs.select("url", F.explode(F.filter(flat, lambda x: x.isNotNull())).alias("i")).select("url", "i.*")
    bodies = docs.select("url", F.posexplode(F.concat(F.transform("articles", lambda a: a["text"]), F.when(prose != "", F.array("body")).otherwise(F.expr("cast(array() as array<string>)")))).alias("ord", "text"))
    noise = first_match(F.col("text"), NOISE)
    out = gaps.select("url", F.lit("V1").alias("rule"), "ord", gap_said.alias("message"))
    out = out.unionByName(clauses.select("url", F.lit("V2").alias("rule"), "ord", text("خلل تسلسل البنود: «", F.col("number"), "» بلا ما قبله (المتوقع «", F.col("expected"), "»)").alias("message")))
    out = out.unionByName(single.select("url", "rule", "ord", "message"))
    return out.unionByName(bodies.where(noise.isNotNull()).select("url", F.lit("V6").alias("rule"), "ord", text("بقايا ضجيج واجهة في المتن: «", noise, "»").alias("message"))).withColumn("severity", F.lit("warning"))


def category_issue(category: Column, folder: Column) -> Column:
    """Disagreement of a category with its folder; null if they agree."""
    has = F.coalesce(category, F.lit("")) != ""
    return (
        F.when((folder == UNCATEGORIZED) & has, F.lit("مصنَّف لكنه في غير-مصنف"))
        .when(has & (folder != file_name(category)), F.concat(F.lit("التصنيف «"), category, F.lit("» لا يطابق المجلد «"), folder, F.lit("»")))
        .when(~has & (folder != UNCATEGORIZED), F.lit("بلا حقل category رغم وجوده في مجلد مصنَّف"))
    )


def lint(corpus: DataFrame) -> DataFrame:
    """path, severity, rule, ord, message of corpus files (path, text). A file is cut into header and body once; fields are looked up in the header alone, and in all of a file without one."""
    names = F.split("path", "/")
    files = corpus.where(F.element_at(names, -1) != README).select("path", cut(F.col("text")).alias("cut"), F.coalesce(F.try_element_at(names, F.lit(-2)), F.lit("")).alias("folder"))
    files = files.select("path", F.coalesce("cut.header", "cut.body").alias("head"), F.col("cut.body").alias("body"), "folder")
    fields = [field_in(F.col("head"), f).alias(f"_{f}") for f in (*REQUIRED, "category")]
    files = files.select("path", "body", "folder", *fields, first_match(F.col("body"), NOISE).alias("noise"))
    title, noise = F.coalesce(unquoted(F.col("_title")), F.lit("")), F.col("noise")
    odd = category_issue(unquoted(F.col("_category")), F.col("folder"))
    found = [F.when(F.col(f"_{f}").isNull(), _issue("error", "V8", i, F.lit(f"حقل إلزامي ناقص: {f}"))) for i, f in enumerate(REQUIRED)]
    found += [
        F.when(broken_title(title), _issue("error", "V3", 0, F.concat(F.lit("عنوان معطوب: «"), title, F.lit("»")))),
        F.when(noise.isNotNull(), _issue("error", "V6", 0, F.concat(F.lit("ضجيج واجهة في المتن: «"), noise, F.lit("»")))),
        F.when(repeated_paragraph(paragraphs(F.col("body"))), _issue("error", "V9", 0, F.lit("فقرات متتالية مكرّرة (أثر ازدواج استخراج)"))),
        F.when(odd.isNotNull(), _issue("warning", "V10", 0, odd)),
    ]
    flat = files.select("path", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i")).select("path", "i.*")
    labels = files.select("path", F.posexplode(F.regexp_extract_all("body", F.lit(HEADING), F.lit(1))).alias("ord", "label")).select("path", "ord", parse_label(F.col("label")).alias("p"))
    breaks = sequence_breaks(labels.select("path", "ord", "p.number", "p.is_bis"), "path", "ord", "number", "is_bis")
    said = F.concat(F.lit("خلل تسلسل: بعد "), F.col("prev").cast("string"), F.lit(" جاءت "), F.col("number").cast("string"))
    return flat.unionByName(breaks.select("path", F.lit("warning").alias("severity"), F.lit("V11").alias("rule"), "ord", said.alias("message")))


def lint_summary(found: DataFrame, corpus: DataFrame, strict: bool = False) -> DataFrame:
    """One row: files, errors, warnings, files_with_errors, failed."""
    files = corpus.where(~F.col("path").endswith(README)).agg(F.count("*").alias("files"))
    counts = found.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.count_distinct(F.when(F.col("severity") == "error", F.col("path"))).alias("files_with_errors"))
    failed = (F.col("errors") > 0) | (F.lit(strict) & (F.col("warnings") > 0))
    return files.join(counts, how="cross").withColumn("failed", failed)  # one row each


def canary(documents: DataFrame) -> DataFrame:
    """url, reason of sample pages that should have articles and have none: the site's form has changed."""
    return documents.where(F.col("error").isNotNull() | (F.size("articles") == 0)).select("url", F.coalesce(present(F.col("error")), F.lit("prose instead of articles")).alias("reason"))
