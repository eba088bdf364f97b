"""Documents as Markdown files with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import present, quoted, strip
from .parse import SOURCES

# The note's wording and headings.
NOTE = (
    "نسخة غير رسمية مستخرجة آليًا من موقع %s. لا يُعتد بها كمصدر رسمي؛ للتحقق يُرجى الرجوع إلى جريدة أم القرى (uqn.gov.sa) "
    "وبوابة الأنظمة السعودية لدى هيئة الخبراء (laws.boe.gov.sa)."
)
ARTICLE, AMENDMENTS = "المادة ", "> **تعديلات المادة:**"
SCALARS = ("issued_by", "issued_date", "approval_date_hijri", "publish_date", "gazette_ref", "status", "category")
LISTS = ("attachments", "amendments", "also_available_from")


def note(source: Column) -> Column:
    site = source
    for s in SOURCES:
        site = F.when(source == s.name, s.site).otherwise(site)
    return F.format_string(NOTE, site)


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def header(docs: DataFrame) -> Column:
    """Lines of fields that are absent are null, and vanish in the join."""
    has = lambda c: c in docs.columns
    one = lambda c: _line(c, quoted(present(F.col(c)))) if has(c) else F.lit(None).cast("string")
    listed = lambda c: F.when(F.size(c) > 0, _line(c, F.concat(F.lit("["), F.array_join(F.transform(c, quoted), ", "), F.lit("]")))) if has(c) else F.lit(None).cast("string")
    lines = [F.lit("---"), _line("title", quoted(F.col("title"))), _line("source", F.col("source")), _line("source_url", quoted(F.col("url"))), one("doc_type"), *map(one, SCALARS), *map(listed, LISTS), one("etag"), one("last_modified")]
    lines += [_line("retrieved_at", present(F.col("retrieved_at").cast("string"))) if has("retrieved_at") else F.lit(None).cast("string"), _line("note", quoted(note(F.col("source")))), F.lit("---")]
    return F.concat_ws("\n", *lines)


def starts(sections: Column) -> Column:
    """Whether each section of a list differs from the last one before it; null and empty ones start nothing and are passed over."""

    def step(seen: Column, section: Column) -> Column:
        now, last = present(section), seen["last"]
        return F.struct(F.coalesce(now, last).alias("last"), F.array_append(seen["new"], now.isNotNull() & ~now.eqNullSafe(last)).alias("new"))

    none = F.struct(F.lit(None).cast("string").alias("last"), F.expr("cast(array() as array<boolean>)").alias("new"))
    return F.aggregate(sections, none, step)["new"]


def render(docs: DataFrame) -> DataFrame:
    """``docs`` with text. A section is headed where it differs from the last one before; articles then go a level down."""
    arts = F.col("articles")
    sectioned = F.exists(arts, lambda a: F.coalesce(a["section"], F.lit("")) != "")
    mark = F.when(sectioned, "### ").otherwise("## ")
    folded = starts(F.transform(arts, lambda a: a["section"]))

    def entry(a: Column, new: Column) -> Column:
        name = F.when(F.col("is_decision"), a["number"]).otherwise(F.concat(F.lit(ARTICLE), a["number"]))
        past = F.when(F.size(a["amendment_history"]) > 0, F.concat(F.lit(f"\n\n{AMENDMENTS}\n"), F.array_join(F.transform(a["amendment_history"], lambda x: F.concat(F.lit("> - "), x)), "\n"))).otherwise("")
        section = F.when(new, F.concat(F.lit("\n\n## "), a["section"])).otherwise("")
        return F.concat(section, F.lit("\n\n"), mark, name, F.lit("\n\n"), strip(F.coalesce(a["text"], F.lit(""))), past)

    prose = F.concat(F.lit("\n\n"), strip(F.col("body")))
    inner = F.when((F.size(arts) == 0) & present(F.col("body")).isNotNull(), prose).otherwise(F.array_join(F.zip_with(arts, folded, entry), ""))
    return docs.withColumn("text", F.concat(header(docs), F.lit("\n\n# "), F.col("title"), inner, F.lit("\n")))


def _mounted(root: str) -> str:
    """``root`` as a path of the operating system, which all executors must have in common; another store is refused."""
    scheme, _, rest = root.rpartition("://") if "://" in root else ("file", "", root.removeprefix("file:"))
    if scheme != "file":
        raise ValueError(f"{root}: files are written to a folder that all executors have mounted")
    return rest


def export(rendered: DataFrame, root: str) -> None:
    """Writes path and text as files below ``root``, each replaced in one step, by the tasks that hold them."""
    root = _mounted(root)

    def write(rows) -> None:
        import os

        for r in rows:
            at = os.path.join(root, r["path"])
            os.makedirs(os.path.dirname(at), exist_ok=True)
            with open(f"{at}.new", "w", encoding="utf-8") as f:
                f.write(r["text"])
            os.replace(f"{at}.new", at)

    rendered.select("path", "text").foreachPartition(write)


def remove(paths: DataFrame, root: str) -> None:
    """Removes the files ``path`` below ``root`` and the folders that this empties, by the tasks that hold them. A file that is gone already is no error."""
    root = _mounted(root)

    def drop(rows) -> None:
        import os

        for r in rows:
            at = os.path.join(root, r["path"])
            if os.path.exists(at):
                os.remove(at)
            prune(os.path.dirname(at), root)

    paths.select("path").foreachPartition(drop)


def prune(start: str, root: str) -> None:
    """Empty folders from ``start`` upward, never ``root`` or what is above it."""
    import os

    at, top = os.path.realpath(start), os.path.realpath(root)
    while at.startswith(top + os.sep):
        try:
            os.rmdir(at)
        except OSError:
            return
        at = os.path.dirname(at)
