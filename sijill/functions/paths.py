"""File names and places of documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, squeeze, strip

# The folder without category, the name without title, the limit of a name in UTF-8.
UNCATEGORIZED, UNTITLED, NAME_BYTES = "غير-مصنف", "بدون-عنوان", 200


def cut_bytes(text: Column, most: Column | int) -> Column:
    """At most so many UTF-8 bytes, without a broken character: a character has four bytes at most, so one of four cuts is valid."""
    size = most if isinstance(most, Column) else F.lit(most)

    def cut(whole: Column) -> Column:
        raw = F.encode(whole, "UTF-8")
        cuts = [F.try_validate_utf8(F.substring(raw, F.lit(1), F.greatest(size - k, F.lit(0))).cast("string")) for k in range(4)]
        return F.when(F.octet_length(whole) <= size, whole).otherwise(F.coalesce(*cuts))

    return let(text, cut)


def file_name(text: Column, most: Column | int = NAME_BYTES) -> Column:
    name = squeeze(F.regexp_replace(text, r'[/\\:*?"<>|]', " "))
    return let(strip(cut_bytes(name, most)), lambda cut: F.when(F.coalesce(cut.rlike(r"^\.*$"), F.lit(True)), UNTITLED).otherwise(cut))


def folder(category: Column) -> Column:
    return F.when(F.coalesce(category, F.lit("")) == "", UNCATEGORIZED).otherwise(file_name(category))


def document_path(title: Column, category: Column, root: str = "") -> Column:
    return F.concat(F.lit(f"{root.rstrip('/')}/" if root else ""), folder(category), F.lit("/"), file_name(F.coalesce(title, F.lit(""))), F.lit(".md"))
