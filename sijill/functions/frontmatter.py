"""Fields of a Markdown file's header, and their change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, present, quoted, unquoted

HEADER = r"(?s)\A---\n(.*?\n)---(?:\n|\z)"


def header(text: Column) -> Column:
    """The lines between the marks, or null without them."""
    return F.when(text.rlike(HEADER), F.regexp_extract(text, HEADER, 1))


def body(text: Column) -> Column:
    return F.when(text.rlike(r"(?s)\A---\n.*?\n---\n"), F.regexp_extract(text, r"(?s)\A---\n.*?\n---\n(.*)", 1)).otherwise(text)


def cut(text: Column) -> Column:
    """(header, body) of a text, which is matched once: :func:`header` and :func:`body` in one."""

    def parts(whole: Column) -> Column:
        own = F.when(whole != "", F.regexp_replace(F.substr(whole, F.lit(5)), r"---\n?\z", ""))
        return F.struct(own.alias("header"), F.when(F.endswith(whole, F.lit("---\n")), F.substr(text, F.char_length(whole) + 1)).otherwise(text).alias("body"))

    return let(F.regexp_extract(text, HEADER, 0), parts)


def field_in(head: Column, field: str) -> Column:
    """The first value of a field in a header, as written; null if empty."""
    return present(F.regexp_extract(head, rf'(?md)^{field}:[ \t]*"?(.*?)"?[ \t]*$', 1))


def read_field(text: Column, field: str) -> Column:
    """The first value of a field in the header (in all of a text without one), as written; null if empty."""
    return field_in(F.coalesce(header(text), text), field)


def read_text(text: Column, field: str) -> Column:
    """The value with its escapes resolved."""
    return unquoted(read_field(text, field))


def read_list(text: Column, field: str) -> Column:
    """A list field as an array. Values are read as JSON, so commas in them are kept."""
    return list_in(F.coalesce(header(text), text), field)


def list_in(head: Column, field: str) -> Column:
    raw = F.regexp_extract(head, rf"(?md)^{field}:[ \t]*(\[.*\])[ \t]*$", 1)
    return F.coalesce(F.from_json(F.nullif(raw, F.lit("")), "array<string>"), F.expr("cast(array() as array<string>)"))


def _set_line(text: Column, field: str, line: Column) -> Column:
    """A header line replaced, added at the end, or dropped for a null line; texts without header stay."""
    lines = F.filter(F.split(header(text), "\n"), lambda x: x != "")
    mine = F.array_position(F.transform(lines, lambda x: x.startswith(f"{field}:")), True).cast("int")
    before, after = F.slice(lines, F.lit(1), F.greatest(mine - 1, F.lit(0))), F.slice(lines, mine + 1, F.size(lines))
    new = F.when(line.isNull(), F.expr("cast(array() as array<string>)")).otherwise(F.array(line))
    changed = F.when(mine > 0, F.concat(before, new, after)).otherwise(F.concat(lines, new))
    rest = F.regexp_replace(text, HEADER, "")
    return F.when(header(text).isNull(), text).otherwise(F.concat(F.lit("---\n"), F.array_join(changed, "\n"), F.lit("\n---\n"), rest))


def set_field(text: Column, field: str, value: Column) -> Column:
    return _set_line(text, field, F.when(value.isNotNull(), F.concat(F.lit(f"{field}: "), quoted(value))))


def set_list(text: Column, field: str, values: Column) -> Column:
    listed = F.concat(F.lit(f"{field}: ["), F.array_join(F.transform(values, quoted), ", "), F.lit("]"))
    return _set_line(text, field, F.when(F.size(values) > 0, listed))
