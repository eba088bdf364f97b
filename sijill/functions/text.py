"""Text expressions: Column in, Column out, all evaluated by Catalyst."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode; ``\s`` alone is ASCII in Java patterns.
SPACE = r"[\s\u0085\p{Z}\x1c-\x1f]"
#: The same, one after another.
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: What ends a word: ``\b`` differs between engines after Arabic letters.
WORD_END = r"(?![\p{L}\p{N}_])"

# Marks that are dropped, letters that are unified, digits.
MARKS = "ًٌٍَُِّْٰـ"
ALEFS = "أإآ"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used: else its expression is copied into every use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(text: Column) -> Column:
    """White space collapsed to single spaces and stripped."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def fold_arabic(text: Column) -> Column:
    """Diacritics and stretching dropped, forms of alef unified."""
    return F.translate(text, ALEFS + MARKS, "ا" * len(ALEFS))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, ARABIC_DIGITS, "0123456789")


def clean_line(text: Column) -> Column:
    """White space collapsed, separators stripped from both ends."""
    return F.regexp_replace(F.regexp_replace(text, f"{SPACE}+", " "), r"^[ :،–—-]+|[ :،–—-]+\z", "")


def strip_cms_label(text: Column) -> Column:
    """Without the label of a two-language form field in front."""
    return F.regexp_replace(text, rf"^(?:Arabic|English)(?:{SPACE}+Full{SPACE}+Name)?{SPACE}*:?{SPACE}+", "")


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def unquoted(text: Column) -> Column:
    return F.regexp_replace(text, r'\\(["\\])', "$1")


def present(text: Column) -> Column:
    """Null for the empty string: either is an absent field."""
    return F.nullif(text, F.lit(""))
