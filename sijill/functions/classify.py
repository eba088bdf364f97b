"""Document type and category from declarative rule tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE, WORD_END, present, squeeze, strip
from .urls import PARTS, unescape_path

# Types by the start of the title, the first that fits; the pattern of an amendment's path; category spellings.
TYPE_RULES = [
    ("مرسوم ملكي", r"^مرسوم ملكي"),
    ("أمر ملكي", r"^أمر ملكي"),
    ("قرار", rf"^قرار{WORD_END}|: ?قرار{WORD_END}"),
    ("اتفاقية", rf"^(?:اتفاقية|مذكرة تفاهم|بروتوكول){WORD_END}"),
    ("لائحة", rf"^(?:اللائحة|لائحة|قواعد|الدليل|دليل){WORD_END}"),
    ("معايير", rf"^(?:معايير|جدول|اشتراطات|ضوابط|مواصفات){WORD_END}"),
    ("نظام", rf"^(?:نظام|تنظيم){WORD_END}"),
]
AMENDMENT_PATH = rf"تحديثات(?:-|{SPACE})*الأنظمة|/nezam_update|تحديثات-الانظمة"
AMENDMENT, DECISION, OTHER = "تعديل", "قرار", "أخرى"
GENERAL = "الأنظمة السعودية"
ALIASES = {
    "أنظمة الأمن الداخلي": "أنظمة الأمن الداخلي والأحوال المدنية والأنظمة الجنائية",
    "أنظمة الإعلام والنشر والثقافة": "أنظمة الإعلام والثقافة والنشر",
    "الاعلام والثقافة والنشر": "أنظمة الإعلام والثقافة والنشر",
    "أنظمة البلدية والتخطيط والتطوير": "أنظمة البلدية والتخطيط والتطوير الحضري",
    "أنظمة التجارة الاقتصاد والاستثمار": "أنظمة التجارة والاقتصاد والاستثمار",
    "أنظمة الخدمات البلدية والتخطيط والتطوير": "أنظمة الخدمات البلدية والتخطيط والتطوير الحضري",
    "أنظمة الخدمة المدنية ، الموارد البشرية": "أنظمة الخدمة المدنية",
    "أنظمة الزراعة والمياة والثروات الحية": "أنظمة الزراعة والمياه والثروات الحية",
    "أنظمة المواصلات والإتصالات": "أنظمة المواصلات والاتصالات",
    "الرياضة والشباب": "أنظمة الشباب والرياضة",
    "العمل والرعاية الاجتماعية": "أنظمة العمل والرعاية الاجتماعية",
    "التنظيمات السعودية": "التنظيمات",
    "نظام": "التنظيمات",
    "لوائح وقواعد": "لائحة",
    "اللوائح التنظيمية": "لائحة",
}


def doc_type(title: Column, url: Column, is_decision: Column) -> Column:
    path = unescape_path(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 3))
    name = squeeze(title)
    out = F.when(path.rlike(AMENDMENT_PATH), AMENDMENT)
    for kind, pattern in TYPE_RULES:
        out = out.when(name.rlike(pattern), kind)
    return out.when(is_decision, DECISION).otherwise(OTHER)


def _alias(name: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in ALIASES.items() for x in pair)), name), name)


def simplify_category(raw: Column) -> Column:
    """The first telling part of a site's category, under its usual spelling; null if there is none."""
    bare = strip(F.regexp_replace(raw, rf"^الأنظمة{SPACE}+السعودية{SPACE}*[–—-]{SPACE}*", ""))
    parts = F.filter(F.transform(F.split(bare, "[–—]"), strip), lambda p: p != "")
    name = strip(F.regexp_replace(F.coalesce(F.get(parts, F.lit(0)), bare), r"\.+\z", ""))
    return _alias(F.nullif(present(name), F.lit(GENERAL)))


def resolve_category(raw: Column, kind: Column) -> Column:
    return F.coalesce(simplify_category(raw), _alias(F.nullif(present(kind), F.lit(OTHER))))
