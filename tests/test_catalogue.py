"""Every registered query against its SQL, on the smallest tables."""

import math
import os
import re

import pytest

from sijill.plans import catalogue

DIR = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{name}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    found = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name not in catalogue.SQL:
        assert found
        return
    rel = duck.sql(catalogue.SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert found == sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())


def test_whole_texts_give_file_names(spark):
    """Against brute force: the whole text, cut at 200 bytes between characters."""
    rows = [(r.doc_id, r.text) for r in catalogue.table(spark, DIR, "documents").collect()] + catalogue.LONG_TITLES

    def name(text):
        out = re.sub(r"\s+", " ", re.sub(r'[/\\:*?"<>|]', " ", text or ""), flags=re.ASCII).strip()
        out = out.encode()[:200].decode(errors="ignore").strip()
        return out if out.strip(".") else "بدون-عنوان"

    want = {d: name(t) for d, t in rows}
    got = {r.doc_id: r.name for r in catalogue.QUERIES["sanitize_filename_whole"](spark, DIR).collect()}
    assert got == want
    assert sum(190 < len(n.encode()) <= 200 for n in got.values()) > 50
