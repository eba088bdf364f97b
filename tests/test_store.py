"""The corpus by folders: a merge leaves other folders' files alone, empties folders, and can be run again."""

import os

from pyspark.sql import functions as F

from sijill.sources import store

SCHEMA = "ord int, url string, wanted string, text string"


def files_of(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(f"{root}/files") for f in names if f.endswith(".parquet")}


def rows_of(spark, root):
    return {r.url: (r.path, r.text, r.part) for r in store.read(spark, root).collect()}


def test_small_merge_leaves_other_folders(spark, tmp_path):
    root = str(tmp_path / "corpus")
    many = spark.range(1000).selectExpr("CAST(id AS int) AS ord", "concat('u', id) AS url", "concat('f', id % 20, '/', id, '.md') AS wanted", "concat('text ', id) AS text")
    assert store.merge(spark, root, many, "a").groupBy("action").count().collect()[0]["count"] == 1000
    before, rows = files_of(root), rows_of(spark, root)
    some = spark.createDataFrame([(i, f"u{20 * i + 3}", f"f3/{20 * i + 3}.md", "changed" if i else "text 3") for i in range(10)], SCHEMA)
    changes = {r.url: r.action for r in store.merge(spark, root, some, "b").collect()}
    assert changes == {f"u{20 * i + 3}": "updated" for i in range(1, 10)}
    after = files_of(root)
    gone, made = before - after, after - before
    assert gone and made and all("part=f3/" in f for f in gone | made)
    for i in range(1, 10):
        rows[f"u{20 * i + 3}"] = (f"f3/{20 * i + 3}.md", "changed", "f3")
    assert rows_of(spark, root) == rows
    assert {r.part: r.merge for r in store.manifest(spark, root).collect()} == {f"f{i}": "b" if i == 3 else "a" for i in range(20)}
    assert store.differing(spark, root).isEmpty()
    assert store.merge(spark, root, some, "b").isEmpty() and files_of(root) == after  # nothing new: nothing is written


def test_moves_empty_folders_and_names(spark, tmp_path):
    root = str(tmp_path / "corpus")
    merge = lambda rows, name: store.merge(spark, root, spark.createDataFrame(rows, SCHEMA), name).collect()
    merge([(0, "https://x/a", "one/t.md", "1"), (1, "https://x/b", "two/t.md", "2"), (2, "https://x/c", "t.md", "3")], "a")
    assert {p for _, _, p in rows_of(spark, root).values()} == {"one", "two", "."}
    moved = merge([(0, "https://x/a", "two/t.md", "1")], "b")
    assert [(r.action, r.path, r.old_path) for r in moved] == [("moved", "two/t (a).md", "one/t.md")]
    assert rows_of(spark, root) == {"https://x/a": ("two/t (a).md", "1", "two"), "https://x/b": ("two/t.md", "2", "two"), "https://x/c": ("t.md", "3", ".")}
    assert not os.path.exists(f"{root}/files/part=one") and {r.part for r in store.manifest(spark, root).collect()} == {"two", "."}
    odd = 'a:b/c=d "e"'
    merge([(0, "https://x/c", f"{odd}/t.md", "4")], "c")
    assert rows_of(spark, root)["https://x/c"] == (f"{odd}/t.md", "4", odd)
    merge([(0, "https://x/c", "two/u.md", None)], "d")
    assert rows_of(spark, root)["https://x/c"] == ("two/u.md", None, "two") and store.differing(spark, root).isEmpty()


def test_a_merge_that_died_is_run_again(spark, tmp_path, monkeypatch):
    root, rows = str(tmp_path / "corpus"), [(0, "u", "k/a.md", "1"), (1, "v", "l/a.md", "2")]
    store.merge(spark, root, spark.createDataFrame(rows, SCHEMA), "a")
    write = store._overwrite

    def dies(df, path):
        if path.endswith("manifest"):
            raise RuntimeError("lost")
        write(df, path)

    monkeypatch.setattr(store, "_overwrite", dies)
    new = spark.createDataFrame([(0, "u", "k/a.md", "new")], SCHEMA)
    try:
        store.merge(spark, root, new, "b")
    except RuntimeError:
        pass
    assert [r.part for r in store.differing(spark, root).collect()] == ["k"]
    monkeypatch.undo()
    store.repair(spark, root, "b")
    store.merge(spark, root, new, "b")
    assert store.differing(spark, root).isEmpty() and rows_of(spark, root)["u"] == ("k/a.md", "new", "k")
    assert store.read(spark, root).agg(F.count("*")).first()[0] == 2
