"""Names of documents: every URL gets a path of its own, as claims settled one after another do."""

import random

import pytest

from sijill.operators import corpus

SCHEMA = "url string, wanted string, owned string, ord int"


def one_by_one(rows):
    """Each round's claims in order, every path looked up among those given out."""
    order = lambda path: lambda r: (r[2] != path(r), r[3], r[0])
    given = {}
    for r in sorted(rows, key=order(lambda r: r[1])):
        given.setdefault(r[1], r[0])
    done = set(given.values())
    name = lambda r: f"{r[1].removesuffix('.md')} ({r[0].rsplit('/', 1)[1]})"
    full = lambda r: f"{name(r)}.md"
    left, fixed = [r for r in rows if r[0] not in done], set(given)
    for r in sorted(left, key=order(full)):
        if full(r) not in fixed:
            given.setdefault(full(r), r[0])
    done = set(given.values())
    left = sorted((r for r in left if r[0] not in done), key=lambda r: (r[3], r[0]))
    for r in left:
        own, tail = r[2] or "", (r[2] or "").removesuffix(".md").rsplit(" ", 1)[-1]
        if own.endswith(".md") and own == f"{name(r)} {tail}.md" and tail.isdigit() and tail[0] != "0" and int(tail) >= 2 and own not in fixed:
            given.setdefault(own, r[0])
    done = set(given.values())
    for r in left:
        if r[0] not in done:
            k = 2
            while f"{name(r)} {k}.md" in given:
                k += 1
            given[f"{name(r)} {k}.md"] = r[0]
    return {u: p for p, u in given.items()}


def settled(spark, rows):
    got = [tuple(r) for r in corpus.settle_paths(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(rows) == len({p for _, p in got}) == len({u for u, _ in got})
    return dict(got)


@pytest.mark.parametrize("seed", range(2))
def test_against_one_after_another(spark, seed):
    rng = random.Random(seed)
    names = ["k/a.md", "k/a (s).md", "k/a (s) 2.md", "k/a (s) 3.md", "k/a (s) (s).md", "k/b.md", "k/a (t) 5.md"]
    rows, owners = [], set()
    for i in range(70):
        owned = rng.choice([None, None, *names, *(f"k/a (s) {k}.md" for k in range(2, 40))])
        owned = None if owned in owners else owned
        owners.add(owned)
        rows.append((f"https://x/{i}/{rng.choice('sssst')}", rng.choice([names[0], names[0], *names]), owned, rng.randrange(-1, 1 << 20) if i % 5 else 7))
    assert settled(spark, rows) == one_by_one(rows)


def test_taken_suffixes_and_numbers(spark):
    """Three claims on one path of one slug, and a fourth on the number that the third would get."""
    rows = [(f"https://x/{i}/s", "k/a.md", None, i) for i in range(3)] + [("https://x/9/z", "k/a (s) 2.md", None, 9)]
    assert settled(spark, rows) == {"https://x/0/s": "k/a.md", "https://x/1/s": "k/a (s).md", "https://x/2/s": "k/a (s) 3.md", "https://x/9/z": "k/a (s) 2.md"}
    again = [(u, w, settled(spark, rows)[u], o) for u, w, _, o in rows]
    later = [*again, ("https://x/4/s", "k/a.md", None, -5)]
    kept = settled(spark, later)
    assert {u: kept[u] for u, *_ in rows} == settled(spark, rows) and kept["https://x/4/s"] == "k/a (s) 4.md"


def test_hot_name_over_several_spans(spark):
    """More claims on one name than a span has numbers, some of them held: all distinct, the least numbers used."""
    n = 70_000
    claims = spark.range(n).selectExpr("concat('https://x/', id, '/s') AS url", "'k/a.md' AS wanted", "CAST(NULL AS string) AS owned", "CAST(id * 3 AS int) AS ord")
    held = spark.range(2, 1002).selectExpr("concat('https://y/', id, '/z') AS url", "concat('k/a (s) ', id * 50, '.md') AS wanted", "CAST(NULL AS string) AS owned", "CAST(id AS int) AS ord")
    got = corpus.settle_paths(claims.unionByName(held))
    row = got.selectExpr("count(*) AS n", "count(DISTINCT path) AS paths", "max(try_cast(regexp_extract(path, ' ([0-9]+).md$', 1) AS int)) AS top").first()
    assert (row.n, row.paths) == (n + 1000, n + 1000) and row.top == n - 2 + 1 + 1000


def test_merge_keeps_two_documents_apart(spark):
    incoming = spark.createDataFrame([(i, f"https://x/{i}/s", "k/a.md", str(i)) for i in range(3)] + [(9, "https://x/9/z", "k/a (s) 2.md", "9")], "ord int, url string, wanted string, text string")
    empty = spark.createDataFrame([], "url string, path string, text string")
    rows = corpus.upsert(empty, incoming).collect()
    assert len({r.path for r in rows}) == 4 and {r.url[-3]: r.text for r in rows} == {"0": "0", "1": "1", "2": "2", "9": "9"}
