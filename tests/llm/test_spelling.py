"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from sijill.llm import spelling

SCHEMA = "doc_id long, text string"


def brute(rows):
    n = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if id is None else id}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 7:
                n[low] += 1
    n = {w: c for w, c in n.items() if c >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    forms, out = {}, {}
    for w in n:
        around = [x for x in n if near(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best and n[best] >= 10 * n[w] else None
        out[w] = len(around)
    rows = set()
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n[w], out[w], n.get(forms[w])))
    return rows


def found(spark, rows):
    df = spelling.variants(spark.createDataFrame(rows, SCHEMA))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def typo(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("abéÿ") + word[i:], word[:i] + rng.choice("abéÿ") + word[i + 1 :]])


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abÉ×ß"[: rng.randint(2, 5)], k=rng.randint(6, 10))) for _ in range(25)]
    once = [typo(rng, s) for s in stems for _ in range(4)]
    words = [w for i, s in enumerate(stems) for w in [s] * rng.choice([1, 2, 25, 300])] + once * 2 + [typo(rng, w) for w in once] * 2
    rng.shuffle(words)
    rows = [(i if i % 9 else None, " ".join(w.title() if k % 3 else w for k, w in enumerate(words[i::40]))) for i in range(40)]
    want = brute(rows)
    assert found(spark, rows) == want
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)


def test_planted_chain(spark):
    """A rare misspelling leads over a more frequent one to the root; equal counts go by code point."""
    rows = [(1, "wonderfull " * 300 + "wonderful " * 20 + "wondrful " * 2 + "aaaaaaaz aaaaaaay " * 40 + "aaaaaaa " * 2)]
    got = {r[0]: r[1:] for r in found(spark, rows)}
    assert {r for r in found(spark, rows)} == brute(rows)
    assert got["wondrful"][:2] == ("wonderful", "wonderfull") and got["aaaaaaa"][0] == "aaaaaaay"


def test_every_neighbour_once():
    import numpy as np

    alphabet = np.array(sorted(map(ord, "abé")), np.uint32)
    for word in ("a", "aab", "abéab", "bbbbb"):
        made = [x for _, x in spelling.neighbours([word], alphabet, lambda h: np.ones(h.shape, bool))]
        want = {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abé"} | {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "abé"}
        assert len(made) == len(set(made)) and set(made) == want - {word}
        told = {int(h) for h in spelling.hashes(made)}
        hit = [x for _, x in spelling.neighbours([word], alphabet, lambda h, told=told: np.isin(h.view(np.int64), list(told)))]
        assert sorted(hit) == sorted(made)  # hashes of neighbours are those of the strings


def test_long_word_in_steps(monkeypatch):
    """A word whose neighbourhood takes many steps gives the same neighbours."""
    import numpy as np

    alphabet = np.array(sorted(map(ord, "abé")), np.uint32)
    word = "abéb" * 40
    whole = sorted(x for _, x in spelling.neighbours([word], alphabet, lambda h: np.ones(h.shape, bool)))
    monkeypatch.setattr(spelling, "STEP", 50)
    assert sorted(x for _, x in spelling.neighbours([word], alphabet, lambda h: np.ones(h.shape, bool))) == whole


def test_odd_rows(spark):
    long = "Straße" * 3000
    rows = [(None, None), (None, ""), (2, "1234 --"), (3, f"{long} x {long}"), (3, f"{long} x {long}"), (4, "short words go")]
    assert found(spark, rows) == brute(rows)
    assert not spelling.variants(spark.createDataFrame([], SCHEMA)).collect()
    extra = spark.createDataFrame([(1, "wonderfull wonderfull", "x", "y")], "doc_id long, text string, word string, n string")
    assert [r.word for r in spelling.variants(extra).collect()] == ["wonderfull"]
