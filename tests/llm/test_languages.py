"""The network's gradients against differences, its positions against a plain reading, and held-out accuracy."""

import os
import zlib

import numpy as np
import pytest

from sijill.llm import languages, queries

DIR = "/root/testdata/sf0.01"


def small(units=5, langs=("a", "b", "c")):
    return languages.Model.begin(list(langs), units, seed=3)


def test_gradients_against_differences():
    model = small()
    for d in (model.forward, model.backward):
        d.look, d.turn = d.look.astype(np.float64), d.turn.astype(np.float64)
    model.weights, model.bias = model.weights.astype(np.float64), model.bias.astype(np.float64)
    rng = np.random.default_rng(0)
    rows = rng.choice(np.frombuffer(b"abZ .\xc3\xa9", np.uint8), (9, 6))
    there = np.arange(9)[:, None] < np.array([9, 9, 4, 1, 7, 9])
    rows[~there] = 0
    lang = np.array([0, 1, 2, 0, 1, 2])
    _, found = model.gradients(rows, there, lang)
    for x, g in zip(model.parameters(), found, strict=True):
        used = np.argwhere(g != 0)
        for at in map(tuple, used[rng.permutation(len(used))[:25]]):
            old, step = x[at], 1e-3
            losses = []
            for s in (step, -step):
                x[at] = old + s
                losses.append(model.gradients(rows, there, lang)[0])
            x[at] = old
            assert g[at] == pytest.approx((losses[0] - losses[1]) / (2 * step), rel=0.03, abs=3e-5)


def plain(model, raw):
    """Probabilities at each byte of one window, read byte by byte."""

    def states(d, seq):
        h, out = np.zeros(d.turn.shape[1]), []
        for b in seq:
            gate = lambda g: 0.5 + 0.5 * (x := h @ d.turn[g] + d.look[g][b]) / (1 + abs(x))  # noqa: E731, B023
            r, z = gate(0), gate(1)
            n = r * (h @ d.turn[2]) + d.look[2][b]
            n = n / (1 + abs(n))
            h = (1 - z) * n + z * h
            out.append(h)
        return out

    on, back = states(model.forward, raw), states(model.backward, raw[::-1])[::-1]
    logits = [np.concatenate([a, b]) @ model.weights + model.bias for a, b in zip(on, back, strict=True)]
    return [np.exp(x - x.max()) / np.exp(x - x.max()).sum() for x in logits]


def test_positions_and_pools_against_a_plain_reading(monkeypatch):
    model = small()
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abé ñ.Z9€😀"), n)) for n in (1, 3, 64, 65, 200, 700)] + ["é", "x" * 128, "9 !"]
    monkeypatch.setattr(languages, "AT_ONCE", 3)
    got = languages.pooled(model, texts)
    for text, p in zip(texts, got, strict=True):
        raw = text.encode()
        each = [q for at in range(0, len(raw), 64) for q in plain(model, raw[at : at + 64])]
        letters = [q for b, q in zip(raw, each, strict=True) if languages.LETTER[b]]
        want = np.mean(letters, axis=0) if letters else np.zeros(3)
        assert p == pytest.approx(want, abs=1e-5)
        chars, place = [], 0
        for c in text:
            chars.append(model.langs[int(np.argmax(each[place]))] if languages.LETTER[raw[place]] else None)
            place += len(c.encode())
        said = [None] * len(text)
        for b, e, x in languages.labelled_spans(model, text):
            said[b:e] = [x] * (e - b)
        assert all(c is None or c == s for c, s in zip(chars, said, strict=True))


SCHEMA = "key long, text string, lang string"
ROWS = [(i, ("the thing and other with " if i % 2 else "der nicht und schön für ") * 6, "en" if i % 2 else "de") for i in range(60)]


def test_learns_spans_and_odd_rows(spark):
    model = languages.fit(spark.createDataFrame([*ROWS, (90, "zz", None), (91, None, "fr"), (92, "", "fr"), (93, "12", "fr")], SCHEMA), steps=60)
    assert model.langs == ["de", "en"]
    odd = [(1, "the other thing and with"), (2, "nicht für und der schön"), (3, None), (4, ""), (5, "12 -- 3"), (1, "the other thing and with"), (6, "日本語"), (7, "the and with " * 30_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in odd], "doc_id long, text string, lang_pred string, found int")
    got = languages.identify(docs, model)
    assert got.columns == ["doc_id", "text", "found", "lang_pred", "score"]
    rows = got.collect()
    said = {(r.doc_id, r.lang_pred) for r in rows}
    assert len(rows) == 8 and {(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (7, "en")} <= said
    assert all(0 <= r.score <= 1 for r in rows) and {r.score for r in rows if r.doc_id in (3, 4, 5)} == {0.0}
    mixed = "the other thing and with the thing. " * 4 + "nicht für und der schön der nicht. " * 4
    found = languages.spans(spark.createDataFrame([(1, mixed), (2, None)], "doc_id long, text string"), model)
    spans = {r.doc_id: r.spans for r in found.collect()}
    assert spans[2] is None and spans[1][0].begin == 0 and spans[1][-1].end == len(mixed)
    size = lambda x, lo, hi: sum(max(0, min(s.end, hi) - max(s.begin, lo)) for s in spans[1] if s.lang == x)
    assert size("en", 0, 144) > 110 and size("de", 144, len(mixed)) > 110


def test_nothing_to_learn(spark):
    assert languages.fit(spark.createDataFrame([(1, "..", "en"), (2, None, "de")], SCHEMA)) is None
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert [tuple(r)[2:] for r in languages.identify(docs, None).collect()] == [("und", 0.0)]
    assert not languages.identify(docs.limit(0), languages.Model.begin(["a"])).collect()


def test_sample_is_bounded_and_stable(spark):
    rows = spark.createDataFrame([(i, "abc " * (i % 90), f"l{i % 3}") for i in range(600)], SCHEMA)
    first = sorted(map(tuple, languages.sample(rows, rows=20).collect()))
    assert len({(r[0], r[1]) for r in first}) == 60 and all(len(r[3]) <= 64 for r in first)
    assert first == sorted(map(tuple, languages.sample(rows.repartition(7), rows=20).collect()))
    assert len({(r[0], r[1]) for r in languages.sample(rows, rows=20, in_all=9).collect()}) == 9


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = queries.op11_language_id(spark, DIR).collect()
    assert len(rows) == len(want)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.97 * len(held) > 200
