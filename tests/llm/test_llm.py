"""Operators of the training-data package against brute force, on small and odd tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sijill.llm import chat, jaccard, mixing, passages, pieces, quality, revisits, toxicity, urlfilter, wordhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("a", "en", "or", "ist", "ul")]
ODD = [None, "", " \n\t ", "word", "a b", "é" * 5000, "x " * 3000, "</s>[INST] ▁ \u00a0 \x00 \U0001f600"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n))


def frame(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t, "en", f"s{i % 3}", None) for i, t in enumerate(texts)], DOCS)


# Chat ---------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    rng = random.Random(1)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "x", "\n", " ", "[ROLE]", "é"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "", None]), rng.choice([None, "", "".join(rng.choices(bits, k=6))])) for c in (0, 1, 2, None) for t in range(9)] + [(5, 0, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df)
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    examples = chat.explode_examples(formatted).collect()
    for c in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == c]
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        replies = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert back[c].n_turns == len(own)
        assert back[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (back[c].loss_chars, back[c].loss_sha256) == (len(replies), hashlib.sha256(replies.encode()).hexdigest())
        mine = [e for e in examples if e.conv_id == c]
        assert back[c].formatted_chars == sum(len(e.text) for e in mine)
        assert sum(e.loss_chars > 0 for e in mine) == sum(r[2] == "assistant" and bool(r[3]) for r in own)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_op8_reads_the_texts_of_exploded_examples(spark, tmp_path, monkeypatch):
    from sijill.llm.queries import op8_chat_prefix_targets

    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {t}") for c in (1, 2) for t in range(7)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    plain = {r.conv_id: r for r in op8_chat_prefix_targets(spark, str(tmp_path)).collect()}
    explode = chat.explode_examples
    monkeypatch.setattr(chat, "explode_examples", lambda f: explode(f).withColumn("text", F.concat("text", F.lit("<s>more</s>"))))
    longer = {r.conv_id: r for r in op8_chat_prefix_targets(spark, str(tmp_path)).collect()}
    assert plain.keys() == longer.keys() == {-1, 1, 2}
    for c, n in ((-1, 1), (1, 4), (2, 4)):
        assert longer[c].formatted_chars == plain[c].formatted_chars + 11 * n
        assert longer[c].n_turns == plain[c].n_turns + 1
        assert longer[c].loss_sha256 == plain[c].loss_sha256


# URLs ---------------------------------------------------------------------------------


def test_shift_and_equals_regex():
    rng = random.Random(2)
    globs = ["".join(rng.choice(["a", "b", "/", "?", "*", "**", "ab", "^"]) for _ in range(rng.randint(0, 7))) for _ in range(60)]
    texts = ["".join(rng.choices("ab/^c", k=rng.randint(0, 9))) for _ in range(300)] + ["", "a" * 300]

    def regex(g):
        return re.compile("".join({"**": "(?s:.)*", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*+|.", g.replace("***", "**"))) if "***" not in g else re.sub(r"\\\*(\\\*)+", "(?s:.)*", re.escape(g)).replace(r"\*", "[^/]*").replace(r"\?", "[^/]"))

    hits = urlfilter.ShiftAnd(globs).match(texts)
    assert urlfilter.ShiftAnd(globs).words > 1
    for j, g in enumerate(globs):
        assert [bool(regex(g).fullmatch(t)) for t in texts] == hits[:, j].tolist(), g


def test_url_rules(spark):
    from sijill.llm.queries import URL_BLOCKED, URL_RULES

    urls = [None, "", "no scheme", "http://A.COM", "http://a.com/x", "https://www.Example.com/en/1?q", "http://m.example.com/en/", "http://example.com/EN/", "http://x.net/fr/1#f", "http://x.net/fr", "http://spam.org/x", "ftp://a://b/c", "http://x.org/.example.com/en/"]
    df = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls)], "page_id long, url string, host_ string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(df, URL_RULES, URL_BLOCKED).orderBy("page_id").collect()]
    assert got[:3] == [("", "", None, "allow")] * 3
    assert got[3:] == [
        ("a.com", "", None, "allow"), ("a.com", "/x", "com/", "allow"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("m.example.com", "/en/", "example.com/en/", "block"),
        ("example.com", "/EN/", "com/", "allow"), ("x.net", "/fr/1", "net/fr/", "block"), ("x.net", "/fr", None, "allow"), ("spam.org", "/x", None, "block"), ("a:", "//b/c", None, "allow"), ("x.org", "/.example.com/en/", None, "allow"),
    ]


# Pieces -------------------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    rng = random.Random(3)
    texts = [*ODD, "▁▁a ▁", "  lead  and trail  ", *("".join(rng.choice([" ", "▁", "é", "the", "中", "\n", "\t", "\x01", "Ω", "ﬁ", "1"]) for _ in range(40)) for _ in range(60)), prose(rng, 400)]
    rows = pieces.encode(frame(spark, texts), path, keep_ids=True).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    for r, text in zip(rows, texts, strict=True):
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    bare = pieces.Encoder(open(path, "rb").read(), {})
    assert bare.split and [list(np.frombuffer(x, "<u4")) for x in bare(["a b c d e f", "g h", ""])] == [sp.encode(t, add_bos=True, add_eos=True) for t in ("a b c d e f", "g h", "")]


def test_each_word_of_the_table_is_segmented_once(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    model = spark.sparkContext.broadcast(open(path, "rb").read())
    texts = spark.createDataFrame([("often often often twice twice once  gap ",), (None,), ("",), ("x" * 30 + " " + "x" * 30,)], "text string")
    rows = {r.chunk: list(np.frombuffer(bytes(r.ids), "<u4")) for r in pieces.chunk_table(texts, model).collect()}
    assert rows == {f"▁{w}": sp.encode(w) for w in ("often", "twice")}
    assert {r.chunk for r in pieces.chunk_table(texts, model, most=1).collect()} == {"▁often"}
    assert pieces.chunk_table(texts.limit(0), model).count() == 0


# Mixing -------------------------------------------------------------------------------


def water(sizes, weights, total):
    """Targets by dealing the excess again and again."""
    out, open_ = {k: 0.0 for k in sizes}, set(sizes)
    left = total
    while open_ and left > 1e-9:
        rate = left / sum(weights[k] for k in open_)
        left = 0.0
        for k in list(open_):
            out[k] += rate * weights[k]
            if out[k] >= 2 * sizes[k]:
                left += out[k] - 2 * sizes[k]
                out[k] = 2 * sizes[k]
                open_.discard(k)
    return out


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(0, 60)), "en", rng.choice(["a", "b", "b", "b", "c", "d", None]), 0) for i in range(900)] + [(None, "x y", "en", "a", 0), (3, "x y z", "en", "b", 0), (901, None, "en", "a", 0), (902, "", "en", "empty", 0)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    order = sorted((k for k in sizes if k is not None)) + [None]
    want = water(sizes, {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}, 1.5 * sum(sizes.values()))
    by = {s: [r for r in got if abs(r.target - want[s]) < 1e-6 * (1 + want[s]) and r.source_size == sizes[s]] for s in sizes}
    for s in sizes:
        assert by[s] and abs(sum(r.taken for r in by[s]) - want[s]) <= 60
    assert all(r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in got)
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(map(str, mixing.mix(df.repartition(7)).collect())) == sorted(map(str, got))
    repeated = mixing.repeat_taken(df)
    assert repeated.columns == df.columns and sum(len((r.text or "").split()) for r in repeated.collect()) == sum(r.taken for r in got)
    assert mixing.mix(df.limit(0)).count() == 0


# Quality ------------------------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_counts_equal_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice(["a ", "b ", "a b c ", "#", "|", "\n", "\u00a0", "\x0b", "é ", "\x1c"]) for _ in range(rng.randint(0, 40)))
        assert quality.count(text) == brute_counts(text)
    for text in ODD:
        assert quality.count(text) == brute_counts(text)


def test_quality_rejects_outliers_only(spark):
    rng = random.Random(6)
    good, bad = [prose(rng, rng.randint(60, 200)) for _ in range(150)], [" ".join(w + "###" for w in prose(rng, 80).split()) for _ in range(12)]
    df = frame(spark, [*good, *bad, *ODD]).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.lit("hot")))
    counted = quality.kept_counts(df)
    rows = quality.judge(counted, quality.estimates(counted)).orderBy("doc_id").collect()
    assert len(rows) == df.count()
    assert all(r.kept for r in rows[:150]) and not any(r.kept for r in rows[150:162])
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in rows)
    empty = quality.kept_counts(df.limit(0))
    assert quality.judge(empty, quality.estimates(empty)).count() == 0
    assert abs(quality.chi_square_cdf(quality.chi_square_limit(0.025, 4), 4) - 0.975) < 1e-9


def reference_mcd(x, share=0.75, starts=60):
    """Concentration steps over plain rows, from many random starts: centre and scatter of the least determinant."""
    rng, h, best = np.random.default_rng(0), round(share * len(x)), None
    spread = share / quality.chi_square_cdf(quality.chi_square_limit(1 - share, 4), 6)
    for _ in range(starts):
        own = x[rng.choice(len(x), 6, replace=False)]
        for _ in range(40):
            centre, scatter = own.mean(axis=0), spread * np.cov(own.T, bias=True) + np.diag(np.square(quality.FLOORS))
            gap = x - centre
            own = x[np.argsort(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(scatter), gap))[:h]]
        scatter = spread * np.cov(own.T, bias=True) + np.diag(np.square(quality.FLOORS))
        det = np.linalg.slogdet(scatter)[1]
        if best is None or det < best[0]:
            best = (det, own.mean(axis=0), scatter)
    gap = x - best[1]
    near = x[np.einsum("ij,jk,ik->i", gap, np.linalg.inv(best[2]), gap) <= quality.chi_square_limit(0.025, 4)]
    limit = quality.chi_square_limit(0.025, 4)
    return near.mean(axis=0), 0.975 / quality.chi_square_cdf(limit, 6) * np.cov(near.T, bias=True) + np.diag(np.square(quality.FLOORS))


def test_robust_fit_equals_a_reference_of_many_starts(spark):
    """A fifth of far rows in a group, a fourth near the others in a correlated one, constant statistics, and a group of one value."""
    rng = np.random.default_rng(7)
    a = rng.normal(0, 1, (2000, 4)) @ np.diag([1, 0.5, 2, 1]) + [5, 1, 1, 1]
    a[:350] += 40
    b = rng.normal(0, 1, (1200, 4)) @ rng.normal(0, 1, (4, 4)) + [3, 0, 2, 1]
    b[:290] = rng.normal(0, 0.2, (290, 4)) + [9, 6, -6, 5]
    c = np.c_[rng.normal(6, 1, 600), np.zeros((600, 3))]
    c[:60, 1:] = 8
    rows = [(g, *map(float, r)) for g, x in (("a", a), ("b", b), ("c", c), ("d", np.ones((40, 4)))) for r in x]
    df = spark.createDataFrame(rows, "group string, x0 double, x1 double, x2 double, x3 double")
    got = {r.group: r for r in quality.robust_fit(df).collect()}
    for g, x in (("a", a), ("b", b), ("c", c), ("d", np.ones((40, 4)))):
        centre, scatter = reference_mcd(x)
        inverse = np.zeros((4, 4))
        for k, (i, j) in enumerate(quality.PAIRS):
            inverse[i, j] = inverse[j, i] = got[g].inverse[k]
        assert got[g].n == len(x)
        assert np.allclose(got[g].centre, centre, atol=0.1), g
        assert abs(np.linalg.slogdet(scatter)[1] + np.linalg.slogdet(inverse)[1]) < 0.15, g


# Jaccard ------------------------------------------------------------------------------


def brute_components(ids, texts, width=4, percent=85):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), ids[root(k)]) for k, (i, s) in enumerate(zip(ids, sets, strict=True))}


@pytest.mark.parametrize("seed, width, percent", [(8, 4, 85), (9, 5, 80)])
def test_jaccard_components_equal_brute_force(spark, seed, width, percent):
    rng = random.Random(seed)
    texts = [*ODD, "Word", "A b", "a  B"]
    for size, copies, edits in ((60, 40, 6), (150, 60, 12), (400, 12, 30), (8, 15, 2), (30, 30, 3)):
        base = prose(rng, size).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                k = rng.randrange(len(own))
                own[k : k + 1] = rng.choice([[], [rng.choice(VOCABULARY)], [own[k], "new"]])
            texts.append(" ".join(own))
    texts += [prose(rng, 20) + " " + prose(random.Random(0), 60) for _ in range(25)] + texts[-5:]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: (r.n, r.component) for r in jaccard.join(df, width, percent).collect()}
    want = brute_components(list(range(len(texts))), texts, width, percent)
    assert got == want
    assert len({c for _, c in want.values()}) < len(texts) - 30


@pytest.mark.parametrize("percent", [1, 35, 66, 70, 100])
def test_jaccard_of_any_percent(spark, percent):
    rng = random.Random(percent)
    base = prose(rng, 30).split()
    texts = [*ODD, *(" ".join(w if rng.random() > rate else rng.choice(VOCABULARY) for w in base) for rate in (0.02, 0.1, 0.3) for _ in range(12)), *(prose(rng, rng.randint(1, 12)) for _ in range(12))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert {r.id: (r.n, r.component) for r in jaccard.join(df, 3, percent).collect()} == brute_components(list(range(len(texts))), texts, 3, percent)


def test_jaccard_in_hot_regions(spark, monkeypatch):
    """Second pivots, windows, rounds and deals, in a group of copies whose edits recur, beside one passage in many texts; null and repeated ids."""
    for name, value in (("HOT", 10), ("SMALL", 2), ("DEAL", 7)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(30)
    base, passage = prose(rng, 70).split(), prose(rng, 30)
    edits = [(rng.randrange(60), rng.choice(VOCABULARY)) for _ in range(9)]
    texts = [f"{prose(rng, 40)} {passage} {prose(rng, 30)}" for _ in range(60)]
    for _ in range(150):
        own = list(base)
        for at, word in rng.sample(edits, rng.randint(0, 6)):
            own[at] = word
        texts.append(" ".join(own))
    texts += [t + " the end" for t in texts[:30]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "id long, text string")
    got = {r.id: (r.n, r.component) for r in jaccard.join(df, 4, 85).collect()}
    assert got == brute_components(list(range(len(texts))), texts, 4, 85)
    same = spark.createDataFrame([(None, texts[0]), (None, texts[0] + " x"), (5, texts[0] + " x y"), (7, texts[1]), (7, texts[2]), (9, texts[2] + " z"), (None, texts[3])], "id long, text string")
    assert sorted((str(r.id), str(r.component)) for r in jaccard.join(same, 4, 85).collect()) == [("5", "5"), ("7", "7"), ("7", "7"), ("9", "7"), ("None", "5"), ("None", "5"), ("None", "None")]


def test_jaccard_in_turns(spark, monkeypatch):
    """Pairs that are put together a few at a time give the same components, and no turn has more of them than it should."""
    rng = random.Random(8)
    base = [" ".join(rng.choices("abcdefghij", k=40)) for _ in range(12)]
    texts = [b + f" x{i}" for b in base for i in range(8)]
    monkeypatch.setattr(jaccard, "PAIRS", 20)
    seen, plain = [], jaccard._put_together
    monkeypatch.setattr(jaccard, "_put_together", lambda pairs, *rest: seen.append(pairs.count()) or plain(pairs, *rest))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r.id: (r.n, r.component) for r in jaccard.join(df, 3, 80).collect()}
    assert got == brute_components(list(range(len(texts))), texts, 3, 80)
    assert len(seen) > 4 and 0 < max(seen) < 60


def test_jaccard_empty(spark):
    assert jaccard.join(spark.createDataFrame([], "id long, text string")).count() == 0


# Passages -----------------------------------------------------------------------------


def test_passages_are_removed_once(spark):
    rng = random.Random(10)
    shared = ". ".join(prose(rng, 9).capitalize() for _ in range(8))
    texts = [f"{prose(rng, 30)} {shared}. {prose(rng, 25)}" for _ in range(6)]
    clean = [prose(rng, 80) + "\nA title line.\n" + prose(rng, 40) for _ in range(10)]
    df = frame(spark, [*texts, *clean, *ODD])
    rows = {r.doc_id: r for r in passages.remove(df).collect()}
    assert len(rows) == df.count()
    assert rows[0].text == texts[0] and not rows[0].removed
    inner = ". ".join(shared.split(". ")[1:-1])
    for i in range(1, 6):
        assert inner not in rows[i].text and rows[i].removed
        left, at = "", 0
        for c in rows[i].removed:
            left += texts[i][at : c.begin]
            at = c.end
        assert rows[i].text == left + texts[i][at:]
        assert len(rows[i].text.split()) >= 50
    for i, t in enumerate(clean):
        assert rows[6 + i].text == t
    assert passages.remove(df.limit(0)).count() == 0


def test_every_repeated_line_is_removed(spark):
    """Against brute force over whole lines, of any length; the query that is registered does so too."""
    rng = random.Random(20)
    pool = [prose(rng, rng.randint(1, 12)) for _ in range(40)]
    texts = ["\n".join(rng.choice([rng.choice(pool), rng.choice(pool).upper(), prose(rng, rng.randint(1, 12)), "", " \t"]) for _ in range(rng.randint(0, 9))) for _ in range(120)]
    rows = [*enumerate([*texts, *ODD]), (None, texts[3]), (None, pool[0] + "\nlast of all")]
    split = lambda t: [x for x in (tuple(re.findall(r"[^\x20\x09-\x0D]+", line.lower())) for line in (t or "").split("\n")) if x]
    owner, want = {}, {}
    for d, t in rows:
        own, left = set(), []
        rank = 2**63 - 1 if d is None else d
        for line in split(t):
            if owner.setdefault(line, rank) == rank and line not in own:
                left.append(line)
            own.add(line)
        want[d, t] = left
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = passages.remove(df.repartition(5), least=10**6, lines=True)
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted((str(r.doc_id), split(r.text)) for r in got) == sorted((str(d), left) for (d, _), left in want.items())


def test_op3_removes_short_repeated_lines(spark, tmp_path):
    from sijill.llm.queries import op3_substring_dedup

    rng = random.Random(21)
    texts = [f"{prose(rng, 20)}\nGPL licence line.\n{prose(rng, 20)}" for _ in range(4)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.text for r in op3_substring_dedup(spark, str(tmp_path)).collect()}
    assert rows == {i: t if i == 0 else t.replace("GPL licence line.\n", "") for i, t in enumerate(texts)}


def test_first_pass_sends_each_digest_of_a_text_once(spark):
    """Repeats within a text and places are left where they are; null ids and texts too."""
    rows = [(1, "One line here.\n" * 50), (2, "One line here.\nAnother one."), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "rank long, text string")
    for lines in (False, True):
        found = passages.digests(df, lines)
        assert found.columns == ["rank", "digest"]
        got = sorted((r.rank, r.digest) for r in found.collect())
        assert got == sorted({(rank, int(d)) for rank, text in rows for d in passages.units_of([text or ""], lines)["digest"]})


def plain_passages(rows):
    """The rows' texts after removal, by loops over words: cuts, first owners, runs and offsets; only the order of word hashes is the operator's."""
    hashes = {}

    def hash_of(word):
        if word not in hashes:
            hashes[word] = int(wordhash.words([word], full=True).hash[0])
        return hashes[word]

    def blended(h, after):
        return int(wordhash.mixed(np.array([(h + (after << 1)) % 2**64], np.uint64))[0])

    def fold(word):
        return "".join(c.lower() if len(c.lower()) == 1 else c for c in word)

    def cut_up(text):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
        said, line = [m.group() for m in found], [text.count("\n", 0, m.start()) for m in found]
        h, n = [hash_of(x) for x in said], len(found)
        pair = [blended(h[i], h[i + 1]) if i + 1 < n and line[i + 1] == line[i] else h[i] for i in range(n)]
        capital = [bool(re.match("[A-Z\u00c0-\u00de]", x)) for x in said]
        starts, inside = [], 0
        for i in range(n):
            near = [j for j in range(max(0, i - passages.RADIUS), min(n, i + passages.RADIUS + 1)) if line[j] == line[i]]
            least = all(pair[i] < pair[j] if j < i else pair[i] <= pair[j] for j in near)
            own = i == 0 or line[i] != line[i - 1] or said[i - 1][-1] in ".!?" or (capital[i] and not capital[i - 1]) or least
            inside = 0 if own else inside + 1
            if inside % passages.LONGEST == 0:
                starts.append(i)
        out = []
        for a, b in zip(starts, [*starts[1:], n][: len(starts)], strict=True):
            out.append((tuple(map(fold, said[a:b])), line[a], found[a].start(), found[b].start() if b < n else len(text), b - a))
        return out

    cut = {(d, t): cut_up(t or "") for d, t in rows}
    rank = lambda d: 2**63 - 1 if d is None else d
    lines = {at: {no: sum((u[0] for u in own if u[1] == no), ()) for no in {u[1] for u in own}} for at, own in cut.items()}
    owner = {}
    for (d, t), own in cut.items():
        for unit in [*(("piece", u[0]) for u in own), *(("line", x) for x in lines[d, t].values())]:
            owner[unit] = min(owner.get(unit, 2**63), rank(d))
    out = {}
    for (d, t), own in cut.items():
        seen, gone = set(), set()
        for no in sorted(lines[d, t]):
            if owner["line", lines[d, t][no]] < rank(d) or lines[d, t][no] in seen:
                gone.add(no)
            seen.add(lines[d, t][no])
        seen, repeats = set(), []
        for u in own:
            repeats.append(owner["piece", u[0]] < rank(d) or u[0] in seen)
            seen.add(u[0])
        drop = [False] * len(own)
        for i in range(len(own)):
            low, high = i, i
            while repeats[i] and low > 0 and repeats[low - 1]:
                low -= 1
            while repeats[i] and high + 1 < len(own) and repeats[high + 1]:
                high += 1
            drop[i] = own[i][1] in gone or (repeats[i] and sum(u[4] for u in own[low : high + 1]) >= 28)
        left, at = "", 0
        for u, no_more in zip(own, drop, strict=True):
            if no_more:
                left, at = left + t[at : u[2]], u[3]
        out[d, t] = None if t is None else left + t[at:]
    return out


def test_op3_equals_brute_force_over_pieces_and_lines(spark, tmp_path):
    """The registered query: passages inside foreign lines, cut edges, repeats within a text, capitals, long lines, ties and null ids."""
    from sijill.llm.queries import op3_substring_dedup

    rng = random.Random(22)
    sentence = lambda: prose(rng, rng.randint(3, 14)).capitalize() + rng.choice([".", "!", "?", ","])
    shared = [" ".join(sentence() for _ in range(rng.randint(2, 9))) for _ in range(8)] + [prose(rng, 200)]
    texts = []
    for _ in range(90):
        parts = []
        for _ in range(rng.randint(1, 6)):
            passage = rng.choice(shared).split()
            a = rng.randrange(len(passage))
            parts.append(rng.choice([sentence(), sentence(), " ".join(passage), " ".join(passage[a : a + 60]), prose(rng, 90), rng.choice(shared).upper()]))
        texts.append("".join(p + rng.choice([" ", " ", "\n", "\t ", "\n\n"]) for p in parts))
    rows = [*enumerate([*texts, *ODD]), (None, texts[3]), (None, texts[4] + " x"), (5, texts[5]), (5, texts[6])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_passages(rows)
    got = op3_substring_dedup(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(d), str(want[d, t])) for d, t in rows)
    assert sum(want[r] != r[1] for r in set(rows)) > 60


# Toxicity -----------------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(11)
    stems = {"moron": True, "idiotic": True, "scum": True, "lowei": False}
    lexicon = toxicity.Lexicon(stems)
    words = {"".join(rng.choices("moridtclsuewn", k=rng.randint(1, 9))) for _ in range(3000)}
    for s in stems:
        for _ in range(300):
            w = list(s)
            for _ in range(rng.randint(0, 2)):
                k = rng.randrange(len(w) + 1)
                w[k : k + rng.randint(0, 1)] = rng.choice([[], ["x"], ["o"]])
            words.add("".join(w))
    words = sorted(words - {""})
    for w, e in zip(words, lexicon.edits(words), strict=True):
        closed = min([d for s, c in stems.items() if c for d in [edits(w, s)] if d == 0 or (d == 1 and len(s) >= 5)], default=9)
        starts = [w[:k] for k in range(len(w) + 1)]
        open_ = min([0 if w.startswith("lowei") else 9] + [1 for p in starts if p and edits(p, "lowei") == 1 and p[-1] == "i" and p != "lowe"], default=9)
        assert e == min(closed, open_), w


def test_toxicity_learns_and_keeps_apart(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, 40) + (f" you {rng.choice(['zzidiot', 'zzmoron', 'zzclown'])} {prose(rng, 5)}" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    labelled = spark.createDataFrame(rows, "key long, text string, label int")
    model = toxicity.fit(labelled)
    df = spark.createDataFrame([(0, "well zzidiot yes"), (1, "well zzidi0t yes"), (2, prose(rng, 50)), *((i + 3, t) for i, t in enumerate(ODD))], "doc_id long, text string")
    got = [r.predicted for r in toxicity.score(df, model).orderBy("doc_id").collect()]
    assert got[0] == 1 and got[2:] == [0] * (len(got) - 2)
    assert toxicity.score(df, model).orderBy("doc_id").collect()[1].hits == 1
    assert toxicity.score(df.limit(0), model).count() == 0
    none = toxicity.fit(labelled.limit(0))
    assert {r.predicted for r in toxicity.score(df, none).collect()} == {0}


def test_quotation_lowers_the_score(spark):
    """One insult: aimed in toxic rows, quoted in a few clean ones."""
    rng = random.Random(13)
    aimed = [f"{prose(rng, 30)} you zzidiot {prose(rng, 5)}" for _ in range(150)]
    quoted = [f'{prose(rng, 30)} they said "zzidiot" {prose(rng, 5)}' for _ in range(3)]
    rows = [(t, 1) for t in aimed] + [(t, 0) for t in quoted] + [(prose(rng, 40), 0) for _ in range(300)]
    model = toxicity.fit(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "key long, text string, label int"))
    fill = prose(rng, 30)
    said, plain, to = model.scores([f'{fill} they said "zzidiot" indeed', f"{fill} some zzidiot indeed", f"{fill} you zzidiot indeed"])[0]
    assert said < plain < to and to >= 0.5


def test_stems_of_few_toxic_texts_are_learned():
    """A stem of one in fifty of the toxic texts is learned, beside one that all others have; one of ten texts is within chance here."""
    rng = random.Random(14)
    rows = [(f"{prose(rng, 20)} zzidiot", 1) for _ in range(980)] + [(f"{prose(rng, 20)} qqtonto", 1) for _ in range(20)] + [(prose(rng, 20), 0) for _ in range(3000)]
    stems = toxicity.choose_stems(*toxicity.candidates(rows), 1000, 3000)
    assert any("zzidiot".startswith(s) for s in stems) and any("qqtonto".startswith(s) for s in stems)


# Revisits -----------------------------------------------------------------------------


def test_revisits(spark):
    rng = random.Random(13)
    rows = []
    for i in range(400):
        url = rng.choice(["HTTP://A.com:80/x#f", "http://a.com/x", "http://b.com/", None, ""])
        headers = rng.choice([None, {}, {"etag": rng.choice(["W/1", "1", "2"]), "expires": f"e{i}", "server": f"s{i}"}, {"last-modified": rng.choice(["d1", "d2"])}])
        rows.append((i, rng.choice(["response", "revisit"]), url, rng.choice([None, *range(30)]), headers))
    df = spark.createDataFrame(rows, "record_id long, kind string, url string, ts long, headers map<string,string>")
    got = {r.record_id: r for r in revisits.resolve(df).collect()}
    key = lambda u: {None: "none", "": "", "http://b.com/": "b"}.get(u, "a")
    assert set(got) == {r[0] for r in rows if r[1] == "revisit"}
    for r in rows:
        if r[1] != "revisit":
            continue
        before = [o for o in rows if o[1] == "response" and o[3] is not None and r[3] is not None and key(o[2]) == key(r[2]) and (o[3], o[0]) < (r[3], r[0])]
        best = max(before, key=lambda o: (o[3], o[0]), default=None)
        assert got[r[0]].response_id == (best[0] if best else None)
        if best:
            a, b = r[4] or {}, best[4] or {}
            strip = lambda t: t.removeprefix("W/")
            differs = strip(a["etag"]) != strip(b["etag"]) if "etag" in a and "etag" in b else "last-modified" in a and "last-modified" in b and a["last-modified"] != b["last-modified"]
            assert got[r[0]].outcome == ("mismatch" if differs else "resolved")
            if not differs:
                assert got[r[0]].headers == b | {k: v for k, v in a.items() if k in revisits.PERMITTED}
        else:
            assert got[r[0]].outcome == "missing"
    assert revisits.resolve(df.limit(0)).count() == 0


# Names -------------------------------------------------------------------------------


CLASHES = ["cuts", "removed", "key", "rank", "digest", "centre", "inverse", "distance", "kept", "x0", "g0", "n_words", "counts", "base_failed", "hash", "target", "times", "limits", "limits_source", "copies", "below", "size", "n_tokens", "ids", "scored", "score", "hits", "host", "path", "judged", "rule", "fit", "row", "group", "class", "component", "n", "_key", "_copy", "_s"]


def test_clashing_columns_are_kept_or_replaced(spark):
    """Extra columns keep their values, but for those named like a result."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    rng = random.Random(40)
    texts = [prose(rng, rng.randint(40, 90)) for _ in range(8)] + [None, "", "a"]
    docs = frame(spark, [*texts, texts[0]]).withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in CLASHES})
    model = toxicity.Model(toxicity.Lexicon({}), np.zeros(6), 0.0)
    counted = quality.with_counts(docs)
    made = {
        "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed distance kept": quality.judge(counted, quality.estimates(counted)),
        "removed text": passages.remove(docs, lines=True),
        "": mixing.repeat_taken(docs),
        " ": jaccard.one_of_each(docs),
        "n_tokens ids_sha256 decoded_sha256 ids": pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep_ids=True),
        "score predicted hits": toxicity.score(docs, model),
        "host path rule verdict": urlfilter.judge(docs, [], [], url="text"),
    }
    for results, df in made.items():
        assert len(set(df.columns)) == len(df.columns), results
        stay = [c for c in CLASHES if c not in results.split()]
        assert set(stay) < set(df.columns), results
        rows = df.collect()
        assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in stay), results
        assert not any(r[c] == f"{c} {r.doc_id}" for r in rows for c in results.split() if c in CLASHES), results
