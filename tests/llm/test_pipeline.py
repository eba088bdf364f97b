"""The pipeline's stages on odd tables, and a whole run against the operators' plain counterparts."""

import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sijill.llm import common

corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, cuts string, ids string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "w", "c", "i") for i, t, s in rows], DOCS)


def test_run_on_odd_rows(spark, tmp_path):
    from sentencepiece import SentencePieceProcessor

    rng = random.Random(50)
    words = [f"{a}{b}" for a in "bdfgklmnprstvz" for b in ("a", "en", "or", "ist", "ul")]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(words) for _ in range(n))
    texts = [prose(rng.randint(60, 120)) + "\n" + prose(40) for _ in range(40)]
    near = [t + " end" for t in texts[:5]]
    line = prose(12)
    lined = [f"{prose(70)}\n{line}\n{prose(30)}" for _ in range(4)]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate([*texts, *near, *texts[:3], *lined, None, "", " \n", "word", "x " * 4000])]
    rows += [rows[7], (None, texts[9], "s0"), (3, prose(90), None), (None, prose(90), "s1")]
    docs = table(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0
        made = stage(spark, at, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns and empty.columns == docs.columns
        at = corpus_pipeline.kept(made, "test")
        seen[name] = at.collect()
    first, second, third, fourth, last = (seen[n] for n, _ in corpus_pipeline.STAGES)
    assert all(len((r.text or "").split()) >= 50 and r.n_words == "w" and r.cuts == "c" for r in first)
    assert len(first) == len(texts) + len(near) + 3 + len(lined) + 4  # all but null, empty and short texts, and the one that repeats
    own = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in second)
    assert len(own) == len(set(own)) == len(texts) + len(lined) + 2 and not {t for _, t in own} & set(near)
    assert sum(line in r.text for r in third) == 1 and all(r.n_chars == len(r.text) for r in third)
    size = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert abs(size(fourth) - 1.5 * size(third)) < 0.25 * size(third)
    sp = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted(hashlib.sha256(np.array(sp.encode(r.text, add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest() for r in fourth)
    assert sorted(r.ids_sha256 for r in last) == want and all(len(r.ids) == r.n_tokens and r.n_words == "w" for r in last)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.ids_sha256 for r in whole) == want


def test_units_do_not_depend_on_neighbours():
    """Units of a text alone, and between others, in one batch."""
    from sijill.llm import passages

    rng = random.Random(51)
    prose = lambda n: "".join(rng.choice("abcdefg") + rng.choice(["a ", "b ", "C ", "d. ", "e\n", "f  "]) for _ in range(n))
    for _ in range(100):
        texts = [prose(rng.randint(0, 150)) for _ in range(3)]
        for lines in (False, True):
            alone, among = passages.units_of(texts[1:2], lines), passages.units_of(texts, lines)
            own = among["text"] == 1
            names = [c for c in alone if c != "text"]
            assert sorted(zip(*(alone[c].tolist() for c in names), strict=True)) == sorted(zip(*(among[c][own].tolist() for c in names), strict=True))


def test_quality_rules_leave_no_texts_behind(spark, monkeypatch):
    """What the stage keeps beside its result lies on disk during all later stages."""
    from sijill.llm import quality

    kept = []
    for module in (corpus_pipeline, quality):
        plain = module.kept
        monkeypatch.setattr(module, "kept", lambda df, name, plain=plain: kept.append(df.columns) or plain(df, name))
    docs = table(spark, [(i, " ".join(f"word{(i * j) % 97}" for j in range(80)), "s") for i in range(60)])
    got = corpus_pipeline.quality_rules(spark, docs, "")
    assert kept and not any("text" in c for c in kept)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # texts are counted once more, not once a filter
    assert got.count() == len(got.select("doc_id").distinct().collect()) > 0


def test_cuts_are_made_once(spark):
    """A filter on the cuts has no call of its own, which would take a second worker a task for as long as workers live."""
    from sijill.llm import passages

    line = "a line of several words"
    docs = spark.createDataFrame([(i, i, f"{line}\nword{i} of {i}") for i in range(9)], "key long, rank long, text string")
    cuts = passages.repeated(docs, lines=True)
    assert cuts._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.key: [line + "\n"] == [f"{line}\nword"[c.begin : c.end] for c in r.cuts] for r in cuts.collect()} == dict.fromkeys(range(1, 9), True)


def test_shuffle_files_go_with_the_step_that_needed_them(spark):
    """Not when the driver collects its garbage: until then those of several steps would lie on disk together."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def lying():
        files = disk.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_") and name.endswith(".data")}

    df = spark.range(20_000).select(F.xxhash64("id").alias("a")).groupBy("a").count()
    set_before, before = spark.conf.get(common.CLEAN_KEY), lying()
    out = common.kept(df.join(df.withColumnRenamed("count", "n"), "a"), "shuffled")
    until = time.time() + 10
    while lying() - before and time.time() < until:
        time.sleep(0.1)
    assert not lying() - before
    assert out.count() == 20_000 and df.count() == 20_000
    assert spark.conf.get(common.CLEAN_KEY) == set_before
    common.discard(out)
