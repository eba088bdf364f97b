"""Spelling variants: every word's full neighbourhood, hash-joined to the vocabulary.

A word's neighbourhood is every string that one deleted, replaced or inserted code point
makes of it, over the alphabet that the vocabulary shows. Each is made once: a code point
is deleted from the first place of a run of equal ones, inserted nowhere behind an equal
one, and replaced by others only, and the three kinds differ in length. What the join with
the vocabulary finds is near by construction, so nothing measures a distance. Both words of
a pair make each other, and each gets its own row.

Neighbours are made as hashes first: with running sums of a polynomial hash, one costs a
few operations however long the word is. A bit table of the vocabulary (of bounded size)
says which hashes can be words; those alone are written out as strings and joined by value,
so a hash that two strings share costs a row and no more. Where the table is full, more
rows travel and the result is the same. A word has at most 2 * (length + 1) * alphabet
neighbours: no key of the join has more rows, however frequent a word is.

Defined cases: null and empty texts have no words; a null id counts as the empty string in
the hash that plants deletions; rows with one id and repeated rows are counted each; very
long texts and runs are read whole; extra columns are ignored; an empty table gives an empty
table. Words are ordered by code point.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, kept
from .idtable import BITS, held, table
from .wordhash import mixed

#: A word is a maximal run of these.
RUN = r"([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Shortest word in code points, least occurrences, and how much more frequent a form is.
SHORTEST, LEAST, RATIO = 7, 2, 10
#: Neighbours that one step makes, about, and rows of a batch that leaves it.
STEP, ROWS = 1_000_000, 20_000
#: Places of the bit table for each word, and most places.
PLACES, MOST_BITS = 16, 2**28

_BASE = 0xD1342543DE82EF95
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))
_ODD = 0x9E3779B97F4A7C15


def _planted(id: Column, run: Column) -> Column:
    """The run, without one code point where 31 divides the crc32 of id and run."""
    h = F.crc32(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(31)) == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n of all texts. docs: doc_id, text. Occurrences are summed up in each task before they travel."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(1))).alias("run"))
    low = runs.where(F.char_length("run") >= shortest).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = low.select(_planted(F.col("doc_id"), F.col("run")).alias("word")).where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _hash(sums: np.ndarray, length: int) -> np.ndarray:
    return mixed(sums + np.uint64(length * _ODD % 2**64))


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths, each with the places of its words."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size):
        yield int(length), np.flatnonzero(size == length)


def hashes(words: list[str]) -> np.ndarray:
    """The hash of each word, as long."""
    out = np.zeros(len(words), np.uint64)
    for length, at in _by_length(words):
        for low in range(0, len(at), max(1, STEP // max(1, length))):
            part = at[low : low + max(1, STEP // max(1, length))]
            value = mixed(_codes([words[i] for i in part], length).astype(np.uint64))
            out[part] = _hash((value * _powers(length)).sum(axis=1, dtype=np.uint64), length)
    return out.view(np.int64)


def neighbours(words: list[str], alphabet: np.ndarray, known) -> Iterator[tuple[int, str]]:
    """(place of a word, neighbour) for every distinct neighbour whose hash ``known`` may hold."""
    sign = mixed(alphabet.astype(np.uint64))
    for length, places in _by_length(words):
        per = max(1, STEP // max(1, (length + 1) * len(alphabet)))
        for low in range(0, len(places), per):
            own = places[low : low + per]
            yield from _of_length([words[i] for i in own], own, length, alphabet, sign, known)


def _of_length(words: list[str], own: np.ndarray, length: int, alphabet: np.ndarray, sign: np.ndarray, known) -> Iterator[tuple[int, str]]:
    codes = _codes(words, length)
    value, power = mixed(codes.astype(np.uint64)), _powers(length + 1)
    sums = np.zeros((len(words), length + 1), np.uint64)  # of the code points before each place
    np.cumsum(value * power[:-1], axis=1, out=sums[:, 1:])
    whole = sums[:, -1:]
    gone = _hash(sums[:, :-1] + (whole - sums[:, 1:]) * _INVERSE, length - 1)
    first = np.ones(codes.shape, bool)
    first[:, 1:] = codes[:, 1:] != codes[:, :-1]
    for w, i in np.argwhere(known(gone) & first):
        yield own[w], words[w][:i] + words[w][i + 1 :]
    wide = max(1, STEP // max(1, len(words) * len(alphabet)))  # places in one step: all, but for a very long word
    for low in range(0, length + 1, wide):
        at = slice(low, min(low + wide, length + 1))
        there = slice(low, min(low + wide, length))
        other = codes[:, there, None] != alphabet
        swapped = _hash((whole - value[:, there] * power[:-1][there])[:, :, None] + sign * power[:-1][there][:, None], length)
        for w, i, c in np.argwhere(known(swapped) & other):
            yield own[w], words[w][: low + i] + chr(alphabet[c]) + words[w][low + i + 1 :]
        rest = sums[:, at] + (whole - sums[:, at]) * np.uint64(_BASE)
        more = _hash(rest[:, :, None] + sign * power[at][:, None], length + 1)
        fresh = np.ones(more.shape, bool)
        before = codes[:, max(low, 1) - 1 : at.stop - 1]
        fresh[:, max(low, 1) - low :] = before[:, :, None] != alphabet
        for w, i, c in np.argwhere(known(more) & fresh):
            yield own[w], words[w][: low + i] + chr(alphabet[c]) + words[w][low + i :]


def _hashed(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(hashes(b.column(0).to_pylist()))], names=["hash"])

    return words.select("word").mapInArrow(run, "hash long")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n: each word beside each that one code point tells from it. words: word, n, kept."""
    spark = words.sparkSession
    # Code points of the pattern's class, some 90 at most.
    alphabet = np.array(sorted(ord(r.c) for r in words.select(F.explode(F.split("word", "")).alias("c")).distinct().where("c <> ''").collect()), np.uint32)
    if not len(alphabet):
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    bits, n_words = BITS, words.count()
    while bits < min(MOST_BITS, PLACES * n_words):
        bits *= 2
    sent = spark.sparkContext.broadcast(table(_hashed(words), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def known(x: np.ndarray) -> np.ndarray:
            return held(sent.value, x.reshape(-1), bits).reshape(x.shape)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(n, pa.int64()), pa.array(near, pa.string())], names=["word", "n", "near"])

        for b in batches:
            words, counts = b.column(0).to_pylist(), b.column(1).to_pylist()
            own, n, near = [], [], []
            for at, found in neighbours(words, alphabet, known):
                own.append(words[at])
                n.append(counts[at])
                near.append(found)
                if len(near) == ROWS:
                    yield batch()
                    own, n, near = [], [], []
            yield batch()

    # A few bytes of words are much work: they are dealt out again.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_words // ROWS)
    made = words.select("word", "n").repartition(tasks, "word").mapInArrow(run, "word string, n long, near string")
    return made.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form: the last one that forms lead to, by pointer jumps. forms: word, form, kept.

    A form is more frequent by ``RATIO``, so a chain has no circle and a few members only.
    """
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        far = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = kept(at.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        if at is not forms:
            discard(at)
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")
        at.kept_path = moved.kept_path


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n. docs: doc_id, text.

    form is the near word of largest n (of equal ones the first by code point) if that is
    at least ``ratio`` times the word's own, else null; root is where forms lead.
    """
    words = kept(vocabulary(docs, shortest, least), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near_words(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    fits = -F.col("best.n") >= ratio * F.col("n")
    judged = kept(near.select("word", "n_near", F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n")), "spelling-forms")
    led = roots(judged.where("form is not null").select("word", "form"))
    out = words.join(judged, "word", "left").join(led, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
