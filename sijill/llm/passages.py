"""Removal of repeated passages by hashed units.

A unit is a line or a piece of one. Besides line ends, pieces end after a full stop,
exclamation or question mark, before a capital that follows a small initial, and where
the hash of two words is the least within ``RADIUS`` words of the line: cuts that depend
on nearby words only, so a passage that stands in the middle of a foreign line is cut
alike in every document, which whole lines would not give. Units are normalised (case
folded, white space dropped), their digests grouped over all documents, and the
occurrence in the document of lowest rank (doc_id) is kept, in it the first. With
``lines``, every other occurrence of a whole line is removed, however short; a repeated
paragraph is repeated lines. Without, titles, licence lines and set phrases stay. Pieces
are removed where they follow one another over at least ``least`` words. A line's pieces
depend on the line alone, so those of a repeated line are repeated too. Removed spans are
given as offsets (code points) into the original text, which stays the earliest document's.

Grouping shuffles a digest and a rank a unit; sums of a digest meet already in the map
tasks, so a unit of a third of all documents is a row a task. Then only units whose
digest a bit table of the repeated ones holds travel, to the table itself and on to
their documents.

Defined cases: null text stays null; empty texts stay; a null doc_id has the last rank;
rows with one doc_id and text are one document (each keeps or loses the same spans),
and those with one doc_id but other texts do not take from one another; very long texts
are read whole; extra columns stay, but for one named removed, which the result replaces.
An empty table gives an empty table.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, kept, others, settle
from .idtable import held, table
from .wordhash import in_steps, mixed, spans, words

RADIUS, LONGEST = 5, 64
#: Keeps digests of whole lines apart from those of pieces.
LINE = np.uint64(0x8CB92BA72F3D8DD7)
LAST = 2**63 - 1


def _starts(w, line: np.ndarray) -> np.ndarray:
    """Whether a word starts a piece. line: the number of each word's line."""
    n = len(w.begin)
    start = np.zeros(n, bool)
    start[:1] = True
    start[1:] = line[1:] != line[:-1]
    last = w.codes[w.end - 1]
    start[1:] |= np.isin(last[:-1], (33, 46, 63))
    head = w.codes[w.begin]
    capital = ((head >= 65) & (head <= 90)) | ((head >= 0xC0) & (head <= 0xDE))
    start[1:] |= capital[1:] & ~capital[:-1]
    pair = w.hash.copy()
    pair[:-1] = np.where(line[1:] == line[:-1], mixed(w.hash[:-1] + (w.hash[1:] << np.uint64(1))), w.hash[:-1])
    least = np.ones(n, bool)
    for d in range(1, min(RADIUS, n - 1) + 1):
        apart = line[d:] != line[:-d]
        least[d:] &= (pair[d:] < pair[:-d]) | apart
        least[:-d] &= (pair[:-d] <= pair[d:]) | apart
    start |= least
    at = np.flatnonzero(start)
    inside = np.arange(n) - np.repeat(at, np.diff([*at, n])) if n else at
    return start | (inside % LONGEST == 0)


def units_of(texts: list[str], lines: bool = False) -> dict[str, np.ndarray]:
    """Per unit: text, number in the text (of a line: that of its first piece), digest, begin, end, following (begin of the next unit or the text's length), n_words, pieces (of a line; 0 in a piece), again (an earlier unit of the text is equal)."""
    w = words(texts, full=True)
    line = np.cumsum(w.codes == 10)[w.begin]
    at = np.flatnonzero(_starts(w, line))
    if not len(at):
        return {k: at for k in ("text", "number", "digest", "begin", "end", "following", "n_words", "pieces", "again")}
    to = np.array([*at[1:], len(w.begin)], np.int64)
    new = np.append(True, w.text[at][1:] != w.text[at][:-1])
    head = np.flatnonzero(new)
    number = np.arange(len(at)) - np.repeat(head, np.diff([*head, len(at)]))
    digest, pieces = spans(w.hash, at, to), np.zeros(len(at), np.int64)
    if lines:
        own = np.flatnonzero(np.append(True, line[at][1:] != line[at][:-1]))
        until = np.array([*own[1:], len(at)], np.int64)
        digest = np.append(digest, mixed(spans(w.hash, at[own], to[until - 1]) ^ LINE))
        number, pieces = np.append(number, number[own]), np.append(pieces, until - own)
        at, to = np.append(at, at[own]), np.append(to, to[until - 1])
    digest, text = digest.view(np.int64), w.text[at]
    offset = w.first[text]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.append(w.text[1:] != w.text[:-1], True)[to - 1]
    following = np.where(ends, size[text], np.append(w.begin, 0)[to] - offset)
    return {
        "text": text,
        "number": number,
        "digest": digest,
        "begin": w.begin[at] - offset,
        "end": w.end[to - 1] - offset,
        "following": following,
        "n_words": to - at,
        "pieces": pieces,
        "again": _again(text, digest),
    }


def _again(text: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Whether an earlier unit of the text has the digest."""
    order = np.lexsort((digest, text))  # stable
    text, digest = text[order], digest[order]
    out = np.zeros(len(order), bool)
    out[order[1:]] = (text[1:] == text[:-1]) & (digest[1:] == digest[:-1])
    return out


def units(docs: DataFrame, among=None, lines: bool = False) -> DataFrame:
    """docs: key, rank, text. One row a unit, with the document's key and rank. among: a table of digests to which units are limited, but for those that repeat within their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ranks = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for at, part in in_steps(b.column(2)):
                u = units_of(part, lines)
                if among is not None:
                    there = u["again"].astype(bool) | held(among.value, u["digest"].astype(np.int64))
                    u = {k: v[there] for k, v in u.items()}
                row = u["text"] + at
                ints = [pa.array(u[c], pa.int32()) for c in ("number", "begin", "following", "n_words", "pieces")]
                yield pa.RecordBatch.from_arrays([pa.array(keys[row], pa.int64()), pa.array(ranks[row], pa.int64()), pa.array(u["digest"], pa.int64()), *ints, pa.array(u["again"].astype(bool))], names=["key", "rank", "digest", "number", "begin", "following", "n_words", "pieces", "again"])

    return docs.select("key", "rank", "text").mapInArrow(run, "key long, rank long, digest long, number int, begin int, following int, n_words int, pieces int, again boolean")


def digests(docs: DataFrame, lines: bool = False) -> DataFrame:
    """rank, digest: each digest of a document once. docs: rank, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranks = b.column(0).to_numpy(zero_copy_only=False)
            for at, part in in_steps(b.column(1)):
                u = units_of(part, lines)
                once = ~u["again"].astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array(ranks[u["text"][once] + at], pa.int64()), pa.array(u["digest"][once], pa.int64())], names=["rank", "digest"])

    return docs.select("rank", "text").mapInArrow(run, "rank long, digest long")


def _cuts(least: int):
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32())]))

    def run(rows: pa.Array) -> pa.Array:
        number, begin, following, n_words, pieces = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in rows.flatten().flatten())
        row = np.repeat(np.arange(len(rows)), np.diff(rows.offsets.to_numpy()))
        key = row * int((number + pieces).max(initial=0) + 2) + number  # pieces of two texts never follow one another
        line = np.flatnonzero(pieces)
        line = line[np.argsort(key[line])]
        own = np.flatnonzero(pieces == 0)
        key_of, first = np.unique(key[own], return_index=True)  # repeated rows of a document
        own = own[first]
        at = np.searchsorted(key[line], key_of, "right") - 1
        gone = (at >= 0) & (key_of < (key[line] + pieces[line])[at]) if len(line) else np.zeros(len(own), bool)
        new = np.append(True, np.diff(key_of) != 1)[: len(own)]
        sums = np.add.reduceat(n_words[own], np.flatnonzero(new)) if len(own) else n_words[own]
        cut = gone | (sums[np.cumsum(new) - 1] >= least)
        own, key_of = own[cut], key_of[cut]
        start = np.flatnonzero(np.append(True, np.diff(key_of) != 1)[: len(own)])
        last = np.append(start[1:], len(own))[: len(start)].astype(np.int64) - 1
        ints = [begin[own[start]], following[own[last]], np.add.reduceat(n_words[own], start) if len(own) else n_words[own]]
        upto = np.searchsorted(row[own[start]], np.arange(len(rows) + 1))
        return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in ints], fields=list(kind.value_type)))

    # Else a filter on the result moves below it with a call of its own, and each task has two Python workers.
    return F.arrow_udf(run, "array<struct<begin:int,end:int,n_words:int>>").asNondeterministic()  # type: ignore[call-overload]


def repeated(docs: DataFrame, least: int = 28, lines: bool = False) -> DataFrame:
    """key, cuts: the spans to remove from the documents that have any. docs: key, rank, text."""
    first = digests(docs, lines).groupBy("digest").agg(F.min("rank").alias("first"), F.max("rank").alias("last")).where("first < last")
    first = kept(first.select("digest", "first"), "passages-first")
    settle(docs.sparkSession)
    own = units(docs, docs.sparkSession.sparkContext.broadcast(table(first.select("digest"))), lines)
    later = own.join(first, "digest").where("rank > first").select("key", "number", "begin", "following", "n_words", "pieces")
    within = own.where("again").select("key", "number", "begin", "following", "n_words", "pieces")
    found = later.unionByName(within).groupBy("key").agg(F.collect_set(F.struct("number", "begin", "following", "n_words", "pieces")).alias("units"))
    return found.select("key", _cuts(least)("units").alias("cuts")).where(F.size("cuts") > 0)


def remove(docs: DataFrame, least: int = 28, lines: bool = False) -> DataFrame:
    """``docs`` with the text cut, and removed: the spans cut from the original text."""
    key, own, gone = F.xxhash64("doc_id", "text"), fresh("key", docs.columns), fresh("cuts", docs.columns)
    rest = others(docs, "removed")
    cuts = repeated(docs.select(key.alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("rank"), "text"), least, lines)
    joined = docs.select(*rest, key.alias(own)).join(cuts.select(F.col("key").alias(own), F.col("cuts").alias(gone)), own, "left")
    cut, none = F.col(gone), F.expr("cast(array() as array<struct<begin:int,end:int,n_words:int>>)")
    ends = F.concat(F.array(F.lit(0)), F.transform(cut, lambda c: c["end"]))
    begins = F.concat(F.transform(cut, lambda c: c["begin"]), F.array(F.length("text")))
    left = F.array_join(F.zip_with(ends, begins, lambda a, b: F.substring(F.col("text"), a + 1, b - a)), "")
    text = F.when(cut.isNull(), F.col("text")).otherwise(left)
    return joined.select(*(text.alias(c) if c == "text" else c for c in rest), F.coalesce(cut, none).alias("removed"))
