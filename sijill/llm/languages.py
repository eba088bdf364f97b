"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are read in windows of ``WINDOW`` bytes, from its first to its last,
forward and backward from a zero state. At every byte the two states together give the
probabilities of the languages: each position has a label, and a document's probabilities
are the mean over its letters. Gates and candidates use x / (1 + |x|), scaled to their
range, in place of the exponential forms: the same shape at a fraction of the time.

The network is trained in numpy, by backpropagation through time over whole windows and
Adam, on a bounded sample: at most ``ROWS`` rows a language by the hash of their keys
(fewer where more than ``ROWS_IN_ALL / ROWS`` languages are there), ``PIECES`` windows of
each, spread over its whole text. Windows are cut in the executors, so the driver gets as
many bytes as the sample has, whatever the corpus is. Scoring is one pass without a shuffle;
of many windows at once a step reads one byte each.

Defined cases: a null text and one without a letter are ``und`` with score 0, and so is
every text where nothing could be learned; null languages teach nothing; very long texts
are read whole; repeated rows are judged each; of equal probabilities the language first in
order counts; columns named like a result are replaced, other columns stay; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, others
from .wordhash import in_steps

#: Bytes of a window, units of a state, windows that one step reads at most.
WINDOW, UNITS, AT_ONCE = 64, 12, 2048
#: Bound of the sample: rows a language, rows in all, windows a row.
ROWS, ROWS_IN_ALL, PIECES = 400, 40_000, 4
#: Windows of a training step, steps, greatest rate.
BATCH, STEPS, RATE = 192, 240, 0.02

UNKNOWN = "und"
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    """Between 0 and 1; in place."""
    x /= 1 + np.abs(x)
    x *= 0.5
    x += 0.5
    return x


class Direction:
    """Reads rows of bytes one after another. look: what each byte adds to reset, update and candidate; turn: what the state does."""

    def __init__(self, look: np.ndarray, turn: np.ndarray):
        self.look, self.turn = look, turn

    def read(self, rows: np.ndarray, there: np.ndarray | None = None) -> np.ndarray:
        """The state after each row (step, window). there: where a window has a byte, else its state stays zero."""
        units, n = self.turn.shape[1], rows.shape[1]
        look, turn = (np.concatenate(list(x), axis=1) for x in (self.look, self.turn))
        out = np.zeros((len(rows), n, units), look.dtype)
        h = np.zeros((n, units), look.dtype)
        # Every step writes into the same arrays: making new ones would take longer than the sums.
        seen, led, gates, one, new, two = (np.empty((n, k * units), look.dtype) for k in (3, 3, 2, 2, 1, 1))
        for t, row in enumerate(rows.astype(np.int64)):
            np.take(look, row, axis=0, out=seen, mode="clip")
            np.matmul(h, turn, out=led)
            np.add(seen[:, : 2 * units], led[:, : 2 * units], out=gates)
            np.abs(gates, out=one)
            one += 1
            gates /= one
            gates *= 0.5
            gates += 0.5
            np.multiply(led[:, 2 * units :], gates[:, :units], out=new)
            new += seen[:, 2 * units :]
            np.abs(new, out=two)
            two += 1
            new /= two
            np.subtract(h, new, out=two)
            two *= gates[:, units:]
            h = np.add(two, new, out=out[t])
            if there is not None:
                h *= there[t][:, None]
        return out

    def learn(self, rows: np.ndarray, states: np.ndarray, there: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of look and turn, from ``error`` at every state back through time."""
        look, turn = np.zeros_like(self.look), np.zeros_like(self.turn)
        back = np.zeros_like(states[0])
        steps = np.zeros((3, *states.shape), np.float32)
        for t in range(len(rows) - 1, -1, -1):
            row, h = rows[t], states[t - 1] if t else np.zeros_like(states[0])
            r = _gate(h @ self.turn[0] + self.look[0][row])
            z = _gate(h @ self.turn[1] + self.look[1][row])
            q = h @ self.turn[2]
            n = _squash(self.look[2][row] + r * q)
            d = (error[t] + back) * there[t][:, None]
            dn = d * (1 - z) * (1 - np.abs(n)) ** 2
            dr = dn * q * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
            dz = d * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
            dq = dn * r
            turn[0] += h.T @ dr
            turn[1] += h.T @ dz
            turn[2] += h.T @ dq
            back = d * z + dr @ self.turn[0].T + dz @ self.turn[1].T + dq @ self.turn[2].T
            steps[:, t] = dr, dz, dn
        flat = rows.reshape(-1)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        for g in range(3):
            look[g][flat[order][first]] = np.add.reduceat(steps[g].reshape(len(flat), -1)[order], first)
        return look, turn


@dataclass
class Model:
    """langs in order; forward and backward; states to languages: weights (both states one after the other) and bias."""

    langs: list[str]
    forward: Direction
    backward: Direction
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def begin(cls, langs: list[str], units: int = UNITS, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        some = lambda *shape: (rng.standard_normal(shape) * 0.5 / np.sqrt(shape[-2])).astype(np.float32)
        one = lambda: Direction((rng.standard_normal((3, 256, units)) * 0.5).astype(np.float32), some(3, units, units))
        return cls(langs, one(), one(), some(2 * units, len(langs)), np.zeros(len(langs), np.float32))

    def positions(self, rows: np.ndarray, there: np.ndarray | None = None) -> np.ndarray:
        """Probabilities (language, step, window)."""
        return self._read(rows, there)[2]

    def _read(self, rows: np.ndarray, there: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        on = self.forward.read(rows, there)
        back = self.backward.read(rows[::-1], None if there is None else there[::-1])[::-1]
        units = on.shape[2]
        p = self.weights[:units].T @ on.reshape(-1, units).T
        p += self.weights[units:].T @ np.ascontiguousarray(back).reshape(-1, units).T
        p += self.bias[:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return on, back, p.reshape(-1, *rows.shape)

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.look, self.forward.turn, self.backward.look, self.backward.turn, self.weights, self.bias]

    def gradients(self, rows: np.ndarray, there: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over letters of windows (step, window) that are in language ``lang`` each, and its gradients."""
        on, back, p = self._read(rows, there)
        share = (LETTER[rows] & there).astype(np.float32)
        share /= max(1.0, share.sum())
        steps, windows = np.indices(rows.shape)
        loss = float(-(np.log(p[lang, steps, windows] + 1e-30) * share).sum())
        d = p.copy()
        d[lang, steps, windows] -= 1
        d = np.ascontiguousarray(np.moveaxis(d * share, 0, 2))
        flat, units = d.reshape(-1, d.shape[2]), on.shape[2]
        weights = np.concatenate([on.reshape(-1, units).T @ flat, back.reshape(-1, units).T @ flat])
        own = self.forward.learn(rows, on, there, d @ self.weights[:units].T)
        other = self.backward.learn(rows[::-1], back[::-1], there[::-1], (d @ self.weights[units:].T)[::-1])
        return loss, [*own, *other, weights, flat.sum(axis=0)]


def train(windows: list[bytes], lang: np.ndarray, langs: list[str], steps: int = STEPS, seed: int = 11) -> Model:
    """Adam over shuffled windows; the rate falls to nothing."""
    model, rng = Model.begin(langs, seed=seed), np.random.default_rng(seed)
    rows, there = _table(windows)
    mean, square = ([np.zeros_like(x) for x in model.parameters()] for _ in range(2))
    order = np.zeros(0, np.int64)
    for step in range(steps):
        if len(order) < min(BATCH, len(windows)):
            order = np.concatenate([order, rng.permutation(len(windows))])
        at, order = order[:BATCH], order[BATCH:]
        _, found = model.gradients(rows[:, at], there[:, at], lang[at])
        norm = np.sqrt(sum(float((g * g).sum()) for g in found))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * step / steps))
        for x, g, m, v in zip(model.parameters(), found, mean, square, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.99 ** (step + 1))) + 1e-8)
    return model


def _table(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows as columns of bytes, and where they have one."""
    size = np.fromiter(map(len, windows), np.int64, len(windows))
    flat = np.frombuffer(b"".join(w.ljust(WINDOW, b"\0") for w in windows), np.uint8).reshape(-1, WINDOW)
    return np.ascontiguousarray(flat.T), np.arange(WINDOW)[:, None] < size


def sample(labelled: DataFrame, rows: int = ROWS, in_all: int = ROWS_IN_ALL) -> DataFrame:
    """lang, window of the rows that teach. labelled: key, text, lang.

    A row's windows are cut where it lies; each task then keeps its rows of least hash a
    language before the rest meet.
    """
    known = labelled.where("lang is not null and text is not null")
    langs = known.select("lang").distinct().count()
    raw, size = F.encode("text", "UTF-8"), F.octet_length("text")
    at = [F.floor((size - WINDOW).cast("long") * i / max(1, PIECES - 1)).cast("int") for i in range(PIECES)]
    cut = F.when(size <= WINDOW, F.array(raw)).otherwise(F.array(*(F.substring(raw, a + 1, F.lit(WINDOW)) for a in at)))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("hash", "windows"))
    pieces = known.select("lang", F.xxhash64("key", "text").alias("hash"), cut.alias("windows")).withColumn("rank", rank)
    return pieces.where(F.col("rank") <= max(1, min(rows, in_all // max(1, langs)))).select("lang", "rank", F.posexplode("windows").alias("piece", "window"))


def fit(labelled: DataFrame, steps: int = STEPS) -> Model | None:
    """The network for all languages of ``labelled`` (key, text, lang), or None without a letter to learn from."""
    found = sorted((r.lang, r["rank"], r.piece, bytes(r.window)) for r in sample(labelled).collect())
    found = [r for r in found if LETTER[np.frombuffer(r[3], np.uint8)].any()]
    langs = sorted({r[0] for r in found})
    if not langs:
        return None
    return train([r[3] for r in found], np.array([langs.index(r[0]) for r in found]), langs, steps)


def _windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (a row each) of all texts one after another, their texts and lengths."""
    raw = [x.encode("utf-8", "surrogatepass") for x in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    many = -(-size // WINDOW)
    flat = np.frombuffer(b"".join(x.ljust(m * WINDOW, b"\0") for x, m in zip(raw, many.tolist(), strict=True)), np.uint8).reshape(-1, WINDOW)
    text = np.repeat(np.arange(len(texts)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return flat, text, np.minimum(size[text] - nth * WINDOW, WINDOW)


def _read_windows(model: Model, flat: np.ndarray, size: np.ndarray, use) -> None:
    """``use(places, rows, probabilities)`` of windows in steps: whole ones, then the texts' last."""
    for whole in (True, False):
        places = np.flatnonzero((size == WINDOW) == whole)
        for low in range(0, len(places), AT_ONCE):
            at = places[low : low + AT_ONCE]
            longest = int(size[at].max())
            rows = np.ascontiguousarray(flat[at, :longest].T)
            use(at, rows, model.positions(rows, None if whole else np.arange(longest)[:, None] < size[at]))


def pooled(model: Model, texts: list[str]) -> np.ndarray:
    """Each text's probabilities: the mean over its letters, 0 without any."""
    flat, text, size = _windows(texts)
    sums, letters = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))

    def use(at: np.ndarray, rows: np.ndarray, p: np.ndarray) -> None:
        is_letter = LETTER[rows]  # no byte beyond a window's end is a letter
        p *= is_letter
        np.add.at(sums, text[at], p.sum(axis=1).T)
        np.add.at(letters, text[at], is_letter.sum(axis=0))

    _read_windows(model, flat, size, use)
    return sums / np.maximum(letters, 1)[:, None]


def labelled_spans(model: Model, text: str) -> list[tuple[int, int, str]]:
    """(begin, end, lang) of runs of letters of one label, in code points; what is no letter joins the run before."""
    flat, _, size = _windows([text])
    best = np.full(flat.shape, -1)

    def use(at: np.ndarray, rows: np.ndarray, p: np.ndarray) -> None:
        best[at, : len(rows)] = np.where(LETTER[rows], p.argmax(axis=0), -1).T

    _read_windows(model, flat, size, use)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    label = best.reshape(-1)[: len(raw)][(raw & 0xC0) != 0x80]  # a character's label is that of its first byte
    there = np.flatnonzero(label >= 0)
    starts = there[np.flatnonzero(np.diff(label[there], prepend=-1))]
    return [(int(b), int(e), model.langs[label[b]]) for b, e in zip(starts, [*starts, len(label)][1:], strict=True)]


def _with(docs: DataFrame, result: str, kind: str, of, model: Model, text: str) -> DataFrame:
    """``docs`` with a struct of what ``of(model, texts)`` gives for texts that have a letter, null for others."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.concat_arrays([of(sent.value, part) for _, part in in_steps(b)] or [of(sent.value, [])])

    readable = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    return docs.withColumn(result, F.arrow_udf(run, kind)(readable))  # type: ignore[call-overload]


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the probability of that language). The model's size is a constant a language."""
    rest, own = others(docs, "lang_pred", "score"), fresh("found", docs.columns)
    none = F.lit(None).cast("string")
    if model is None:
        return docs.select(*rest, F.coalesce(none, F.lit(UNKNOWN)).alias("lang_pred"), F.lit(0.0).alias("score"))

    def of(model: Model, texts: list[str]) -> pa.Array:
        p = pooled(model, texts)
        best = p.argmax(axis=1)
        return pa.StructArray.from_arrays([pa.array([model.langs[i] for i in best], pa.string()), pa.array(np.round(p[np.arange(len(p)), best], 4))], names=["lang", "score"])

    found = _with(docs, own, "lang string, score double", of, model, text)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return found.select(*rest, F.when(letters, F.col(own)["lang"]).otherwise(UNKNOWN).alias("lang_pred"), F.when(letters, F.col(own)["score"]).otherwise(0.0).alias("score"))


def spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with spans: begin, end (code points) and lang of each run of one label; null where a text has no letter."""

    def of(model: Model, texts: list[str]) -> pa.Array:
        rows = [[{"begin": b, "end": e, "lang": x} for b, e, x in labelled_spans(model, t)] for t in texts]
        return pa.array(rows, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))

    own = fresh("found", docs.columns)
    found = _with(docs, own, "array<struct<begin: bigint, end: bigint, lang: string>>", of, model, text)
    return found.select(*others(docs, "spans"), F.when(F.col(text).rlike(r"\p{L}"), F.col(own)).alias("spans"))
