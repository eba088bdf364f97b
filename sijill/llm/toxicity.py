"""Toxicity: Levenshtein automata over a lexicon trie, scored in their context.

A lexicon of stems is learned from labelled texts: prefixes that occur in many toxic
texts and in next to none of the others. A stem is closed if it is mostly a word of its
own and open if it mostly goes on. The stems form a trie; the automaton that accepts
words within one edit of a stem is intersected with it and made deterministic, so a word
is judged in a fixed number of table look-ups, and a batch of texts is judged column by
column. An edit is one insertion, deletion or substitution; short stems and open stems'
last letters get none. Words within one edit that occur in non-toxic training texts are
learned as safe.

Each hit is read in a window of words: quotation marks or words of speech on both sides
count it as quoted, words of address as aimed at someone. A logistic regression over the
weights of exact, misspelt, quoted and aimed hits gives the score.

The training rows are bounded: ``most`` labelled rows with the smallest hashes. All
texts are scored, whole.

Defined cases: null and empty texts have no hit and get the score of such texts;
repeated rows are scored each; a very long text is one row; without training rows of
both labels the lexicon is empty and every score is the share of toxic rows, 0.0 if
there is none; extra columns stay, but for those named like a result, which the result
replaces. An empty table gives an empty table.
"""

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, others

#: What separates words, besides white space.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’‚‹›…—–·•¡¿"
_RAW = re.compile(r"[^\s]+")
QUOTES = frozenset("\"“”„«»‹›‘’")
#: Fixed words that speak of what somebody said, and that address somebody.
SPEECH = frozenset("said says say wrote writes quote quoted quotes called calls word words term insult reported dijo dice palabra sagte sagt wort dit mot".split())
ADDRESS = frozenset("you your youre yours u ur du dich dir ihr euch tu te toi vous usted ustedes eres".split())
WINDOW = 5
SHORTEST, LONGEST, FUZZY = 4, 14, 5
#: Labelled rows that a fit uses at most.
MOST = 10_000


def words_of(text: str | None) -> list[str]:
    out = (text or "").lower()
    for mark in _MARKS:
        out = out.replace(mark, " ")
    return out.split()


@dataclass
class Lexicon:
    """stems: text -> closed. safe: words within an edit that are no hits."""

    stems: dict[str, bool]
    safe: frozenset[str] = frozenset()
    table: np.ndarray = field(init=False)
    cost: np.ndarray = field(init=False)
    letters: np.ndarray = field(init=False)
    width: int = field(init=False)
    dead: int = field(init=False)

    def __post_init__(self) -> None:
        self._build()

    def _build(self) -> None:
        """Subset construction over (trie node, edits); class 0 is the end of the word, the last class any other character."""
        kids: list[dict[str, int]] = [{}]
        text, ends = [""], {}
        for stem, closed in self.stems.items():
            at = 0
            for c in stem:
                if c not in kids[at]:
                    kids[at][c] = len(kids)
                    kids.append({})
                    text.append(text[at] + c)
                at = kids[at][c]
            ends[at] = (closed, len(stem) >= FUZZY)
        loose = [False] * len(kids)  # a stem that allows edits lies below
        for at in range(len(kids) - 1, -1, -1):
            loose[at] = ends.get(at, (0, False))[1] or any(loose[k] for k in kids[at].values())
        self.width = max(map(len, self.stems), default=0) + 2
        letters = sorted({c for s in self.stems for c in s})
        self.letters = np.array([ord(c) for c in letters], np.uint32)

        def close(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            """Adds the states that leave out a letter of the trie, but not an open stem's last."""
            for at, edits in list(states):
                if edits == 0:
                    for k in kids[at].values():
                        if loose[k] and not (k in ends and not ends[k][0] and not kids[k]):
                            states.add((k, 1))
            return frozenset(states)

        def accepts(states: frozenset[tuple[int, int]], end: bool) -> int:
            """The fewest edits of a stem that ends here: closed stems only at the end of the word."""
            found = [e for at, e in states if at in ends and (ends[at][0] == end) and (e == 0 or ends[at][1])]
            found += [0 for at, e in states if e == 0 and at in ends and ends[at][0] and end]
            return min(found, default=9)

        start = close({(0, 0)})
        number, queue, rows, costs = {start: 0}, [start], [], []
        while queue:
            states = queue.pop(0)
            row, cost = [], []
            for c in ["", *letters, None]:
                if c == "":
                    row.append(-1)
                    cost.append(accepts(states, True))
                    continue
                following: set[tuple[int, int]] = set()
                for at, edits in states:
                    if c in kids[at]:
                        following.add((kids[at][c], edits))
                    if edits == 0 and loose[at]:
                        following.add((at, 1))
                        following |= {(k, 1) for k in kids[at].values() if loose[k] and not (k in ends and not ends[k][0] and not kids[k])}
                closed = close(following)
                cost.append(accepts(closed, False))
                if closed not in number:
                    number[closed] = len(number)
                    queue.append(closed)
                row.append(number[closed])
            rows.append(row)
            costs.append(cost)
        dead = number.setdefault(frozenset(), len(number))
        if dead == len(rows):
            rows.append([dead] * (len(letters) + 2))
            costs.append([9] * (len(letters) + 2))
        self.dead = dead
        self.table = np.array(rows, np.int32)
        self.table[self.table < 0] = dead
        self.cost = np.array(costs, np.int8)

    def edits(self, words: list[str]) -> np.ndarray:
        """Fewest edits from a stem for each word: 0, 1, or 9 where there is none."""
        if not words or not self.stems:
            return np.full(len(words), 9, np.int8)
        codes = np.array(words, dtype=f"<U{self.width}").view(np.uint32).reshape(len(words), -1)
        classes = np.full(int(self.letters.max()) + 2, len(self.letters) + 1, np.int32)
        classes[self.letters], classes[0] = np.arange(1, len(self.letters) + 1), 0
        best, live = np.full(len(words), 9, np.int8), np.arange(len(words))
        state = np.zeros(len(words), np.int32)
        for j in range(self.width):
            k = classes[np.minimum(codes[live, j], len(classes) - 1)]
            best[live] = np.minimum(best[live], self.cost[state, k])
            state = self.table[state, k]
            live, state = live[state != self.dead], state[state != self.dead]
        for i in np.flatnonzero(best == 1):
            if words[i] in self.safe:
                best[i] = 9
        return best


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Score and hits of each text."""
        x = features(self.lexicon, texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -40, 40))), x[:, -1].astype(int)


def _context(words: list[str], raw: list[str], at: int, near: int) -> tuple[bool, bool]:
    """Whether the hit at a raw word stands in quotation, and whether somebody is addressed."""
    left, right = raw[max(0, at - near) : at + 1], raw[at : at + near + 1]
    marks = any(QUOTES & set(x) for x in left) and any(QUOTES & set(x) for x in right)
    around = {w for x in left + right for w in words_of(x)}
    return marks or bool(SPEECH & around), bool(ADDRESS & around)


def features(lexicon: Lexicon, texts: list[str | None], near: int = WINDOW) -> np.ndarray:
    """log(1 + n) of exact, misspelt, quoted and aimed hits, their rate, and the plain number of hits."""
    each = [words_of(t) for t in texts]
    flat = [w for words in each for w in words]
    edits = lexicon.edits(flat)
    begin = np.cumsum([0, *map(len, each)])
    out = np.zeros((len(texts), 6))
    hit = np.flatnonzero(edits < 9)
    for i in np.unique(np.searchsorted(begin, hit, "right") - 1) if len(hit) else []:
        exact = misspelt = quoted = aimed = 0
        raw = _RAW.findall(texts[i])
        at = begin[i]
        for k, word in enumerate(raw):
            n = len(words_of(word))
            own = edits[at : at + n]
            at += n
            if n and own.min() < 9:
                said, to = _context(each[i], raw, k, near)
                quoted, aimed = quoted + said, aimed + (to and not said)
                exact, misspelt = exact + int((own == 0).sum()), misspelt + int((own == 1).sum())
        both = exact + misspelt
        out[i] = (*np.log1p([exact, misspelt, quoted, aimed]), 100 * both / max(20, len(each[i])), both)
    return out


def _parts(text: str | None) -> set[str]:
    """Prefixes of a text's words, and the whole words, which end in a space."""
    words = set(words_of(text))
    return {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)} | {f"{w} " for w in words if SHORTEST <= len(w) <= LONGEST}


def candidates(rows: list[tuple[str | None, int]]) -> tuple[dict[str, tuple[int, int]], int]:
    """Texts by prefix, as (non-toxic, toxic), for what three toxic texts have; how many prefixes toxic texts have."""
    toxic = Counter(p for text, label in rows if label for p in _parts(text))
    clean: Counter[str] = Counter()
    often = {p for p, n in toxic.items() if n >= 3}
    for text, label in rows:
        if not label:
            clean.update(_parts(text) & often)
    return {p: (clean[p], toxic[p]) for p in often}, len(toxic)


def choose_stems(counts: dict[str, tuple[int, int]], tried: int, toxic: int, clean: int, least: int = 3) -> dict[str, bool]:
    """Stems that tell toxic texts apart beyond chance, each as long as it loses no texts.

    How many texts that takes doesn't grow with the toxic rows, so a language with few of
    them has its stems too.
    """
    if not toxic or not clean:
        return {}
    prior = toxic / (toxic + clean)
    bar = math.log(100 * (tried + 1)) / -math.log(prior)

    def good(p: str) -> bool:
        no, yes = counts.get(p, (0, 0))
        return yes >= least and yes - 3 * no >= bar and no <= 0.02 * yes

    kept: dict[str, bool] = {}
    prefixes = sorted(p for p in counts if not p.endswith(" ") and good(p))
    longer = defaultdict(list)
    for p in prefixes:
        longer[p[:-1]].append(p)
    for p in prefixes:
        follow = max((counts[q][1] for q in longer[p]), default=0)
        if follow >= 0.9 * counts[p][1]:
            continue
        if any(p.startswith(s) for s in kept):
            continue
        own = counts.get(f"{p} ", (0, 0))[1]
        kept[p] = own >= 0.5 * counts[p][1]
    return kept


def fit(labelled: DataFrame, most: int = MOST, ridge: float = 1.0) -> Model:
    """labelled: text, label (0 or 1), key. At most ``most`` rows are used, by the key's hash."""
    bounded = labelled.select("text", F.col("label").cast("int").alias("label"), F.xxhash64("key").alias("h"), "key").orderBy("h", "key").limit(most).select("text", "label")

    rows = [(r["text"], r["label"]) for r in bounded.toLocalIterator()]
    toxic = sum(label for _, label in rows)
    clean = len(rows) - toxic
    if not toxic or not clean:
        rate = toxic / max(1, len(rows))
        return Model(Lexicon({}), np.zeros(6), math.log(max(rate, 1e-9) / max(1 - rate, 1e-9)))
    counts, tried = candidates(rows)
    stems = choose_stems(counts, tried, toxic, clean)
    plain = Lexicon(stems)
    heard: Counter[str] = Counter()
    for text, label in rows:
        if not label:
            words = sorted(set(words_of(text)))
            heard.update(w for w, e in zip(words, plain.edits(words), strict=True) if e == 1)
    lexicon = Lexicon(stems, frozenset(w for w, n in heard.items() if n >= 2))
    x = np.concatenate([features(lexicon, [t for t, _ in rows[at : at + 200]]) for at in range(0, len(rows), 200)])
    y = np.array([label for _, label in rows], float)
    return Model(lexicon, *logistic(x, y, ridge))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 30) -> tuple[np.ndarray, float]:
    """Newton steps; the bias has no penalty."""
    a = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(a.shape[1]), ridge * np.eye(a.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (p - y) + penalty @ w)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score, predicted and hits. The model's size is bounded by the training rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [sent.value.scores(batch[at : at + 500].to_pylist()) for at in range(0, len(batch), 500)]
            score, hits = (np.concatenate([p[i] for p in parts] or [[]]) for i in (0, 1))
            yield pa.StructArray.from_arrays([pa.array(score.astype(float)), pa.array(hits.astype(np.int32))], names=["score", "hits"])

    scored = F.arrow_udf(run, "score double, hits int")  # type: ignore[call-overload]
    rest, own = others(docs, "score", "predicted", "hits"), fresh("scored", docs.columns)
    out = docs.select(*rest, scored(text).alias(own))
    return out.select(*rest, F.col(own)["score"].alias("score"), (F.col(own)["score"] >= 0.5).cast("int").alias("predicted"), F.col(own)["hits"].alias("hits"))
