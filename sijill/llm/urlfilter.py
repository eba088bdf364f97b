"""URL filters: glob rules simulated together by a multiword Shift-And automaton.

Every pattern character is one bit of a state kept in several 64-bit words. For each
URL character all patterns move at once: ``D = (D << 1) & B[c] | D & L[c]``, where B
says which bits a character may enter and L on which bits a wildcard may stay. The
simulation is vectorised over a batch of URLs, one step a character position.

Globs: ``?`` is one character but ``/``, ``*`` a run without ``/``, ``**`` any run.
They are matched against the whole canonical URL: host, lower-cased, then path.

Defined cases: a null URL or one without ``://`` has empty host and path and fits only
globs that match the empty string; very long URLs cost their length; repeated rows are
judged each; other columns are kept, but for those named like a result, which the
result replaces. An empty table gives an empty table.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, others

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _items(glob: str) -> list[tuple[str, str]]:
    """(character, or '' for any but '/'; wildcard that follows: '', '*' or '**'); first an item without character."""
    out, at = [("^", "")], 0
    while at < len(glob):
        if glob[at] == "*":
            star = "**" if glob.startswith("**", at) else "*"
            out[-1] = (out[-1][0], max(out[-1][1], star))
            at += len(star)
        else:
            out.append(("" if glob[at] == "?" else glob[at], ""))
            at += 1
    return out


class ShiftAnd:
    """All globs packed into one multiword state."""

    def __init__(self, globs: Sequence[str]):
        items, self.last = [], []
        for glob in globs:
            items += _items(glob)
            self.last.append(len(items) - 1)
        letters = sorted({c for c, _ in items if len(c) == 1 and c != "^"} | {"/"} | ({"^"} if any("^" in g for g in globs) else set()))
        starts = [0, *(x + 1 for x in self.last[:-1])]
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        self.words = max(1, -(-len(items) // 64))
        enter = np.zeros((len(letters) + 1, len(items)), bool)
        stay = np.zeros_like(enter)
        for bit, (c, star) in enumerate(items):
            if bit not in set(starts):
                enter[:, bit] = True if c == "" else False
                if c != "":
                    enter[letters.index(c), bit] = True
            stay[:, bit] = star != ""
            slash = letters.index("/")
            enter[slash, bit] &= c != ""
            stay[slash, bit] = star == "**"
        first = np.zeros((1, len(items)), bool)
        first[0, starts] = True
        self.enter, self.stay, self.first = map(self._pack, (enter, stay, first))

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(bits), self.words * 64), np.uint8)
        wide[:, : bits.shape[1]] = bits
        return np.packbits(wide, axis=1, bitorder="little").view("<u8")

    def match(self, texts: Sequence[str]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        n = len(texts)
        size = np.fromiter(map(len, texts), np.int64, n)
        order = np.argsort(-size, kind="stable")
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin = (np.cumsum(size) - size)[order]
        size = size[order]
        state = np.repeat(self.first, n, axis=0)
        for at in range(int(size[0]) if n else 0):
            live = int(np.searchsorted(-size, -at, "left"))
            c = codes[begin[:live] + at]
            k = np.minimum(np.searchsorted(self.letters, c), len(self.letters) - 1)
            k[self.letters[k] != c] = len(self.letters)
            d = state[:live]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.enter[k]) | (d & self.stay[k])
        out = np.empty((n, len(self.last)), bool)
        for j, bit in enumerate(self.last):
            out[order, j] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return out


def rule_globs(host: str, path: str) -> list[str]:
    """A rule on a host and its subdomains, for paths that start with ``path``."""
    return [f"{host}{path}**", f"*.{host}{path}**"]


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], blocked: Sequence[str], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (allow or block).

    rules: (verdict, host, path); the longest that fits decides. blocked: globs that
    decide where no rule fits; what none of them matches is allowed.
    """
    globs = [g for _, host, path in rules for g in rule_globs(host, path)] + list(blocked)
    names = np.array([f"{host}{path}" for _, host, path in rules] + [None], dtype=object)
    says = np.array([verdict for verdict, _, _ in rules])
    longest = sorted(range(len(rules)), key=lambda i: -len(names[i]))
    machine = ShiftAnd(globs) if globs else None

    def run(urls: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in urls:
            hits = machine.match(batch.to_pylist()) if machine else np.zeros((len(batch), 0), bool)
            best = np.full(len(batch), len(rules))
            for i in reversed(longest):
                best[hits[:, 2 * i] | hits[:, 2 * i + 1]] = i
            verdict = np.where(hits[:, 2 * len(rules) :].any(axis=1), "block", "allow").astype(object)
            ruled = best < len(rules)
            verdict[ruled] = says[best[ruled]] if len(rules) else verdict[ruled]
            yield pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(verdict.tolist(), pa.string())], names=["rule", "verdict"])

    judged = F.arrow_udf(run, "rule string, verdict string")  # type: ignore[call-overload]
    rest, own = others(pages, "host", "path", "rule", "verdict"), fresh("judged", pages.columns)
    host, path = host_of(F.col(url)), path_of(F.col(url))
    out = pages.select(*rest, host.alias("host"), path.alias("path"), judged(F.concat(host, path)).alias(own))
    return out.select(*rest, "host", "path", F.col(own)["rule"].alias("rule"), F.col(own)["verdict"].alias("verdict"))
