"""Quality rules: base limits, then robust multivariate outliers by language and source.

A text's counts become a vector: mean word length, log rate of symbols, log rate of
repeated lines, share of words in repeated windows. For each (lang, source) a minimum
covariance determinant estimate is made over all documents that pass the base limits.
It has three starts, fixed functions of the data: medians and quartile distances, the
covariance of the signs of the vectors around the medians, and the rows that lie near the
medians in every statistic. Each start takes two concentration steps: distances under
its centre and scatter, the closest share of rows, their mean and covariance. The start
with the least determinant goes on, in each group, until its determinant no longer falls.
Then the estimate is reweighted once by the rows within the 97.5 % limit. A document
whose squared Mahalanobis distance exceeds the chi-square limit is rejected.

A step is one aggregation: rows are summed by (group, start, interval of distance), so
the shuffle carries a few hundred sums a group whatever its share of the rows, and the
closest rows are whole intervals plus the fitting fraction of the last one. Variances
have a floor, ``FLOORS`` (statistics that are 0 in all clean texts would have none).
Groups with fewer than ``least`` rows use their language's estimate, then that of all
rows; where those have too few rows as well, only the base limits count.

Defined cases: null text has no words and fails the base; null lang or source is a
group of its own; repeated rows count and are judged each; very long texts are counted
whole; extra columns stay, but for those named like a result, which the result replaces.
An empty table gives an empty table.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, kept, others, sent

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Least standard deviations of the four statistics.
FLOORS = (0.3, 0.4, 0.4, 0.15)
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def count(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, b" \t\n\v\f\r"))
    symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, upto = Counter(windows), 0
        for i, w in enumerate(windows):
            if times[w] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return len(words), len(text or "") - spaces, symbols, len(lines) - len(set(lines)), repeated


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five counts and base_failed."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = np.array([count(x.as_py()) for x in batch], np.int64).reshape(-1, len(COUNTS))
            yield pa.StructArray.from_arrays([pa.array(c) for c in found.T], names=list(COUNTS))

    counted = F.arrow_udf(run, ", ".join(f"{c} long" for c in COUNTS))  # type: ignore[call-overload]
    rest, own = others(docs, *COUNTS, "base_failed"), fresh("counts", docs.columns)
    out = docs.select(*rest, counted(text).alias(own)).select(*rest, *(F.col(own)[c].alias(c) for c in COUNTS))
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def kept_counts(docs: DataFrame) -> DataFrame:
    """The counts of ``docs`` without the text, as a small table that the steps read again and again."""
    return kept(with_counts(docs).drop("text"), "counts")


def chi_square_cdf(x: float, k: int) -> float:
    """For an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def chi_square_limit(tail: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi_square_cdf(mid, k) > tail else (low, mid)
    return high


def _vector() -> list[Column]:
    n = F.col("n_words").cast("double")
    n = F.greatest(n, F.lit(1.0))
    return [F.col("word_chars") / n, F.log1p(100 * F.col("n_symbols") / n), F.log1p(100 * F.col("n_dup_lines") / n), F.col("n_repeat_words") / n]


def _groups() -> list[Column]:
    """Keys of a row's groups: (lang, source), lang, all."""
    return [F.to_json(F.struct(F.lit(i).alias("level"), *cols)) for i, cols in enumerate((("lang", "source"), ("lang",), ()))]


def _distance(x: list[Column], centre: Column, inverse: Column) -> Column:
    gap = [v - centre[i] for i, v in enumerate(x)]
    return sum((inverse[k] * gap[i] * gap[j] * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS)), F.lit(0.0))


#: The vector of a row, and its moments.
X = [f"x{i}" for i in range(P)]


def _fitted(sums: DataFrame, spread: float) -> DataFrame:
    """group, start, n, centre, inverse, det (logarithm of the determinant) from weighted sums; ``spread`` makes the scatter consistent."""

    kind = pa.struct([("centre", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64())), ("det", pa.float64())])

    def solve(rows: pa.Array) -> pa.Array:
        out = []
        for s in rows.to_pylist():
            centre = np.array(s[1 : 1 + P]) / s[0]
            scatter = np.zeros((P, P))
            for k, (i, j) in enumerate(PAIRS):
                scatter[i, j] = scatter[j, i] = s[1 + P + k] / s[0] - centre[i] * centre[j]
            scatter = spread * scatter + np.diag(np.square(FLOORS))
            inverse = np.linalg.inv(scatter)
            out.append({"centre": centre.tolist(), "inverse": [float(inverse[i, j]) for i, j in PAIRS], "det": float(np.linalg.slogdet(scatter)[1])})
        return pa.array(out, kind)

    solved = F.arrow_udf(solve, "centre array<double>, inverse array<double>, det double")  # type: ignore[call-overload]
    return sums.where(F.col("sums")[0] > 0).withColumn("s", solved("sums")).select("group", "start", "n", "s.centre", "s.inverse", "s.det")


def _moments(x: list[Column], weight: Column | None = None) -> list[Column]:
    each = [*x, *(x[i] * x[j] for i, j in PAIRS)]
    return [F.sum(m if weight is None else weight * m) for m in each]


def _starts(rows: DataFrame) -> DataFrame:
    """The three starts of each group."""
    quartiles = [F.percentile_approx(x, [0.25, 0.5, 0.75], 2000) for x in X]
    found = kept(rows.groupBy("group").agg(F.count("*").alias("n"), *(q.alias(f"q{i}") for i, q in enumerate(quartiles))), "mcd-quartiles")
    variance = [F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + FLOORS[i] ** 2 for i in range(P)]
    inverse = F.array(*(1 / variance[i] if i == j else F.lit(0.0) for i, j in PAIRS))
    middle = F.array(*(F.col(f"q{i}")[1] for i in range(P)))
    first = found.select("group", F.lit(0).alias("start"), "n", middle.alias("centre"), inverse.alias("inverse"), F.lit(0.0).alias("det"))
    near = rows.join(sent(first.select("group", "n", "centre", "inverse")), "group")
    gap = [F.col(x) - F.col("centre")[i] for i, x in enumerate(X)]
    far = _distance([F.col(x) for x in X], F.col("centre"), F.col("inverse"))
    sign = P / F.greatest(far, F.lit(1e-9))
    inside = F.when(F.greatest(*(F.pow(g, 2) * F.col("inverse")[PAIRS.index((i, i))] for i, g in enumerate(gap))) <= 2.25, 1.0).otherwise(0.0)
    # Signs have their centre at the medians, so sums of gaps are 0 and moments are those of the gaps; the medians are added again.
    signs = near.groupBy("group").agg(F.first("n").alias("n"), F.first("centre").alias("middle"), F.array(F.count("*").cast("double"), *(F.lit(0.0) for _ in X), *_moments(gap, sign)[P:]).alias("sums"))
    signs = _fitted(signs.select("group", F.lit(1).alias("start"), "n", "sums"), 1.0).join(first.select("group", F.col("centre").alias("middle")), "group").select("group", "start", "n", F.col("middle").alias("centre"), "inverse", "det")
    boxed = near.groupBy("group").agg(F.first("n").alias("n"), F.array(F.sum(inside), *_moments([F.col(x) for x in X], inside)).alias("sums")).select("group", F.lit(2).alias("start"), "n", "sums")
    return kept(first.unionByName(signs).unionByName(_fitted(boxed, 1.0)), "mcd-starts")


def _step(rows: DataFrame, fit: DataFrame, spread: float, share: float | None = None, limit: float | None = None) -> DataFrame:
    """One concentration of each start: the closest ``share`` of each group, or all within ``limit``."""
    near = rows.join(sent(fit.select("group", "start", "centre", "inverse")), "group").withColumn("d2", _distance([F.col(x) for x in X], F.col("centre"), F.col("inverse")))
    edge = F.floor(32 * F.log2(1 + F.col("d2"))) if limit is None else (F.col("d2") > limit).cast("long")
    moments = _moments([F.col(x) for x in X])
    sums = near.groupBy("group", "start", edge.alias("edge")).agg(F.count("*").alias("m"), *(x.alias(f"s{k}") for k, x in enumerate(moments)))
    group = W.partitionBy("group", "start")
    if limit is None:
        before = F.sum("m").over(group.orderBy("edge")) - F.col("m")
        weight = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (share * F.sum("m").over(group) - before) / F.col("m")))
    else:
        weight = (F.col("edge") == 0).cast("double")
    weighed = sums.withColumn("weight", weight)
    total = weighed.groupBy("group", "start").agg(F.sum("m").alias("n"), F.array(F.sum(F.col("weight") * F.col("m")), *(F.sum(F.col("weight") * F.col(f"s{k}")) for k in range(len(moments)))).alias("sums"))
    return kept(_fitted(total, spread), "mcd-fit")


def robust_fit(rows: DataFrame, share: float = 0.75, most: int = 12, settled: float = 1e-3) -> DataFrame:
    """group, n, centre, inverse: the reweighted minimum-covariance-determinant estimate.

    rows: group, x0..x3. ``most`` bounds the steps after the choice of a start.
    """
    cut = chi_square_limit(1 - share, P)
    spread = share / chi_square_cdf(cut, P + 2)
    fit = _starts(rows)
    for _ in range(2):
        fit = _step(rows, fit, spread, share=share)
    columns = ("start", "n", "centre", "inverse", "det")
    fit = kept(fit.groupBy("group").agg(F.min_by(F.struct(*columns), F.struct("det", "start")).alias("best")).select("group", "best.*"), "mcd-best")
    for _ in range(most):
        new = _step(rows, fit, spread, share=share)
        both = new.join(fit.select("group", F.col("det").alias("was"), F.struct(*columns).alias("old")), "group")
        lower = F.col("det") < F.col("was")
        fit = kept(both.select("group", (F.col("was") - F.col("det")).alias("fall"), F.when(lower, F.struct(*columns)).otherwise(F.col("old")).alias("best")).select("group", "fall", "best.*"), "mcd-best")
        if fit.where(F.col("fall") > settled).isEmpty():
            break
    cut = chi_square_limit(0.025, P)
    return _step(rows, fit, 0.975 / chi_square_cdf(cut, P + 2), limit=cut).drop("start", "det")


def estimates(counted: DataFrame, least: int = 30) -> DataFrame:
    """key (of language and source), centre, inverse: each group's own fit, or the wider one it falls back to. counted: see :func:`with_counts`."""
    keys = [g.alias(f"g{i}") for i, g in enumerate(_groups())]
    sound = counted.where(~F.col("base_failed")).select(*keys, *(x.alias(X[i]) for i, x in enumerate(_vector())))
    fit = robust_fit(sound.select(F.explode(F.array("g0", "g1", "g2")).alias("group"), *X)).where(F.col("n") >= least)
    wide = sound.select("g0", "g1", "g2").distinct()
    for i in range(3):
        wide = wide.join(fit.select(F.col("group").alias(f"g{i}"), F.struct("centre", "inverse").alias(f"fit{i}")), f"g{i}", "left")
    return kept(wide.select(F.col("g0").alias("key"), F.coalesce("fit0", "fit1", "fit2").alias("fit")).select("key", "fit.*"), "mcd-chosen")


def judge(counted: DataFrame, fits: DataFrame, tail: float = 1e-9) -> DataFrame:
    """``counted`` (see :func:`with_counts`) with distance and kept."""
    key, fit = fresh("key", counted.columns), fresh("fit", counted.columns)
    rest = others(counted, "distance", "kept")
    out = counted.withColumn(key, _groups()[0]).join(sent(fits.select(F.col("key").alias(key), F.struct("centre", "inverse").alias(fit))), key, "left")
    distance = F.when(~F.col("base_failed"), _distance(_vector(), F.col(fit)["centre"], F.col(fit)["inverse"]))
    return out.select(*rest, distance.alias("distance")).withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= chi_square_limit(tail, P)))
