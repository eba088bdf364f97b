"""Exact Jaccard join of texts on word shingles, in metric regions.

The distance is 1 - |A & B| / |A | B| over sets of hashed shingles, a metric; two texts
link when it is at most e = ``1 - percent / 100``. Unlike texts are all at distance near
1, where the triangle inequality separates nothing: a window around any pivot's Voronoi
region would take in every text. So texts are first cut into regions by signatures,
without loss: a set's hashes are dealt into slightly more parts than two linked sets can
differ in elements, and by the pigeonhole principle two linked sets agree on a part that
isn't empty. (Under 70 percent that may fail, and the signatures are the leading elements
that two linked sets must share.)

Regions then join recursively. A region's pivot is the text that most of its members
share most regions with; regions of one pivot are one. Every member is measured against
it, and what links to it is one component. A region of over ``HOT`` members has a
second pivot outside the first one's window: a member's home is the Voronoi region of the
nearer, and it is replicated into that of a pivot p where d(member, p) <= d(member, home)
+ 2 e, the window outside of which nothing of p's region can be linked to it. Only pairs with a member at home count there.

Within a pivot's region, texts are taken as differences to the pivot: since A ^ B =
(A ^ p) ^ (B ^ p), members that differ from p in k elements and others link only if
these differences agree enough (the triangle inequality, in elements), and what p
explains is gone from them. Members meet by the leading elements of their differences
(those outside p first; see :func:`_differences`), in one region an element, if it has
members of several components. Regions in which one side has at most ``SMALL`` members
list their pairs, which are measured if they share as many leading elements as a link
needs. Others are joined as above, with a pivot of their own, which all members agree with
on that element. Once a round leaves over a quarter of
the members that it began with, all regions count as small. No pair that could link two
components goes untested, so components are exact.

Equal sets are one class and travel as one; a group of copies is never expanded. Sets
are sent once a class and pair with a pivot, and the members of a large region are
dealt over several tasks. Sets are made only for classes in a region with another class,
found by a bit table of fixed size; where that is full, more rows travel and the result
is the same.

Defined cases: null and empty texts and texts without words have no shingle and link
with nothing, not even with each other; fewer words than a shingle are one shingle;
rows with a null id are linked like others, but null is the last id: a component has a
null id only where all its rows have; rows with one id and other texts are linked each
by its own text; very long texts are read whole; extra columns are ignored; percent is
1 to 100. Sets are compared by 64-bit hashes of their shingles. An empty table gives an
empty table.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, kept, settle
from .idtable import held, table
from .wordhash import in_steps, mixed, spans, words

#: Members of a region from which on it has more pivots, and up to which a side of it lists pairs.
HOT, SMALL = 500, 16
#: Members of a pivot that one task measures, about.
DEAL = 1000
#: Rows of a few numbers up to which a table is sent to all tasks, or read by one.
FEW = 100_000
#: Pairs whose sets are put together at a time, about.
PAIRS = 400_000


def sets_of(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z are folded."""
    w = words(texts, full=False)
    counts = np.bincount(w.text, minlength=len(texts))
    begin = np.cumsum(counts) - counts
    out = []
    at = np.arange(len(w.begin))
    end = np.minimum(at + width, (begin + counts)[w.text])
    whole = (end - at == width) | ((at == begin[w.text]) & (counts[w.text] < width))
    hashes = spans(w.hash, at, end)
    for i in range(len(texts)):
        own = slice(begin[i], begin[i] + counts[i])
        out.append(np.unique(hashes[own][whole[own]]))
    return out


#: Least percent at which a set can be dealt into more parts that aren't empty than linked sets differ in.
DEALT = 70


class Scheme:
    """How sets of some size are dealt into parts, for links of at least ``percent``."""

    def __init__(self, percent: int):
        if not 1 <= percent <= 100:
            raise ValueError("percent must be 1 to 100")
        self.percent = percent
        low = [1]
        while DEALT <= percent < 100 and low[-1] < 2**40:
            low.append(max(low[-1] + 1, -(-low[-1] * 100 // percent)))
        self.low = np.array(low)

    @lru_cache(maxsize=4096)
    def differ(self, c: int) -> int:
        """Most elements in which linked sets differ, one of size class c, the other no smaller."""
        x = int(self.low[c + 1]) - 1
        return most_differ(x + x * 100 // self.percent, self.percent)

    def signatures(self, s: np.ndarray) -> np.ndarray:
        if not len(s):
            return np.zeros(0, np.uint64)
        if self.percent < DEALT:
            return np.sort(mixed(s))[: len(s) + 1 - -(-len(s) * self.percent // 100)]
        c = int(np.searchsorted(self.low, len(s), "right")) - 1
        found = [self._dealt(s, k) for k in (c - 1, c) if k >= 0 and self.differ(k)]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def _dealt(self, s: np.ndarray, c: int) -> np.ndarray:
        """Linked sets agree on (parts - differ) parts. More of them than are empty must be
        there; a set with many empty parts is dealt into more parts as well."""
        differ, out, level = self.differ(c), [], 0
        spare = 2 + differ // 16
        value = mixed(s ^ np.uint64(0x5851F42D4C957F2D))
        while True:
            parts = differ + 1 + spare
            at = (mixed(s + np.uint64(c * 64 + level + 1)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            at = at[order]
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            size = np.diff([*first, len(at)]).astype(np.uint64)
            out.append(mixed(np.add.reduceat(value[order], first) + mixed(at[first].astype(np.uint64) * np.uint64(2**20) + np.uint64(c * 64 + level)) + size))
            if len(first) > differ:
                return np.concatenate(out)
            spare, level = spare * 2, level + 1


def _class(s: np.ndarray) -> int:
    """One number for a set; 0 for the empty set."""
    if not len(s):
        return 0
    return int((mixed(np.array([mixed(s).sum(dtype=np.uint64) + np.uint64(len(s))]))[0] | np.uint64(1)).astype(np.int64))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """As :func:`kept`; a table of a few rows has one partition, so that what follows needs no shuffle."""
    out = kept(df, f"jaccard-{name}")
    few = out.coalesce(1) if out.count() <= FEW else out
    few.kept_path = out.kept_path
    return few


def classes(docs: DataFrame, width: int) -> DataFrame:
    """id, key, n (size of the set), class. docs: id, text, key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in in_steps(b.column(1)):
                sets = sets_of(part, width)
                ids, keys = (b.column(i).slice(at, len(part)) for i in (0, 2))
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(map(len, sets), pa.int64()), pa.array(map(_class, sets), pa.int64())], names=["id", "key", "n", "class"])

    return docs.mapInArrow(run, "id long, key long, n long, class long")


def _chosen(docs: DataFrame, keys: DataFrame, width: int, what, schema: str, fold=None) -> DataFrame:
    """``what(classes, sets)``, as arrays for the columns of ``schema``, for the rows that a bit table of ``keys`` holds. fold: makes one row set of those of a batch."""
    held_keys = docs.sparkSession.sparkContext.broadcast(table(keys))
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(held(held_keys.value, b.column(1).to_numpy(zero_copy_only=False))))
            own = []
            for _, part in in_steps(b.column(0)):
                sets = sets_of(part, width)
                out = what(np.fromiter(map(_class, sets), np.int64, len(sets)), sets)
                if fold:
                    own.append(out)
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in fold(*map(np.concatenate, zip(*own, strict=True)))], names=names)

    return docs.select("text", "key").mapInArrow(run, schema)


def _ends(mark: np.ndarray, cls: np.ndarray) -> list[np.ndarray]:
    """Each mark once, with its least and its greatest class."""
    order = np.lexsort((cls, mark))
    mark, cls = mark[order], cls[order]
    first = np.flatnonzero(np.append(True, mark[1:] != mark[:-1])) if len(mark) else order
    return [mark[first], cls[first], cls[np.append(first[1:], len(mark)) - 1] if len(mark) else cls]


def _regions(docs: DataFrame, named: DataFrame, width: int, scheme: Scheme) -> DataFrame:
    """region, class: every signature that several classes have, with those classes."""
    spark = docs.sparkSession

    def marked(classes: np.ndarray, sets: list[np.ndarray]) -> list[np.ndarray]:
        marks = [scheme.signatures(s) for s in sets]
        return [np.concatenate([*marks, np.zeros(0, np.uint64)]).view(np.int64), np.repeat(classes, list(map(len, marks)))]

    # A class is to count once here: of a group of copies, one row speaks, and only rows that the table can't tell from it.
    # Signatures are summed up in each batch; most are of one class, so sums over a whole map task would be a table of all of them.
    found = _chosen(docs, named.select("key"), width, marked, "region long, low long, high long", _ends).repartition("region")
    shared = kept(found.groupBy("region").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("region"), "jaccard-shared")
    settle(spark)
    bits = spark.sparkContext.broadcast(table(shared))

    def held_only(classes: np.ndarray, sets: list[np.ndarray]) -> list[np.ndarray]:
        mark, cls = marked(classes, sets)
        there = held(bits.value, mark)
        return [mark[there], cls[there]]

    return kept(_chosen(docs, named.select("key"), width, held_only, "region long, class long").join(shared, "region").distinct(), "jaccard-spread")


def _sets(docs: DataFrame, named: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """class, set for the classes in ``wanted``."""

    def what(classes: np.ndarray, sets: list[np.ndarray]) -> list:
        return [classes, _lists(sets)]

    found = _chosen(docs, named.join(wanted, "class").select("key"), width, what, "class long, set array<long>")
    return kept(found.join(wanted, "class", "left_semi").dropDuplicates(["class"]), "jaccard-sets")


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    places = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)))


def _gathered(spread: DataFrame, order: DataFrame) -> DataFrame:
    """region, class: signature regions merged by pivot, which names the region.

    A class's hub is the leading class of most of its regions; a region's pivot is the hub
    of over half of its classes, or else the class that leads it.
    """
    best = lambda c, *by: F.max_by(c, F.struct(*by, c))
    led = kept(spread.join(order, "class").groupBy("region").agg(F.count("*").alias("size"), best("class", "degree").alias("lead")), "jaccard-led")
    hubs = spread.join(led, "region").groupBy("class", "lead").agg(F.count("*").alias("n")).groupBy("class").agg(best("lead", "n").alias("hub"))
    most = spread.join(hubs, "class").groupBy("region", "hub").agg(F.count("*").alias("n")).groupBy("region").agg(best("hub", "n").alias("hub"), F.max("n").alias("n"))
    pivot = led.join(most, "region").select("region", F.when(2 * F.col("n") > F.col("size"), F.col("hub")).otherwise(F.col("lead")).alias("pivot"))
    return spread.join(pivot, "region").select(F.col("pivot").alias("region"), "class").distinct()


def _second(regions: DataFrame, first: DataFrame, percent: int) -> DataFrame:
    """region, a, b: members of large regions with a second pivot, outside the window of the first. first: region, a, b, far."""
    outside = first.where(F.col("far") > 2 * (1 - percent / 100))
    chosen = outside.groupBy("region").agg(F.max_by("b", F.struct(F.xxhash64("b"), "b")).alias("a"))
    sizes = regions.groupBy("region").agg(F.count("*").alias("size")).where(F.col("size") > HOT).select("region")
    return regions.join(chosen.join(sizes, "region"), "region").select("region", "a", F.col("class").alias("b")).where("a <> b")


def _paired(pairs: DataFrame, sets: DataFrame, what, schema: str) -> DataFrame:
    """``what(row, set of a, set of b)`` of each pair of classes a and b, as rows of ``schema``; row has the pair's long columns.

    A class a of many pairs is dealt over as many tasks as they need. Pairs are sent to the
    sets, ``PAIRS`` at a time, so that only sets in pairs are shuffled, and only those of so
    many pairs lie on disk at once, however many there are. made_of: tables that may go once
    the result is kept.
    """
    held_pairs = kept(pairs, "jaccard-pairs")
    n = held_pairs.count()
    turns, out, done = max(1, -(-n // PAIRS)), None, [held_pairs]
    pairs = held_pairs.coalesce(1) if n <= FEW else held_pairs
    for turn in range(turns):
        part = _put_together(pairs if turns == 1 else pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(turns)) == turn), sets, what, schema)
        if turns > 1:
            part = kept(part, "jaccard-turn")
            done.append(part)
            settle(part.sparkSession)
        out = part if out is None else out.unionByName(part)
    out.made_of = done
    return out


def _made(paired: DataFrame, name: str) -> DataFrame:
    """As :func:`_kept`, for what :func:`_paired` returns."""
    out = _kept(paired, name)
    discard(*paired.made_of)
    return out


def _put_together(pairs: DataFrame, sets: DataFrame, what, schema: str) -> DataFrame:
    plain = pairs.columns
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    deals = F.ceil(F.col("n") / DEAL).cast("int")
    left = pairs.join(many.where(f"n > {DEAL}").select("a", deals.alias("deals")), "a", "left")
    left = F.broadcast(left.withColumn("deal", F.coalesce(F.pmod(F.xxhash64("b"), F.col("deals")).cast("int"), F.lit(0)))).join(sets.select(F.col("class").alias("b"), F.col("set").alias("sb")), "b")
    right = F.broadcast(many.select("a", F.explode(F.sequence(F.lit(0), deals - 1)).alias("deal"))).join(sets.select(F.col("class").alias("a"), F.col("set").alias("sa")), "a")
    rows = left.join(right, ["a", "deal"]).select(*plain, "sa", "sb")
    names = [f.split(" ")[0] for f in schema.split(", ")]
    n = len(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                row = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(n)], axis=1)
                out = [np.array(what(r, x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)), np.int64).reshape(-1, len(names)) for r, x, y in zip(row, b.column(n), b.column(n + 1), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(col) for col in np.concatenate(out).T], names=names)

    return rows.mapInArrow(run, schema)


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """region, a, b, shared, whole (sizes of intersection and union) of each pair."""

    def sizes(row: np.ndarray, p: np.ndarray, s: np.ndarray) -> list[int]:
        shared = len(np.intersect1d(p, s, assume_unique=True))
        return [*row, shared, len(p) + len(s) - shared]

    return _paired(pairs, sets, sizes, "region long, a long, b long, shared long, whole long")


def _windows(measured: DataFrame, percent: int) -> DataFrame:
    """region, a, b, home: members of each pivot's Voronoi region (home = 1) and of the window around it. measured: region, a, b, far."""
    own = measured.select("region", "a", F.col("a").alias("b"), F.lit(0.0).alias("far")).distinct()
    near = measured.unionByName(own).groupBy("region", "b").agg(F.min("far").alias("near"))
    return measured.join(near, ["region", "b"]).where(F.col("far") <= F.col("near") + 2 * (1 - percent / 100) + 1e-9).select("region", "a", "b", (F.col("far") <= F.col("near")).cast("long").alias("home"))


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The leading elements of the differences of members b to a pivot a.

    region (of that element), frame (region and pivot), class, home, n (size of the set), d
    (of the difference), linked (to the pivot), outer, inner (leading elements that the
    member shows as the outer and as the inner of a pair), near (1 if the element is one of
    the latter). Two members of different components aren't both linked to the pivot. One
    that isn't is the outer one of a pair, in full; the inner one is linked, or not and
    nearer. What an outer member must differ from the pivot in leaves the inner one about
    half of its difference to miss in.
    """

    def lead(row: np.ndarray, p: np.ndarray, s: np.ndarray) -> np.ndarray:
        region, a, b, home = row
        bound = most_differ(len(s) + len(s) * 100 // percent, percent)
        d = np.concatenate([np.setdiff1d(s, p, assume_unique=True), np.setdiff1d(p, s, assume_unique=True)])
        whole = (len(p) + len(s) + len(d)) // 2
        linked = 100 * (whole - len(d)) >= percent * whole
        agree = -(-(1 + len(d) + ((len(p) - len(s)) * (100 - percent)) // (100 + percent)) // 2)
        inner = max(0, len(d) - agree + 1)
        outer = 0 if linked else bound + 1
        inner = inner if linked else min(inner, bound // 2 + 1)
        own = d[: max(inner, outer)]
        frame = mixed(mixed(np.array([region]).view(np.uint64)) ^ np.array([a]).view(np.uint64))
        fixed = [np.full(len(own), x) for x in (frame.view(np.int64)[0], b, home, len(s), len(d), linked, outer, inner)]
        return np.stack([mixed(own ^ frame).view(np.int64), *fixed, np.arange(len(own)) < inner], axis=1)

    return _paired(pairs.select("region", "a", "b", "home"), sets, lead, "region long, frame long, class long, home long, n long, d long, linked long, outer long, inner long, near long")


def most_differ(sizes: int, percent: int) -> int:
    """Most elements in which linked sets of these sizes together differ."""
    return sizes * (100 - percent) // (100 + percent)


def _labelled(rows: DataFrame, labels: DataFrame | None, cls: str = "class") -> DataFrame:
    """``rows`` with the component of the class in ``cls``: itself where nothing links it yet."""
    if labels is None:
        return rows.withColumn("component", F.col(cls))
    return rows.join(labels.withColumnRenamed("class", cls), cls, "left").withColumn("component", F.coalesce("component", cls))


def _open(rows: DataFrame) -> DataFrame:
    """Regions with several components."""
    return rows.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("region")


def _candidates(placed: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of different components in small regions that share as many leading elements as a link needs."""
    x, y = placed.where("linked = 0").alias("x"), placed.where("near = 1").alias("y")
    met = x.join(y, "region").where("x.component <> y.component and x.home + y.home > 0 and (y.linked = 1 or x.d > y.d or (x.d = y.d and x.class > y.class)) and 100 * least(x.n, y.n) >= %d * greatest(x.n, y.n)" % percent)
    both = F.expr(f"(x.n + y.n) * {100 - percent} div {100 + percent}")
    agree = F.ceil((F.col("x.d") + F.col("y.d") - both) / 2)
    hidden = F.greatest(F.col("x.d") - F.col("x.outer"), F.col("y.d") - F.col("y.inner"), F.lit(0))
    count = met.groupBy("x.frame", F.col("x.class").alias("a"), F.col("y.class").alias("b")).agg(F.count("*").alias("met"), F.first(agree - hidden).alias("needed"))
    return count.where("met >= needed").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """class, component of linked classes: the least class by minimum labels and pointer jumps."""
    both = _kept(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = _kept(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("class"), F.least("a", "b").alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("class", "b"), "b").groupBy(F.col("a").alias("class")).agg(F.min("component").alias("heard"))
        near = labels.join(heard, "class").select("class", F.least("component", "heard").alias("near"), F.col("component").alias("was"))
        jump = labels.select(F.col("class").alias("near"), F.col("component").alias("far"))
        new = _kept(near.join(jump, "near", "left").select("class", "was", F.least("near", F.coalesce("far", "near")).alias("component")), "labels")
        if new.where("was <> component").isEmpty():
            return new.select("class", "component")
        labels = new.select("class", "component")


def _links(docs: DataFrame, named: DataFrame, width: int, percent: int) -> DataFrame | None:
    """class, component of all linked classes, or None without any."""
    scheme = Scheme(percent)
    if percent == 100:  # equal sets are one class
        return None
    spread = _regions(docs, named, width, scheme)
    sizes = spread.groupBy("region").agg(F.count("*").alias("size"))
    order = _kept(spread.join(sizes, "region").groupBy("class").agg(F.sum("size").alias("degree")), "order")
    sets = _sets(docs, named, order.select("class"), width)
    linked = 100 * F.col("shared") >= percent * F.col("whole")
    regions = _kept(_gathered(spread, order), "regions")
    discard(spread)
    settle(docs.sparkSession)
    labels = None

    def add(more: DataFrame) -> None:
        """Joins the components of linked pairs."""
        nonlocal labels
        ends = _labelled(_labelled(more, labels, "a").withColumnRenamed("component", "x"), labels, "b")
        apart = _kept(ends.where("x <> component").select(F.col("x").alias("a"), F.col("component").alias("b")).distinct(), "links")
        if apart.isEmpty():
            return
        new = components(apart)
        if labels is not None:
            moved = labels.join(new.select(F.col("class").alias("component"), F.col("component").alias("to")), "component", "left").select("class", F.coalesce("to", "component").alias("component"))
            new = _kept(moved.unionByName(new.join(labels, "class", "left_anti")), "labels")
        labels = new

    far = (1 - F.col("shared") / F.col("whole")).alias("far")
    size, last = regions.count(), False
    while size:
        first = _made(_measured(regions.select("region", F.col("region").alias("a"), F.col("class").alias("b")).where("a <> b"), sets), "measured")
        second = _made(_measured(_second(regions, first.select("region", "a", "b", far), percent), sets), "measured")
        add(first.unionByName(second).where(linked).select("a", "b"))
        settle(docs.sparkSession)
        windows = _kept(_windows(first.unionByName(second).select("region", "a", "b", far), percent), "windows")
        members = windows.select("region", F.col("b").alias("class")).unionByName(windows.select("region", F.col("a").alias("class"))).distinct()
        differences = _differences(windows.join(_open(_labelled(members, labels)), "region"), sets, percent)
        rest = _kept(_labelled(differences, labels), "differences")
        discard(*differences.made_of)
        settle(docs.sparkSession)
        inner, outer = F.sum("near").alias("inners"), F.sum(1 - F.col("linked")).alias("outers")
        shared = rest.groupBy("region").agg(inner, outer, F.max("home").alias("some"), F.min("component").alias("low"), F.max("component").alias("high"))
        shared = shared.where("low < high and inners > 0 and outers > 0 and some = 1").select("region", F.least("inners", "outers").alias("size"))
        placed = _kept(rest.join(shared, "region"), "members")
        discard(rest, windows, first, second)
        small = placed if last else placed.where(F.col("size") <= SMALL)
        found = _kept(_candidates(small, percent).select(F.lit(0).cast("long").alias("region"), "a", "b"), "candidates")
        add(_measured(found, sets).where(linked).select("a", "b"))
        if last:
            discard(placed)
            break
        large = _labelled(placed.where(F.col("size") > SMALL).select("region", "class"), labels)
        own = large.join(_open(large), "region").join(order, "class")
        pivots = own.groupBy("region").agg(F.max_by("class", F.struct("degree", "class")).alias("pivot"))
        regions = _kept(own.join(pivots, "region").select(F.col("pivot").alias("region"), "class").distinct(), "regions")
        discard(placed)
        before, size = size, regions.count()
        last = 4 * size > before
    discard(sets, order)
    return labels


def join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """id, key (xxhash64 of id and text), n, class, group, component. docs: id, text.

    group is the least class that links lead to, 0 for the empty set; component is the
    group's least id, and an empty set's own.
    """
    docs = docs.select("id", "text", F.xxhash64("id", "text").alias("key"))
    own = kept(classes(docs, width), "jaccard-classes")
    named = own.where("class <> 0").groupBy("class").agg(F.min("key").alias("key"), F.min("id").alias("id"))
    whole = _labelled(named.select("class", "id"), _links(docs, named, width, percent))
    least = whole.groupBy("component").agg(F.min("id").alias("least"))
    final = whole.join(least, "component").select("class", F.col("component").alias("group"), "least")
    component = F.when(F.col("class") == 0, F.col("id")).otherwise(F.col("least"))
    return own.join(final, "class", "left").select("id", "key", "n", "class", F.coalesce("group", F.lit(0).cast("long")).alias("group"), component.alias("component"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked texts: that with the least id (null last; of equal ids, the least hash of id and text).

    Rows of one id and text are one document, of which the row with the least hash of all
    columns stays. Texts without words are groups of their own and all stay.
    """
    key = fresh("key", docs.columns)
    found = kept(join(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), width, percent).where("group <> 0").select("id", "key", "group"), "jaccard-found")
    stays = found.groupBy("group").agg(F.count("*").alias("rows"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))["key"].alias("stays")).where("rows > 1")
    gone = found.join(stays, "group").where("key <> stays").select(F.col("key").alias(key)).distinct()
    left = docs.withColumn(key, F.xxhash64(F.col(id), F.col(text))).join(gone, key, "left_anti")
    again = kept(found.groupBy("key").count().where("count > 1").select(F.col("key").alias(key)), "jaccard-again")
    if not again.isEmpty():
        row = F.struct(*docs.columns)
        first = left.join(again, key).groupBy(key).agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("row")).select("row.*")
        left = left.join(again, key, "left_anti").drop(key).unionByName(first)
    return left.select(*docs.columns)
