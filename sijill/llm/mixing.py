"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash. A source's target is met by taking each document
floor(target / size of the source) times and once more where its hash lies under the
source's threshold. The threshold comes from nested histograms: sizes are summed by
(source, leading bits of the hash), the bucket in which the budget runs out is found,
and only that bucket's documents are summed again by their next bits. Nothing is
sorted, and a source of any share of the rows is at most 4096 sums a level.

Defined cases: null text has size 0; a null source is a source, the last by order;
documents with one hash (the same doc_id, null included) are taken together; a source
without words has target 0 and none of its documents is taken; an empty table gives an
empty result; other columns are ignored by :func:`mix` and kept by :func:`repeat_taken`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, kept, word_count

#: Bits of the hash in all, and those that one histogram resolves.
BITS, STEP = 60, 12


def hash_of(key: Column) -> Column:
    """60 bits of the key's MD5: the same in any engine and on every run."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target.

    Weights repeat over the sources in code-point order, null last. ``share`` times all
    sizes is dealt out by weight; what exceeds ``most`` times a source's size is dealt
    again until no target is above. That fixed point is min(cap, rate * weight) with one
    rate, found by running sums over the sources in the order in which they reach their
    caps. There is a row a source here, never one a document.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    capped = total.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    full = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(share) * F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rate = left / F.sum("weight").over(full.rowsBetween(0, W.unboundedFollowing))
    rated = capped.withColumn("rate", rate)
    fits = F.min(F.when(F.col("rate") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "rate"))).over(W.partitionBy())
    return rated.select("source", "source_size", F.least("cap", F.coalesce(fits["rate"] * F.col("weight"), F.col("cap"))).alias("target"))


def thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """source, source_size, target, copies, below: hashes under ``below`` get one copy more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = kept(plan.withColumn("copies", whole).withColumn("budget", F.col("target") - whole * F.col("source_size")), "mix-plan")
    open_ = plan.select("source", F.lit(0).cast("long").alias("lead"), F.col("budget").alias("left"))
    done, shift = None, BITS
    while shift:
        shift -= STEP
        near = sizes.join(open_.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", shift + STEP) == F.col("lead")))
        sums = near.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high"), F.first("left").alias("left"), F.first("lead").alias("lead"))
        upto = F.sum("size").over(W.partitionBy("source").orderBy("bucket"))
        over = sums.withColumn("upto", upto).groupBy("source").agg(
            F.first("left").alias("left"),
            F.first("lead").alias("lead"),
            F.min(F.when(F.col("upto") > F.col("left"), F.struct("bucket", "upto", "size", "low", "high"))).alias("b"),
        )
        over = kept(over.select("source", F.col("lead").alias("was"), "left", F.col("b.bucket").alias("lead"), (F.col("left") - (F.col("b.upto") - F.col("b.size"))).alias("rest"), F.col("b.size").alias("size"), (F.col("b.low") == F.col("b.high")).alias("single")), "mix-level")
        # All of the bucket fits, or one hash is left in it: it is taken if that comes nearer to the target.
        ended = over.where(F.col("lead").isNull() | F.col("single") | F.lit(shift == 0)).select(
            "source",
            F.when(F.col("lead").isNull(), F.shiftleft(F.col("was") + 1, shift + STEP)).otherwise(F.shiftleft(F.col("lead") + (F.col("size") < 2 * F.col("rest")).cast("long"), shift)).alias("below"),
        )
        done = ended if done is None else done.unionByName(ended)
        open_ = over.where(F.col("lead").isNotNull() & ~F.col("single")).select("source", "lead", F.col("rest").alias("left"))
        if open_.isEmpty():
            break
    done = done.withColumnRenamed("source", "s")
    return plan.join(done, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "copies", F.when(F.col("source_size") > 0, F.coalesce("below", F.lit(0))).otherwise(0).alias("below"))


def _sized(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.select(key, "source", word_count(F.col("text")).alias("size"), hash_of(F.col(key)).alias("hash"))


def _limited(rows: DataFrame, limits: DataFrame, hashed: Column) -> tuple[DataFrame, str]:
    """``rows`` with their source's limits and times (how often a row is taken), in a struct of the name that is given back."""
    own = fresh("limits", rows.columns)
    source = fresh("limits_source", rows.columns)
    limits = limits.select(F.col("source").alias(source), F.struct(*(c for c in limits.columns if c != "source")).alias(own))
    joined = rows.join(limits, F.col("source").eqNullSafe(F.col(source))).drop(source)
    times = F.col(own)["copies"] + (hashed < F.col(own)["below"]).cast("long")
    return joined.withColumn(own, F.col(own).withField("times", times)), own


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    sizes = kept(_sized(docs), "mix-sizes")
    out, own = _limited(sizes, thresholds(sizes, targets(sizes, **options)), F.col("hash"))
    return out.select("doc_id", "size", f"{own}.source_size", f"{own}.target", (F.col("size") * F.col(own)["times"]).alias("taken"))


def repeat_taken(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, copies one after another."""
    sizes = kept(_sized(docs), "mix-sizes")
    out, own = _limited(docs, thresholds(sizes, targets(sizes, **options)), hash_of(F.col("doc_id")))
    copies = F.explode(F.array_repeat(F.lit(0), F.col(own)["times"].cast("int")))
    return out.where(F.col(own)["times"] > 0).withColumn(own, copies).select(*docs.columns)
