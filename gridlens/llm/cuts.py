"""Distributed weighted cuts: per group, the key up to which the rows' weight
comes nearest to a target. Used for k-d tree medians and order sampling.

Each round bins the keys still in doubt into equal ranges, sums the
weight per (group, bin) with map-side combine, and keeps the one bin in which
the running sum passes the target. No group is sorted or gathered; the driver
sees one row per group and round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bins of all groups together in a round; a group has 256 to 65,536.
ALL_BINS = 1 << 19
#: Most groups the driver holds a cut for (a few dozen bytes each).
MAX_GROUPS = 1_000_000


@dataclass
class Cut:
    """Search state of a group: keys in [lo, hi] are in doubt, those below
    ``lo`` weigh ``base``. When done, keys up to ``lo - 1`` are inside."""

    lo: int
    hi: int
    target: float
    tolerance: float
    base: float = 0.0

    def width(self, bins: int) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // bins))


_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("_cut_g", T.LongType()), ("_cut_lo", T.LongType()), ("_cut_hi", T.LongType()),
    ("_cut_width", T.LongType()), ("_cut_need", T.DoubleType()))])


def weighted_cuts(df: DataFrame, group: str, key: str, weight: str, cuts: dict[int, Cut]) -> dict[int, int]:
    """Largest key inside, per group of ``cuts``; ``df`` has the three named
    columns (group and key long, key >= 0). Rows of other groups are ignored;
    a group without rows gets its ``hi``. Equal keys are never split."""
    if len(cuts) > MAX_GROUPS:
        raise ValueError(f"{len(cuts)} groups; at most {MAX_GROUPS} can be cut at once")
    spark, found = df.sparkSession, {}
    rows = df.select(F.col(group).cast("long").alias("_cut_g"), F.col(key).alias("_cut_k"),
                     F.col(weight).cast("double").alias("_cut_w"))
    active = dict(cuts)
    while active:
        n_bins = max(256, min(65_536, ALL_BINS // len(active)))
        table = spark.createDataFrame(
            [(g, c.lo, c.hi, c.width(n_bins), c.target - c.base) for g, c in active.items()], _SCHEMA)
        bins = (rows.join(F.broadcast(table), "_cut_g")
                .where("_cut_k between _cut_lo and _cut_hi")
                .withColumn("_bin", F.expr("(_cut_k - _cut_lo) div _cut_width"))
                .groupBy("_cut_g", "_bin").agg(F.sum("_cut_w").alias("w"), F.first("_cut_need").alias("need")))
        upto = Window.partitionBy("_cut_g").orderBy("_bin")
        run = bins.withColumn("cum", F.sum("w").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        hit = (run.where("cum >= need").groupBy("_cut_g")
               .agg(F.min(F.struct("_bin", "w", "cum")).alias("h")).select("_cut_g", "h.*"))
        passed = {r["_cut_g"]: r for r in hit.collect()}
        still = {}
        for g, c in active.items():
            r = passed.get(g)
            if r is None:  # the target is beyond all rows
                found[g] = c.hi
                continue
            lo = c.lo + r["_bin"] * c.width(n_bins)
            hi = min(c.hi, lo + c.width(n_bins) - 1)
            base = c.base + r["cum"] - r["w"]
            if hi == lo or r["w"] <= c.tolerance:
                nearer_with = abs(base + r["w"] - c.target) <= abs(base - c.target)
                found[g] = hi if nearer_with else lo - 1
            else:
                still[g] = Cut(lo, hi, c.target, c.tolerance, base)
        active = still
    return found
