"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of the mix, held at ``max_repeat`` times the
source's size; what is cut off is shared again by weight. Every document gets
the whole copies its source's rate allows for certain. The rest of the target
is a fixed-size sample: a document with inclusion probability p and uniform
random u has rank (u / (1 - u)) / (p / (1 - p)), and the lowest ranks are
taken until their words come nearest to what is missing. Inclusion
probabilities grow with ``weight`` (scaled, at most 1). u is a hash of doc_id
and the seed, so reruns agree; the cut is found by ``cuts.weighted_cuts``
without sorting a source.

Defined cases: a null text has size 0 and is never counted; a null source is
a source of its own, last in order; rows repeating a doc_id share one rank
and are taken together; a source of size 0 has target 0; an empty table
gives no rows; other columns pass through, but for those named like a result
(``RESULTS``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import materialize, n_words
from gridlens.llm.cuts import Cut, weighted_cuts

#: Most sources the driver shares the mix among.
MAX_SOURCES = 1_000_000
RANK_BITS, TIE_BITS = 52, 10
RESULTS = ("_size", "_source_size", "_target", "_copies")


def share_targets(sizes: Sequence[int], weights: Sequence[float], total: float, max_repeat: float) -> list[float]:
    """Targets by weight, none above ``max_repeat`` times its size; the
    excess is shared again by weight among the rest."""
    targets, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        per = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if per * weights[i] > max_repeat * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = per * weights[i]
            break
        for i in full:
            targets[i] = float(max_repeat * sizes[i])
        left -= sum(targets[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def length_weight(size: Column) -> Column:
    """Default inclusion weight: longer documents are a little likelier."""
    return F.log(F.lit(2.0) + size)


def mix(docs: DataFrame, cycle: Sequence[float] = (3, 1, 2), total_share: float = 1.5, max_repeat: float = 2.0,
        weight: Callable[[Column], Column] = length_weight, seed: int = 7) -> DataFrame:
    """All rows and columns of ``docs`` with _size, _source_size, _target and
    _copies (how often the mix takes the row). Sources in code-point order,
    null last, weigh ``cycle`` repeating."""
    spark = docs.sparkSession
    size = n_words(F.col("text"))
    meta = materialize(docs.select("doc_id", "source", size.alias("_size")), "mix-sizes")
    per = meta.groupBy("source").agg(F.sum("_size").alias("n"), F.sum(
        F.col("_size") * weight(F.col("_size"))).alias("wn"))
    per = per.limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["n"] for r in per]
    targets = share_targets(sizes, [cycle[i % len(cycle)] for i in range(len(per))], total_share * sum(sizes), max_repeat)
    whole = [min(int(math.floor(t / s + 1e-12)), math.floor(max_repeat)) if s else 0 for t, s in zip(targets, sizes)]
    missing = [max(0.0, t - k * s) for t, k, s in zip(targets, whole, sizes)]

    def table(scale, cut):
        rows = [(r["source"], i, sizes[i], targets[i], whole[i], scale[i], cut[i]) for i, r in enumerate(per)]
        return F.broadcast(spark.createDataFrame(
            rows, "_src string, _i long, _source_size long, _target double, _whole int, _scale double, _cut long"))

    def ranked(df, scale, cut):
        """Add each row's source facts and its rank key."""
        t = table(scale, cut)
        df = df.join(t, df["source"].eqNullSafe(t["_src"])).drop("_src")
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
        p = F.least(F.lit(1.0), F.col("_scale") * weight(F.col("_size")))
        # q / (1 + q) orders as the odds ratio q does, within [0, 1]
        x, y = u * (1 - p), p * (1 - u)
        rank = F.when((p <= 0) | (x + y <= 0), F.when(p <= 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(x / (x + y))
        tie = F.xxhash64(F.lit(seed + 1), F.col("doc_id")).bitwiseAND(F.lit((1 << TIE_BITS) - 1))
        key = F.shiftleft(F.floor(rank * F.lit(float((1 << RANK_BITS) - 1))).cast("long"), TIE_BITS).bitwiseOR(tie)
        return df.withColumn("_p", p).withColumn("_rank", key)

    none = [-1] * len(per)
    scale = [m / r["wn"] if r["wn"] else 0.0 for m, r in zip(missing, per)]
    while per:  # documents whose probability reaches 1 are certain; scale the others up
        now = ranked(meta, scale, none).groupBy("_i").agg(
            F.sum(F.when(F.col("_p") >= 1, F.col("_size")).otherwise(0)).alias("certain"),
            F.sum(F.when(F.col("_p") < 1, F.col("_size") * weight(F.col("_size"))).otherwise(0.0)).alias("rest"))
        better = list(scale)
        for r in now.collect():
            i = r["_i"]
            if r["rest"] > 0 and missing[i] > r["certain"]:
                better[i] = max(scale[i], (missing[i] - r["certain"]) / r["rest"])
        if all(b <= s * (1 + 1e-9) for b, s in zip(better, scale)):
            break
        scale = better
    top = (1 << (RANK_BITS + TIE_BITS)) - 1
    cuts = {i: Cut(0, top, m, 0.0) for i, m in enumerate(missing) if m > 0}
    found = weighted_cuts(ranked(meta, scale, none).where("_size > 0"), "_i", "_rank", "_size", cuts) if cuts else {}
    cut = [found.get(i, -1) for i in range(len(per))]
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in RESULTS]).alias("_row")
    out = ranked(docs.select(own, "doc_id", "source", size.alias("_size")), scale, cut)
    copies = F.col("_whole") + F.when(F.col("_rank") <= F.col("_cut"), 1).otherwise(0)
    return out.withColumn("_copies", copies.cast("int")).select("_row.*", *RESULTS)
