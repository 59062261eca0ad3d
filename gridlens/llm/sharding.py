"""Sharding by a k-d tree over document metadata.

The tree splits every node at a weighted median along its widest dimension
until each leaf holds about the target bytes; leaves are the shards. A row's
place along a dimension is a 63-bit key: 23 bits of the dimension (strings by
their first six UTF-8 bytes, numbers by value, both scaled to the range of
the whole table), then 20 bits of the text's crc32 and 20 bits of a hash of
doc_id. So a hot value is still split, and equal texts lie side by side.
Medians come from ``cuts.weighted_cuts``: nothing is sorted or gathered.

Defined cases: a null text weighs 16 bytes; a null in a dimension lies at the
dimension's lower end; repeated rows (same doc_id and text) share a key, so a
split never parts them; an empty table gives no rows. Columns of the input
other than those named are passed through by ``assign_shards``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.llm.common import materialize
from gridlens.llm.cuts import Cut, weighted_cuts

CODE_BITS, TIE_BITS = 23, 40
#: Largest number of leaves: bounds the split table that is broadcast (28 B a row).
MAX_LEAVES = 1_000_000
#: A cut may miss its median by this share of a leaf.
TOLERANCE = 0.002
#: Rows numbered in one task.
SLOT_ROWS = 100_000


@dataclass(frozen=True)
class Split:
    """Rows of ``node`` with key <= ``at`` along dimension ``dim`` go left."""

    node: int
    dim: int
    at: int
    left: int
    right: int


@dataclass(frozen=True)
class KdTree:
    dims: tuple[str, ...]
    lows: tuple[float, ...]
    highs: tuple[float, ...]
    levels: tuple[tuple[Split, ...], ...]
    leaves: dict[int, int]


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def _position(df: DataFrame, dim: str) -> Column:
    """An order-preserving double of a metadata column."""
    if isinstance(df.schema[dim].dataType, T.StringType):
        head = F.substring(F.encode(F.col(dim), "UTF-8"), 1, 6)
        return F.conv(F.rpad(F.hex(head), 12, "0"), 16, 10).cast("double")
    return F.col(dim).cast("double")


def _with_keys(df: DataFrame, dims: Sequence[str], lows: Sequence[float], highs: Sequence[float]) -> DataFrame:
    tie = (F.shiftleft(F.col("_crc").bitwiseAND(F.lit((1 << 20) - 1)), 20)
           .bitwiseOR(F.xxhash64(F.col("doc_id")).bitwiseAND(F.lit((1 << 20) - 1))))
    out = {}
    for i, (d, lo, hi) in enumerate(zip(dims, lows, highs)):
        span = (hi - lo) or 1.0
        at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (_position(df, d) - F.lit(lo)) / F.lit(span)))
        code = F.floor(F.coalesce(F.nanvl(at, F.lit(0.0)), F.lit(0.0)) * F.lit(float((1 << CODE_BITS) - 1)))
        out[f"_key{i}"] = F.shiftleft(code.cast("long"), TIE_BITS).bitwiseOR(tie)
    return df.withColumns(out)


def _key_of(n_dims: int, dim: Column) -> Column:
    pick = F.col(f"_key{n_dims - 1}")
    for i in reversed(range(n_dims - 1)):
        pick = F.when(dim == i, F.col(f"_key{i}")).otherwise(pick)
    return pick


_SPLITS = T.StructType([T.StructField(n, t) for n, t in (
    ("_node", T.LongType()), ("_dim", T.IntegerType()), ("_at", T.LongType()),
    ("_left", T.LongType()), ("_right", T.LongType()))])


def _descend(df: DataFrame, splits: Sequence[Split], n_dims: int) -> DataFrame:
    """Move rows from the nodes split at one level to their children."""
    if len(splits) == 1:  # the root: no table is needed
        s = splits[0]
        inside = F.when(F.col(f"_key{s.dim}") <= s.at, F.lit(s.left)).otherwise(F.lit(s.right))
        return df.withColumn("_node", F.when(F.col("_node") == s.node, inside.cast("long")).otherwise(F.col("_node")))
    table = df.sparkSession.createDataFrame([(s.node, s.dim, s.at, s.left, s.right) for s in splits], _SPLITS)
    inside = F.when(_key_of(n_dims, F.col("_dim")) <= F.col("_at"), F.col("_left")).otherwise(F.col("_right"))
    return (df.join(F.broadcast(table), "_node", "left")
            .withColumn("_node", F.when(F.col("_dim").isNull(), F.col("_node")).otherwise(inside))
            .drop("_dim", "_at", "_left", "_right"))


def fit_kd_tree(docs: DataFrame, dims: Sequence[str] = ("source", "lang", "size", "doc_id"),
                target_bytes: int | None = None, n_shards: int | None = None) -> KdTree | None:
    """Tree whose leaves weigh about ``target_bytes`` each, or ``n_shards``
    leaves of equal weight. ``size`` among the dims is the byte size. None
    for an empty table."""
    dims = tuple(dims)
    base = docs.select("doc_id", size_bytes(F.col("text")).alias("_size"), text_crc(F.col("text")).alias("_crc"),
                       *[(size_bytes(F.col("text")) if d == "size" else F.col(d)).alias(f"_d{i}")
                         for i, d in enumerate(dims)])
    base = materialize(base, "kd-meta")
    named = [f"_d{i}" for i in range(len(dims))]
    total = base.agg(F.sum("_size").alias("w"), *[f(F.nanvl(_position(base, c), F.lit(None))).alias(f"{n}{c}")
                                                for c in named for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if total["w"] is None:
        return None
    lows = tuple(float(total[f"lo{c}"] or 0.0) for c in named)
    highs = tuple(float(total[f"hi{c}"] or 0.0) for c in named)
    n_leaves = n_shards or max(1, math.ceil(total["w"] / target_bytes))
    if n_leaves > MAX_LEAVES:
        raise ValueError(f"{n_leaves} leaves; raise target_bytes (at most {MAX_LEAVES})")
    keyed = _with_keys(base.withColumn("_node", F.lit(1).cast("long")), named, lows, highs)
    rows = materialize(keyed.select("_node", "_size", *[f"_key{i}" for i in range(len(dims))]), "kd-keys")
    share, levels, leaves = {1: n_leaves}, [], {}
    while any(k > 1 for k in share.values()):
        stats = rows.groupBy("_node").agg(F.sum("_size").alias("w"), *[
            f(f"_key{i}").alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("lo", F.min), ("hi", F.max))])
        at_node = {r["_node"]: r for r in stats.collect()}  # one row per node: at most n_leaves
        cuts, widest = {}, {}
        for node, k in share.items():
            if k > 1:
                r = at_node.get(node)
                dim = 0 if r is None else max(range(len(dims)), key=lambda i: r[f"hi{i}"] - r[f"lo{i}"])
                widest[node] = dim
                weight = 0 if r is None else r["w"]
                lo, hi = (0, 0) if r is None else (r[f"lo{dim}"], r[f"hi{dim}"])
                cuts[node] = Cut(lo, hi, weight * (k // 2) / k, TOLERANCE * weight / k)
        wide = rows.sparkSession.createDataFrame(list(widest.items()), "_node long, _dim int")
        along = rows.join(F.broadcast(wide), "_node").select(
            "_node", _key_of(len(dims), F.col("_dim")).alias("_key"), "_size")
        at = weighted_cuts(along, "_node", "_key", "_size", cuts)
        splits = tuple(Split(n, widest[n], at[n], 2 * n, 2 * n + 1) for n in cuts)
        levels.append(splits)
        rows = _descend(rows, splits, len(dims))
        if len(levels) % 4 == 0:
            rows = materialize(rows, "kd-nodes")
        share = {n: k for n, k in share.items() if k == 1} | {
            c: j for n in cuts for c, j in ((2 * n, share[n] // 2), (2 * n + 1, share[n] - share[n] // 2))}
    order = sorted(share, key=lambda n: n << (64 - n.bit_length()))  # left to right
    leaves = {n: i for i, n in enumerate(order)}
    return KdTree(dims, lows, highs, tuple(levels), leaves)


def assign_shards(docs: DataFrame, tree: KdTree | None, shard_col: str = "shard") -> DataFrame:
    """All input columns and the shard of each row, without a shuffle: the
    splits of each level are a broadcast table of at most MAX_LEAVES rows."""
    if tree is None:
        return docs.withColumn(shard_col, F.lit(0).cast("int"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != shard_col]
    own = F.struct(*keep).alias("_row")
    df = docs.select(own, "doc_id", text_crc(F.col("text")).alias("_crc"),
                     *[(size_bytes(F.col("text")) if d == "size" else F.col(d)).alias(f"_d{i}")
                       for i, d in enumerate(tree.dims)], F.lit(1).cast("long").alias("_node"))
    named = [f"_d{i}" for i in range(len(tree.dims))]
    df = _with_keys(df, named, tree.lows, tree.highs).select(
        "_row", "_node", *[f"_key{i}" for i in range(len(named))])
    for splits in tree.levels:
        df = _descend(df, splits, len(named))
    ids = df.sparkSession.createDataFrame(list(tree.leaves.items()), f"_node long, {'_shard'} int")
    return df.join(F.broadcast(ids), "_node").select("_row.*", F.col("_shard").alias(shard_col))


def number_slots(df: DataFrame, shard_col: str, order: Sequence[str], n_rows: int, n_shards: int) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard: shards are cut into
    hashed parts of about SLOT_ROWS rows, numbered part by part."""
    parts = max(1, math.ceil(n_rows / max(1, n_shards) / SLOT_ROWS))
    df = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = Window.partitionBy(shard_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (df.groupBy(shard_col, "_part").agg(F.count("*").alias("_n"))
               .select(shard_col, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    rank = F.row_number().over(Window.partitionBy(shard_col, "_part").orderBy(*order))
    return (df.withColumn("_rank", rank).join(offsets, [shard_col, "_part"])
            .withColumn("slot", (F.col("_first") + F.col("_rank") - 1).cast("long"))
            .drop("_part", "_rank", "_first"))
