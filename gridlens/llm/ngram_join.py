"""N-gram Jaccard join: a size-aware heavy-light join on shingle sets.

Two documents link when 100 * |A & B| >= threshold * |A | B|. Documents with
equal sets form one class and are joined as one. Below a boundary size a set
is *light*, else *heavy*; the boundary is the size at which the estimated
rows and set elements handled are fewest.

Light pairs: for sets of sizes s <= t the threshold is a common subset of
c(s, t) elements, so each light set enumerates its subsets of exactly those
sizes (as hashes), and all sets that meet in a subset link. Nothing needs to
be compared, and a star to one of the smaller sets links them all.

Pairs with a heavy set: the documents holding each element are counted over
the whole table (``chunks.exchange_keys``), elements are ordered rarest first,
and each set is put into the inverted lists of its first
s - ceil(threshold * s) + 1 elements: linked sets meet in one of them. An
element no second document holds has no list. Lists are scanned twice.

1. Each member is compared to its list's first class only.
2. In lists that still hold several components, members outside the largest
   component are compared to all others, in blocks of ``BLOCK`` members, so a
   hot list becomes many tasks whose number grows with the outsiders, not
   with the square of the list.

A comparison is first tried on sizes and 1,024 parity bits, whose difference
never exceeds the sets' difference; what passes is counted on whole sets.
No pair inside a class or a component is ever formed.

Defined cases: words are lowered in A-Z; a text with one or two words has its
whole sequence as the only shingle; a null or empty text has none and links
with nothing; rows are told apart by a number of their own, so a null doc_id
links like any other but never names a component (one of such rows alone has a
null id), and different texts under one doc_id are joined each for itself;
repeated rows each get a row; an empty table gives no rows; other columns are
not returned. The number of a document's links is not given: pairs inside a
component that need not be checked are not counted. Shingles are 64-bit hashes, 48 bits of which
are kept for the comparison of two sets.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import chunks as CH
from gridlens.llm.common import combine, materialize, mix64, span_hashes, word_spans
from gridlens.llm.components import connected_components

#: Sets of this size or more are never light (subsets grow too many).
LIGHT_MOST = 40
BLOCK = 1024
#: Tasks that share the classes of one component when they are given its name.
SALTS = 16
PARITY_BITS = 1024
#: Weight of one element compared against one enumerated subset.
COMPARE_COST = 4.0
#: Bytes kept of an element in whole sets.
WIDTH = 6


def overlap(s, t, threshold: int):
    """Fewest common elements with which sets of sizes s and t link."""
    return -(-threshold * (s + t) // (100 + threshold))


def prefix_length(s: int, threshold: int) -> int:
    return s - -(-threshold * s // 100) + 1 if s else 0


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    out = []
    for i, j in CH.doc_blocks(off):
        part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, woff = word_spans(part, at)
        h = span_hashes(part, starts, ends, lower=True)
        m = max(0, len(h) - n + 1)
        every = combine(*[h[k:k + m] for k in range(n)]) if m else h[:0]
        for a, z in zip(woff[:-1], woff[1:]):
            if z - a >= n:
                x = np.sort(every[a:z - n + 1])
                out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
            elif z > a:  # the whole sequence, apart from shingles by its length
                out.append(mix64(combine(*h[a:z, None]) + np.uint64(z - a)))
            else:
                out.append(h[:0])
    return out


def _parity(x: np.ndarray) -> bytes:
    bits = np.bincount((x & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _fingerprint(x: np.ndarray) -> tuple[int, int]:
    one, two = mix64(x), mix64(x ^ np.uint64(0xD6E8FEB86659FD93))
    return (int(np.add.reduce(one, dtype=np.uint64).astype(np.int64)), int(np.add.reduce(two, dtype=np.uint64).astype(np.int64)))


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH]).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    full = np.zeros((len(raw) // WIDTH, 8), np.uint8)
    full[:, :WIDTH] = np.frombuffer(raw, np.uint8).reshape(-1, WIDTH)
    return full.reshape(-1).view("<u8")


def _counted(n: int):
    def keys(c: CH.Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
        elements, _, count = CH.distinct(np.concatenate([np.zeros(0, np.uint64), *shingle_sets(c.data, c.off, n)]))
        return [(elements, count)]
    return keys


def _total(kind, order, first, values):
    return np.minimum(np.add.reduceat(values[order].astype(np.int64), first), 1 << 31), 0, 0


_SETS = "doc_id long, n int, f1 long, f2 long, prefix array<bigint>, parity binary, elements binary"


def _described(n: int, threshold: int):
    """Per text: size, fingerprint, shared prefix elements, and if it has any
    (or is small) parity and whole set."""
    def describe(c: CH.Chunk, got: dict[int, np.ndarray]) -> pa.Table:
        sets = shingle_sets(c.data, c.off, n)
        elements, place, _ = CH.distinct(np.concatenate([np.zeros(0, np.uint64), *sets]))
        held = got[0][place] if len(elements) else place
        cols, a = {k.split()[0]: [] for k in _SETS.split(", ")[1:]}, 0
        for x in sets:
            often = held[a:a + len(x)]
            a += len(x)
            lead = np.argsort(often, kind="stable")[:prefix_length(len(x), threshold)]
            shared = x[lead][often[lead] > 1]
            row = (len(x), *_fingerprint(x), shared.view(np.int64), _parity(x) if len(shared) else None,
                   _packed(x) if len(shared) or len(x) < LIGHT_MOST else None)
            for k, v in zip(cols, row):
                cols[k].append(v)
        types = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.table({"doc_id": pa.array(c.ids, pa.int64(), mask=c.ids == -(1 << 63))}
                        | {k: pa.array(v, t) for (k, v), t in zip(cols.items(), types)})
    return describe


def by_group(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn`` on each group of equal long ``keys``. Groups are cut from sorted
    partitions, as most are a few rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, [None]):
            t = held if b is None else pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if t is None or not t.num_rows:
                continue
            new = np.zeros(t.num_rows, bool)
            for k in keys:
                v = t[k].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            edge = [0, *np.flatnonzero(new).tolist(), t.num_rows]
            if b is not None:
                held = t.slice(edge[-2])
                edge.pop()
            found = [fn(t.slice(x, y - x)) for x, y in itertools.pairwise(edge)]
            if found:
                yield from pa.concat_tables(found).combine_chunks().to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


# ---------------------------------------------------------------- light pairs
def subset_sizes(s: int, below: int, threshold: int) -> list[tuple[int, int, int]]:
    """(smaller, larger, subset size) of all linkable size pairs that ``s``
    is part of, both under ``below``."""
    out = []
    for t in range(1, below):
        a, b = min(s, t), max(s, t)
        c = overlap(a, b, threshold)
        if c <= a:
            out.append((a, b, c))
    return out


def choose_boundary(sizes: dict[int, int], threshold: int) -> int:
    """Boundary with the least cost: subsets enumerated by the sets below it,
    against list entries and elements compared by those from 0.9 of it up."""
    best, at = math.inf, 2
    for x in range(2, LIGHT_MOST + 1):
        light = sum(n * sum(math.comb(s, c) for _, _, c in subset_sizes(s, x, threshold)) for s, n in sizes.items() if s < x)
        heavy = sum(n * (prefix_length(s, threshold) + COMPARE_COST * s) for s, n in sizes.items() if 100 * s >= threshold * x)
        if light + heavy < best:
            best, at = light + heavy, x
    return at


@functools.lru_cache(maxsize=512)
def _left_out(s: int, r: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(s), r)), np.int64).reshape(math.comb(s, r), r)


def _light_links(classes: DataFrame, below: int, threshold: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rep, raw in zip(b.column("rep").to_pylist(), b.column("elements").to_pylist()):
                x = mix64(_unpacked(raw))
                total, cols = x.sum(dtype=np.uint64), ([], [], [])
                for a, z, c in subset_sizes(len(x), below, threshold):
                    keys = total - x[_left_out(len(x), len(x) - c)].sum(axis=1, dtype=np.uint64)
                    for col, v in zip(cols, (np.full(len(keys), a * 1000 + z), keys.view(np.int64),
                                             np.full(len(keys), len(x) == a))):
                        col.append(v)
                if cols[0]:
                    pair, key, smaller = (np.concatenate(c) for c in cols)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(pair.astype(np.int32)), pa.array(key), pa.array(np.full(len(key), rep)), pa.array(smaller)],
                        ["pair", "key", "rep", "smaller"])

    rows = classes.where((F.col("n") > 0) & (F.col("n") < below)).select("rep", "elements").mapInArrow(
        run, "pair int, key long, rep long, smaller boolean")
    centre = (rows.groupBy("pair", "key").agg(F.min(F.when(F.col("smaller"), F.col("rep"))).alias("a"), F.count("*").alias("m"))
              .where("a is not null and m > 1"))
    return rows.join(centre, ["pair", "key"]).where("a <> rep").select("a", F.col("rep").alias("b")).distinct()


# ---------------------------------------------------------------- heavy pairs
def _near(n1, n2, parity1, parity2, threshold: int) -> np.ndarray:
    """May the sets link, by sizes and parity bits? (broadcasting)"""
    most = n1 + n2 - 2 * overlap(n1, n2, threshold)  # largest difference of linked sets
    apart = np.bitwise_count(parity1 ^ parity2).sum(axis=-1)
    return (overlap(n1, n2, threshold) <= np.minimum(n1, n2)) & (apart <= most)


def _bits(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(-1, PARITY_BITS // 64)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    rows = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("elements").alias("eb")), "b")
            .join(sets.select(F.col("rep").alias("a"), F.col("elements").alias("ea")), "a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for ea, eb in zip(batch.column("ea"), batch.column("eb")):
                x, y = _unpacked(ea.as_py()), _unpacked(eb.as_py())
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(both >= overlap(len(x), len(y), threshold))
            m = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(m), batch.column("b").filter(m)], ["a", "b"])

    return rows.select("a", "b", "ea", "eb").mapInArrow(run, "a long, b long")


def _outsider_blocks(members: DataFrame) -> DataFrame:
    """Members (list, rep, component, ...) of lists with several components,
    once per block pair (``part``) they are compared in; ``inside`` marks the
    largest component of the list."""
    per = members.groupBy("list", "component").agg(F.count("*").alias("m"))
    top = per.groupBy("list").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("all"), F.count("*").alias("k"))
    top = top.where("k > 1").select("list", F.col("top.component").alias("_top"),
                                    F.ceil(F.col("top.m") / BLOCK).cast("int").alias("_in"),
                                    F.ceil((F.col("all") - F.col("top.m")) / BLOCK).cast("int").alias("_out"))
    rows = members.join(top, "list").withColumn("inside", F.col("component") == F.col("_top"))
    own = F.pmod(F.xxhash64("rep", "list"), F.when(F.col("inside"), F.col("_in")).otherwise(F.col("_out"))).cast("int")
    rows = rows.withColumn("_own", own)
    others = F.sequence(F.lit(0), F.col("_out") - 1)
    # inside blocks meet every outside block; outside blocks also meet each other
    meets = F.when(F.col("inside"), F.transform(others, lambda o: F.struct(F.col("_own").alias("i"), (-1 - o).alias("j")))).otherwise(
        F.concat(F.transform(F.sequence(F.lit(0), F.col("_in") - 1), lambda g: F.struct(g.alias("i"), (-1 - F.col("_own")).alias("j"))),
                 F.transform(others, lambda o: F.struct((-1 - F.greatest(o, F.col("_own"))).alias("i"), (-1 - F.least(o, F.col("_own"))).alias("j")))))
    return rows.withColumn("part", F.explode(meets)).select("list", "rep", "component", "inside", "n", "parity", "part.*")


_GROUP = ["list", "i", "j"]


def _survivors(rows: DataFrame, threshold: int) -> DataFrame:
    """Members with a possible partner in another component (sizes, parity)."""
    def run(t: pa.Table) -> pa.Table:
        n, comp = t["n"].to_numpy(), t["component"].to_numpy()
        bits, inside = _bits(t["parity"]), t["inside"].to_numpy(zero_copy_only=False)
        out = np.flatnonzero(~inside)
        hit = np.zeros(len(n), bool)
        for a in range(0, len(out), 16):
            k = out[a:a + 16]
            ok = (comp[k][:, None] != comp) & _near(n[k][:, None], n, bits[k][:, None], bits, threshold)
            hit |= ok.any(axis=0)
            hit[k] |= ok.any(axis=1)
        return t.select([*_GROUP, "rep", "component", "inside"]).filter(pa.array(hit))

    return by_group(rows, _GROUP, run, "list long, i int, j int, rep long, component long, inside boolean")


def _block_links(rows: DataFrame, threshold: int) -> DataFrame:
    """Links between components inside each block pair, by whole sets. A
    member stops being compared to a component once it is joined to it."""
    def run(t: pa.Table) -> pa.Table:
        rep, inside = t["rep"].to_numpy(), t["inside"].to_numpy(zero_copy_only=False)
        sets = [_unpacked(x) for x in t["elements"].to_pylist()]
        n = np.array([len(x) for x in sets])
        _, local = np.unique(np.concatenate(sets), return_inverse=True)
        start = np.cumsum(n) - n
        _, root = np.unique(t["component"].to_numpy(), return_inverse=True)
        mark, found = np.zeros(local.max() + 1, np.int32), []
        for k in np.flatnonzero(~inside):
            mark[local[start[k]:start[k] + n[k]]] = 1
            common = np.add.reduceat(mark[local], start)
            mark[local[start[k]:start[k] + n[k]]] = 0
            for j in np.flatnonzero((root != root[k]) & (common >= overlap(n[k], n, threshold))):
                if root[j] != root[k]:
                    found.append((rep[k], rep[j]))
                    root[root == root[j]] = root[k]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return by_group(rows, _GROUP, run, "a long, b long")


def join_components(docs: DataFrame, shingle: int = 3, threshold: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    texts = CH.chunk_table(docs, F.col("doc_id"), F.lit(0), "jaccard-chunks")
    counts = CH.exchange_keys(texts, _counted(shingle), [4], _total, CH.n_buckets(texts), "jaccard-counts")
    described = CH.with_answers(texts, counts, _described(shingle, threshold), _SETS).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(described, "jaccard-rows", codec="uncompressed")
    classes = materialize(
        rows.where("n > 0").groupBy("f1", "f2", "n").agg(
            F.min("row").alias("rep"), F.min("doc_id").alias("smallest"), F.first("prefix").alias("prefix"), F.first("parity").alias("parity"),
            F.first(F.when(F.col("n") < LIGHT_MOST, F.col("elements"))).alias("elements")),
        "jaccard-classes")
    whole = rows.where("elements is not null").select(F.col("row").alias("rep"), "elements")
    sizes = {r["n"]: r["m"] for r in classes.where(F.col("n") < 2 * LIGHT_MOST).groupBy("n").agg(F.count("*").alias("m")).collect()}
    boundary = choose_boundary(sizes, threshold)
    light = _light_links(classes, boundary, threshold)

    entries = (classes.where(100 * F.col("n") >= threshold * boundary)
               .select(F.explode("prefix").alias("e"), "rep"))
    lists = entries.groupBy("e").agg(F.count("*").alias("m"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who")).where("m > 1")
    lists = lists.groupBy("m", "who").agg(F.min("e").alias("e")).select("e")  # lists of the same members: one is enough
    members = entries.join(lists, "e").select(F.col("e").alias("list"), "rep")
    members = materialize(members.join(classes.select("rep", "n", "parity"), "rep"), "jaccard-lists")

    # 1: every member against its list's first class
    first = members.groupBy("list").agg(F.min("rep").alias("a"))
    centre = first.join(classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("parity_a")), "a")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(0, bool)
            if b.num_rows:
                ok = _near(b.column("n").to_numpy(), b.column("n_a").to_numpy(), _bits(b.column("parity")),
                           _bits(b.column("parity_a")), threshold)
            m = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(m), b.column("rep").filter(m)], ["a", "b"])

    star = (members.join(centre, "list").where("a <> rep").select("a", "rep", "n", "n_a", "parity", "parity_a")
            .mapInArrow(near, "a long, b long").distinct())
    star = materialize(star, "jaccard-star")
    ends = star.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    needed = materialize(whole.join(ends, "rep", "left_semi"), "jaccard-sets", codec="uncompressed")
    links = materialize(light.union(_verified(star, needed, threshold)).distinct(), "jaccard-links")
    parts = connected_components(links)

    # 2: lists that still hold several components
    labelled = (members.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("component", F.coalesce("component", "rep")))
    left = materialize(_survivors(_outsider_blocks(labelled), threshold), "jaccard-left")
    needed = materialize(whole.join(left.select("rep").distinct(), "rep", "left_semi"),
                         "jaccard-sets", codec="uncompressed")
    more = _block_links(left.join(needed, "rep").select(*_GROUP, "rep", "component", "inside", "elements"), threshold)
    links = materialize(links.union(more).distinct(), "jaccard-links")
    parts = connected_components(links)

    named = _named(classes.select("f1", "f2", "n", "rep", "smallest"), parts)
    return (rows.select("doc_id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("_component", "doc_id").alias("component_id")))


def _named(classes: DataFrame, parts: DataFrame) -> DataFrame:
    """(f1, f2, n, _component): the smallest doc_id of each class's component.
    A component may hold most classes: its name is joined by a salted key."""
    member = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    names = member.where("component is not null").groupBy("component").agg(F.min("smallest").alias("_name"))
    names = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    member = member.withColumn("_salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    return member.join(names, ["component", "_salt"], "left").select(
        "f1", "f2", "n", F.when(F.col("component").isNull(), F.col("smallest")).otherwise(F.col("_name")).alias("_component"))
