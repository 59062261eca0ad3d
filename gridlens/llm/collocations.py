"""Phrase collocations by SETM: relations of occurrences, extended by joins.

Texts are lowered in A-Z and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``. Everything is counted per language (null:
``und``). Relation R_k holds the occurrences of frequent k-word phrases, sorted
by position, written once per k and deleted when R_{k+1} is there; the positions
of a chunk of texts run on over its words and skip one number at each piece
boundary, so two occurrences at adjacent numbers lie in one piece.

R_k is merge-joined with itself at adjacent positions: a pair of frequent
groups (prefix, suffix) is a group of k + 1 words. Each chunk sums its
groups, the sums are added over all chunks (group-count), groups of
``min_count`` or more are frequent and numbered, and R_{k+1} keeps the
occurrences of those (semi-join). A group is named by the numbers of its
prefix and suffix, a word by a 64-bit hash of language and word. A hot phrase
is one row a chunk in the count. Up to ``broadcast_most`` frequent groups of a
length are broadcast (8 bytes each); beyond, each chunk gets those among its own
groups by a shuffle join. Spark joins along prefix and suffix give the
phrases and the counts of their cuts.

Cutting a phrase of m words after k gives l = f(first k), r = f(rest) and
floor(1000 * a * n / (l * r)), in decimals of 38 digits (1000 * a * n must stay below 10^38).

Defined cases: a null or empty text has no words; nulls in other columns and
repeated rows count like others; words may be of any length; an empty table
(or no frequent phrase) gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.llm.chunks import squeeze, unsqueeze
from gridlens.llm.common import combine, discard, flat_text, long_span_hashes, materialize, n_parts, span_hashes, sub_batches, word_spans

#: Bytes of text in a chunk (one text at least).
CHUNK_BYTES = 2 << 20
MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
#: Most frequent groups of a length that are broadcast.
BROADCAST_MOST = 1 << 20

_PIECE = np.zeros(256, bool)
_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_BETWEEN = _PIECE.copy()
_BETWEEN[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: A row is a chunk: ``pos`` (ascending) and ``code`` of each occurrence, and the
#: ascending numbers ``ids`` of its distinct groups (the codes are places in it).
_RELATION = "chunk long, pos binary, code binary, ids binary"
#: Occurrences of all words, with hash ``key`` and count ``m`` of each distinct one;
#: ``words`` has their bytes between blanks, ``word_lang`` places in ``langs``.
_WORDS = ("chunk long, pos binary, code binary, key binary, m binary, words binary, word_lang binary, "
          "langs array<string>, totals array<bigint>")
_ASKED = "chunk long, one long, two long, m long"


def _occurrences(chunk: int, pos: np.ndarray, code: np.ndarray) -> dict:
    step = np.diff(pos, prepend=pos[:1]).astype(np.uint32)
    first = int(pos[0]) if len(pos) else 0
    return {"chunk": chunk, "pos": np.int64(first).tobytes() + squeeze(step), "code": squeeze(code.astype(np.uint32))}


def _positions(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[:8], np.int64)[0] + np.cumsum(unsqueeze(raw[8:], np.uint32), dtype=np.int64)


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one: a row may be some MB."""
    for i in range(b.num_rows):
        yield b.slice(i, 1).to_pylist()[0]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
             "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in text.split(", ")])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An occurrence of each distinct key (ascending), code and count."""
    _, first, code, m = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return first, code, m


def word_relation(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All word occurrences of ``docs`` (lang, text), the words and each language's total."""
    schema = _schema(_WORDS)

    def chunk_row(b: pa.RecordBatch, chunk: int) -> dict:
        data, off = flat_text(b.column("text"))
        starts, ends, woff = word_spans(data, off, _BETWEEN)
        codes = b.column("lang").dictionary_encode()
        langs, lang = codes.dictionary.to_pylist(), np.repeat(codes.indices.to_numpy(), np.diff(woff))
        salt = np.array([span_hashes(x, np.zeros(1, np.int64), np.array([len(x)]), False)[0] if len(x) else np.uint64(1)
                         for x in (np.frombuffer(v.encode(), np.uint8) for v in langs)], np.uint64)
        keys = combine(salt[lang], long_span_hashes(data, starts, ends, lower=True, limit=1 << 18))
        piece = np.searchsorted(np.flatnonzero(_PIECE[data]), starts)
        split = np.zeros(len(starts), bool)
        split[1:] = piece[1:] != piece[:-1]
        split[woff[:-1][np.diff(woff) > 0]] = True
        pos = np.arange(len(starts)) + np.cumsum(split)
        first, code, m = _groups(keys)
        totals = np.bincount(lang, minlength=len(langs)) if len(lang) else np.zeros(len(langs), np.int64)
        low = _LOWER[data].tobytes()
        words = np.frombuffer(b" ".join([low[a:z] for a, z in zip(starts[first].tolist(), ends[first].tolist())]), np.uint8)
        return _occurrences(chunk, pos, code) | {
            "key": keys[first].tobytes(), "m": squeeze(m.astype(np.uint32)), "words": squeeze(words),
            "word_lang": squeeze(lang[first].astype(np.uint32)), "langs": langs, "totals": totals.tolist()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        for whole in batches:
            for b in sub_batches(whole, "text", chunk_bytes):
                yield _batch([chunk_row(b, (part << 32) | made)], schema)
                made += 1

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return materialize(rows.mapInArrow(run, _WORDS), "setm-words", codec="uncompressed")


def _groups_of(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Position and code of a chunk's occurrences; count and name (one, two)
    of its distinct groups. Rows of words give words, those of R_k the pairs
    of occurrences at adjacent positions."""
    pos, code = _positions(r["pos"]), unsqueeze(r["code"], np.uint32)
    if "key" in r:
        key = np.frombuffer(r["key"], np.int64)
        return pos, code, unsqueeze(r["m"], np.uint32), key, np.zeros(len(key), np.int64)
    ids = np.frombuffer(r["ids"], np.int64)
    i = np.flatnonzero(pos[1:] == pos[:-1] + 1)
    first, group, m = _groups((code[i].astype(np.uint64) << np.uint64(32)) | code[i + 1])
    return pos[i], group, m, ids[code[i[first]]], ids[code[i[first] + 1]]


def _inputs(relation: DataFrame) -> DataFrame:
    return relation.select([c for c in ("chunk", "pos", "code", "key", "m", "ids") if c in relation.columns])


def _asked(relation: DataFrame, bits: int | None = None) -> DataFrame:
    """(chunk, one, two, m): a row per chunk and distinct group. With ``bits``,
    for numbers below 2^bits: (name, m), both numbers in one long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in _rows(b):
                _, _, m, one, two = _groups_of(r)
                m = m.astype(np.int64)
                if bits is not None:
                    name = (one << bits) | two
                    order = np.argsort(name)
                    yield pa.RecordBatch.from_arrays([pa.array(name[order]), pa.array(m[order])], ["name", "m"])
                    continue
                order = np.lexsort((two, one))  # like rows side by side: they compress
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(one), r["chunk"], np.int64)), pa.array(one[order]), pa.array(two[order]),
                    pa.array(m[order])], ["chunk", "one", "two", "m"])

    return _inputs(relation).mapInArrow(run, _ASKED if bits is None else "name long, m long")


def frequent_groups(relation: DataFrame, min_count: int, most: int, owners: bool = False,
                    dense: bool = False) -> tuple[DataFrame, bool]:
    """(one, two, a, id): the groups with ``a >= min_count`` occurrences over
    all chunks, numbered by (one, two); whether there are at most ``most``
    (then the numbers run from 0). ``owners`` adds one chunk that holds the group.
    ``dense``: the numbers in ``relation`` are below ``most``, so that a name of
    one long is shuffled in place of two."""
    sums = [F.sum("m").alias("a")] + ([F.min("chunk").alias("owner")] if owners else [])
    bits = most.bit_length() if dense and most.bit_length() <= 31 else None
    if bits is None:
        counts = _asked(relation).groupBy("one", "two").agg(*sums)
    else:
        counts = _asked(relation, bits).groupBy("name").agg(*sums).select(
            F.shiftright("name", bits).alias("one"), F.col("name").bitwiseAND(F.lit((1 << bits) - 1)).alias("two"), "a")
    found = materialize(counts.where(F.col("a") >= min_count), "setm-counts")
    few = found.count() <= most
    ordered = (found.coalesce(1) if few else found.repartitionByRange(n_parts(found.sparkSession), "one", "two"))
    ordered = ordered.sortWithinPartitions("one", "two").withColumn("id", F.monotonically_increasing_id())
    return materialize(ordered, "setm-frequent"), few


def semi_join(relation: DataFrame, frequent: DataFrame, small: bool, packed: bool) -> DataFrame:
    """R_{k+1}: the occurrences of frequent groups. ``small``: broadcast the
    groups' names, ``packed`` into one long each; else join them by shuffle."""
    schema = _schema(_RELATION)

    def keep(r: dict, ids_of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> dict:
        pos, code, _, one, two = _groups_of(r)
        ids = ids_of(one, two)  # -1: not frequent
        order = np.argsort(ids, kind="stable")[np.count_nonzero(ids < 0):]
        place = np.full(len(ids), -1, np.int64)
        place[order] = np.arange(len(order))
        at = place[code]
        return _occurrences(r["chunk"], pos[at >= 0], at[at >= 0]) | {"ids": ids[order].tobytes()}

    def search(names: np.ndarray, ids: np.ndarray | None, asked: np.ndarray) -> np.ndarray:
        if not len(names):
            return np.full(len(asked), -1, np.int64)
        at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
        return np.where(names[at] == asked, at if ids is None else ids[at], -1)

    def name(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (one << 32) | two if packed else one

    if small:
        t = frequent.select("one", "two").orderBy("id").toArrow()  # at most ``most`` rows
        shared = relation.sparkSession.sparkContext.broadcast(name(t["one"].to_numpy(), t["two"].to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in _rows(b):
                    yield _batch([keep(r, lambda one, two: search(shared.value, None, name(one, two)))], schema)

        return _inputs(relation).mapInArrow(run, _RELATION)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        one, two, ids = (right[c].to_numpy() for c in ("one", "two", "id"))
        order = np.lexsort((two, one))
        known = dict(zip(zip(one[order].tolist(), two[order].tolist()), ids[order].tolist()))
        return pa.Table.from_batches([_batch([keep(r, lambda one, two: np.array(
            [known.get(p, -1) for p in zip(one.tolist(), two.tolist())], np.int64))], schema) for r in left.to_pylist()])

    answers = _asked(relation).join(frequent, ["one", "two"]).select("chunk", "one", "two", "id")
    return _inputs(relation).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(meet, _RELATION)


def _frequent_words(relation: DataFrame, frequent: DataFrame, small: bool) -> DataFrame:
    """(id, lang, word, a), each word handed in by one chunk that holds it.
    ``small``: a chunk looks its words up in a broadcast first."""
    shared = None
    if small:
        t = frequent.select("one", "owner").orderBy("id").toArrow()  # at most ``broadcast_most`` rows, by ascending hash
        shared = relation.sparkSession.sparkContext.broadcast((t["one"].to_numpy(), t["owner"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in _rows(b):
                key = np.frombuffer(r["key"], np.int64)
                at = np.arange(len(key))
                if shared is not None:
                    names, owners = shared.value
                    place = np.minimum(np.searchsorted(names, key), max(0, len(names) - 1))
                    at = np.flatnonzero((names[place] == key) & (owners[place] == r["chunk"])) if len(names) else at[:0]
                words, langs = unsqueeze(r["words"], np.uint8).tobytes().split(b" "), unsqueeze(r["word_lang"], np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[at]), pa.array(np.full(len(at), r["chunk"], np.int64)),
                    pa.array([r["langs"][langs[i]] for i in at], pa.string()),
                    pa.array([words[i].decode("utf-8") for i in at], pa.string())], ["one", "owner", "lang", "word"])

    held = relation.select("chunk", "key", "words", "word_lang", "langs").mapInArrow(run, "one long, owner long, lang string, word string")
    return held.join(frequent, ["one", "owner"]).select("id", "lang", "word", "a")


def candidates(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, broadcast_most: int = BROADCAST_MOST,
               chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, phrase, m, a, n, ls, rs, inside) of every phrase of 2 to
    ``max_words`` words with ``a >= min_count``. ``ls[k - 1]``, ``rs[k - 1]``:
    counts of the cut after k words. ``inside``: a candidate one word longer
    holds it just as often (then one of any longer length that does, does too)."""
    relation = word_relation(docs, chunk_bytes)
    totals = (relation.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang"))
              .agg(F.sum("t.totals").alias("n")))
    totals = materialize(totals, "setm-totals")
    frequent, few = frequent_groups(relation, min_count, broadcast_most, owners=True)
    none = F.array().cast("array<bigint>")
    phrases = materialize(_frequent_words(relation, frequent, few).select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("tail"), "a", none.alias("ls"), none.alias("rs")), "setm-phrases")
    small, packed, found = few, False, None
    for m in range(2, max_words + 1):
        before, relation = relation, materialize(semi_join(relation, frequent, small, packed), f"setm-{m - 1}", codec="uncompressed")
        discard(before)  # all that is needed of it is written
        dense, packed = few, True
        frequent, few = frequent_groups(relation, min_count, broadcast_most, dense=dense)
        small = few and dense  # names are packed from numbers below ``broadcast_most``
        prefix = phrases.select(F.col("id").alias("one"), "lang", F.col("phrase").alias("_head"), F.col("a").alias("_l"), "ls")
        suffix = phrases.select(F.col("id").alias("two"), F.col("a").alias("_r"), "rs", "tail")
        longer = frequent.join(prefix, "one").join(suffix, "two").select(
            "id", "lang", F.concat_ws(" ", "_head", "tail").alias("phrase"), "tail", "a",
            F.concat("ls", F.array("_l")).alias("ls"), F.concat(F.array("_r"), "rs").alias("rs"))
        if m > 2:
            marked = _marked(phrases, frequent, m - 1)
            found = marked if found is None else found.union(marked)
        phrases = materialize(longer, "setm-phrases")
    last = phrases.select("lang", "phrase", F.lit(max_words).alias("m"), "a", "ls", "rs", F.lit(False).alias("inside"))
    return (last if found is None else found.union(last)).join(totals, "lang")


def _marked(phrases: DataFrame, longer: DataFrame, m: int) -> DataFrame:
    """``phrases`` of m words; ``inside``: a longer group has the same count."""
    holders = (longer.select(F.col("one").alias("id"), "a").union(longer.select(F.col("two").alias("id"), "a"))
               .distinct().withColumn("_held", F.lit(True)))
    return phrases.join(holders, ["id", "a"], "left").select(
        "lang", "phrase", F.lit(m).alias("m"), "a", "ls", "rs", F.coalesce("_held", F.lit(False)).alias("inside"))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 broadcast_most: int = BROADCAST_MOST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut): each language's first
    ``top`` candidates that no longer one holds as often, by score and ``a``
    descending, then phrase. The lowest-scoring cut counts, of equal ones the
    first."""
    found = candidates(docs, max_words, min_count, broadcast_most, chunk_bytes).where(~F.col("inside"))
    score = ("(cast(1000 as decimal(4,0)) * cast(a as decimal(19,0)) * cast(n as decimal(19,0))) div "
             "(cast(ls[i - 1] as decimal(19,0)) * cast(rs[i - 1] as decimal(19,0)))")
    found = found.withColumn("best", F.expr(
        f"array_min(transform(sequence(1, m - 1), i -> struct({score} as score, i as cut, ls[i - 1] as l, rs[i - 1] as r)))"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), F.asc("phrase"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"),
                    F.col("best.r").alias("r"), "n", F.col("best.score").cast("long").alias("score"),
                    F.col("best.cut").cast("long").alias("cut")))
