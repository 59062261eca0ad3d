"""Helpers the operators share: scratch tables, text columns as flat byte
arrays, and vectorised word hashing.

A *word* is a maximal run of bytes other than the six ASCII white-space
characters (``[^\\x20\\x09-\\x0D]+``). UTF-8 keeps those six out of every
multi-byte character, so splitting bytes equals splitting characters.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.session import shared_dir

WORD_RE = r"[^\x20\x09-\x0D]+"
SPACE_RE = r"[\x20\x09-\x0D]+"
#: Bytes of text a Python step holds as flat arrays at a time.
BLOCK_BYTES = 1 << 21


# ---------------------------------------------------------------- Spark side
def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{shared_dir(spark)}/gridlens-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts
    the lineage, so a lost executor costs no recomputation before here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` gave and nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), without Python."""
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(t) == 0, F.lit(0)).otherwise(
        F.size(F.split(t, SPACE_RE))).cast("long")


def n_parts(spark: SparkSession) -> int:
    """Partitions for an explicit exchange: what the session is set to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


# --------------------------------------------------------------- Arrow side
def flat_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n+1 offsets (a null is empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not (pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)):
        col = col.cast(pa.large_binary() if pa.types.is_binary(col.type) else pa.large_string())
    if col.null_count:
        col = col.fill_null("" if pa.types.is_large_string(col.type) else b"")
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def sub_batches(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` text bytes, one row at least."""
    if not batch.num_rows:
        return
    _, off = flat_text(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield batch.slice(i, j - i)
        i = j


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULT_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_table(lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    return mix64((codes + np.uint64(1)) * _MULT)


@functools.lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def table(m):
        p = np.full(1 << bits, m, np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)
    return table(_MULT), table(_MULT_INV)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(16, int(n).bit_length()))


def word_spans(data: np.ndarray, off: np.ndarray, between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the n+1 word offsets of the texts;
    ``between`` marks the bytes that are in no word."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    word = ~between[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | cut[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | cut[1:n]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each byte span (ASCII case folded if ``lower``): a
    polynomial over the bytes' random codes, from one prefix sum, mixed."""
    pw, inv = powers(len(data))
    acc = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_table(lower)[data] * pw[:len(data)], out=acc[1:])
    return mix64((acc[ends] - acc[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def long_span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, limit: int = BLOCK_BYTES) -> np.ndarray:
    """``span_hashes`` of ascending spans, taken in stretches of about
    ``limit`` bytes (one span at least): bounds the arrays of 8 bytes a byte."""
    out, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + limit, "right")))
        a = starts[i]
        out[i:j] = span_hashes(data[a:ends[j - 1]], starts[i:j] - a, ends[i:j] - a, lower)
        i = j
    return out


def hashed_words(col: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts of a column and the n+1 word offsets."""
    data, off = flat_text(col)
    starts, ends, woff = word_spans(data, off)
    return span_hashes(data, starts, ends, lower), woff


def combine(*hashes: np.ndarray) -> np.ndarray:
    """Order-dependent hash of several equally long hash arrays."""
    out = hashes[0]
    for h in hashes[1:]:
        out = mix64(out * _MULT + h)
    return out


def ragged_arange(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count, concatenated."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) - np.repeat(begin, counts)
