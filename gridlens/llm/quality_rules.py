"""Quality rules: per-document base rules and cross-document line frequency.

Only DataFrame functions. Words are ``common.WORD_RE``; lines are split at
``\\n`` and count if they hold a word. A normalised line has A-Z lowered,
digit runs written as 0 and white space collapsed. Per host (``source``), a
line is *frequent* when the distinct texts holding it exceed
``max(min_docs, share * distinct texts of the host)``; exact copies of a text
thus count once. Frequent lines are removed, and a document is *depleted*
when the words left are under ``min_left`` of its words.

Repeated 3-word windows are found inside each row by sorting one long per
window: the window's hash above, its position below. Up to 2^18 words that
leaves 46 bits or more of hash, beyond it a (64-bit hash, position) struct is
sorted instead.

Defined cases: a null or empty text has no words, fails the base rules and is
rejected; a null source is a host of its own; repeated rows each get their
own result; an empty table gives no rows; other columns pass through, but for
those named like a result (``RESULTS``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import SPACE_RE, materialize, n_words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
PACKED_WORDS = 1 << 18
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "words_removed", "depleted", "kept")


@dataclass(frozen=True)
class LineLimits:
    min_docs: int = 20
    share: float = 0.002
    min_left: float = 0.5


def trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def normal_line(line: Column) -> Column:
    low = F.translate(trimmed(line), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.regexp_replace(low, "[0-9]+", "0"), SPACE_RE, " ")


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def _covered(starts: Column) -> Column:
    """Words covered by 3-word windows at the ascending positions given."""
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + 3 - F.greatest(F.lit(0), a["end"] - i)).alias("n")),
        lambda a: a["n"])


def base_stats(df: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed; ``df`` has ``text``. The selects are kept apart on purpose:
    each array is computed once and read several times by the next."""
    own = df.columns
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(trimmed(x)) > 0)
    df = df.select(
        *own, F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform(F.split(trimmed(t), SPACE_RE), lambda w: F.xxhash64(w)).alias("_h"),
        n_words(F.col("text")).alias("n_words"))
    df = df.select(
        *[c for c in df.columns if c not in ("_lines", "_h")],
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_lines", lambda x: F.struct(line_hash(x).alias("h"), n_words(x).alias("w"))).alias("_lines"),
        F.ceil(F.log2(F.greatest(F.size("_h"), F.lit(2)))).cast("int").alias("_bits"),
        F.when(F.col("n_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_h") - 3),
            lambda i: F.xxhash64(F.get(F.col("_h"), i), F.get(F.col("_h"), i + 1), F.get(F.col("_h"), i + 2))))
        .otherwise(F.expr("array()").cast("array<bigint>")).alias("_windows"))
    packed = F.sort_array(F.transform(
        F.when(F.col("n_words") <= PACKED_WORDS, F.col("_windows")).otherwise(F.expr("array()").cast("array<bigint>")),
        lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("long"))))
    loose = F.sort_array(F.transform(
        F.when(F.col("n_words") > PACKED_WORDS, F.col("_windows")).otherwise(F.expr("array()").cast("array<bigint>")),
        lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*[c for c in df.columns if c != "_windows"], packed.alias("_packed"), loose.alias("_loose"))

    def high(x):
        return F.call_function("shiftright", x, F.col("_bits"))

    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits"))
    packed_at = F.transform("_packed", lambda x, k: F.when(
        (high(F.get(F.col("_packed"), k - 1)) == high(x)) | (high(F.get(F.col("_packed"), k + 1)) == high(x)),
        x.bitwiseAND(one - 1).cast("int")))
    loose_at = F.transform("_loose", lambda x, k: F.when(
        (F.get(F.col("_loose"), k - 1)["h"] == x["h"]) | (F.get(F.col("_loose"), k + 1)["h"] == x["h"]), x["i"]))
    df = df.select(*[c for c in df.columns if c not in ("_packed", "_loose", "_bits")],
                   F.array_compact(packed_at).alias("_p"), F.array_compact(loose_at).alias("_l"))
    repeats = _covered(F.sort_array(F.concat("_p", "_l")))
    df = df.withColumn("n_repeat_words", F.when(F.size("_p") + F.size("_l") > 0, repeats).otherwise(F.lit(0).cast("long")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_p", "_l")


def frequent_lines(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """(_host, h, n_docs) of the lines above their host's limit. ``rows``:
    _host, _text_hash and _lines. Copies of a text are merged before lines
    are counted, and counts are summed map-side, so neither a hot host nor a
    hot line meets in one task."""
    held = (rows.select("_host", "_text_hash", F.explode(F.array_distinct(F.transform("_lines", lambda x: x["h"]))).alias("h"))
            .distinct().groupBy("_host", "h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > limits.min_docs))
    hosts = (rows.select("_host", "_text_hash").distinct().groupBy("_host").agg(F.count("*").alias("_texts"))
             .withColumnRenamed("_host", "_of"))
    return (held.join(hosts, held["_host"].eqNullSafe(hosts["_of"]))
            .where(F.col("n_docs") > limits.share * F.col("_texts")).select("_host", "h", "n_docs"))


def quality_rules(docs: DataFrame, limits: LineLimits = LineLimits(), clean_text: bool = False) -> DataFrame:
    """All columns of ``docs`` with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, words_removed, depleted and
    kept; with ``clean_text`` also text_cleaned, the text without the
    frequent lines. Without it the text itself is not carried along."""
    keep = [c for c in docs.columns if c not in (*RESULTS, "text_cleaned") and (clean_text or c != "text")]
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), "text", F.col("source").alias("_host"))
    df = base_stats(df.withColumn("_text_hash", F.xxhash64("text"))).drop("text")
    df = materialize(df.withColumn("_rid", F.monotonically_increasing_id()), "quality-stats")
    bad = frequent_lines(df, limits).withColumnsRenamed({"_host": "_bad_host"})
    lines = df.select("_rid", "_host", F.explode("_lines").alias("_x")).select("_rid", "_host", "_x.h", "_x.w")
    hits = (lines.join(bad, (lines["_host"].eqNullSafe(bad["_bad_host"])) & (lines["h"] == bad["h"]))
            .groupBy("_rid").agg(F.sum("w").alias("words_removed"), F.collect_set(lines["h"]).alias("_gone")))
    if not clean_text:
        hits = hits.drop("_gone")
    out = df.join(hits, "_rid", "left").withColumn("words_removed", F.coalesce("words_removed", F.lit(0).cast("long")))
    out = out.withColumn("depleted", (F.col("n_words") - F.col("words_removed")) < limits.min_left * F.col("n_words"))
    out = out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    stats = list(RESULTS)
    if clean_text:
        left = F.array_join(F.filter(F.split(F.col("_row.text"), "\n"),
                                     lambda x: ~F.array_contains(F.col("_gone"), line_hash(x)) | (F.length(trimmed(x)) == 0)), "\n")
        out = out.withColumn("text_cleaned", F.when(F.col("_gone").isNull(), F.col("_row.text")).otherwise(left))
        stats.append("text_cleaned")
    return out.select("_row.*", *stats)
