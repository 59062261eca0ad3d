"""The registered queries of the training-data operators.

Each query applies its operator to the whole table and derives the contract's
digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import byte_bpe as BB
from gridlens.llm import collocations as CO
from gridlens.llm import decontamination as DC
from gridlens.llm import language_id as LI
from gridlens.llm import lm_scoring as LM
from gridlens.llm import mixing as MI
from gridlens.llm import ngram_join as NJ
from gridlens.llm import quality_classifier as QC
from gridlens.llm import quality_rules as QR
from gridlens.llm import sharding as SH
from gridlens.llm import suffix_dedup as SD
from gridlens.llm import token_output as TO
from gridlens.llm import whitening as WH
from gridlens.llm.common import documents, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

N_SHARDS = 40
END_ID = 2


def fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


def vocabulary_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-d tree shards of nearly equal bytes (law ``bytes``)."""
    docs = documents(spark, sf_dir)
    tree = SH.fit_kd_tree(docs, n_shards=N_SHARDS)
    out = SH.assign_shards(docs, tree).select(
        "doc_id", SH.size_bytes(F.col("text")).alias("size"), SH.text_crc(F.col("text")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "source", "lang")
    out = SH.number_slots(out, "shard", ["doc_id", "text_crc32"], docs.count(), N_SHARDS)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source", "lang")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency per host."""
    out = QR.quality_rules(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "words_removed", "depleted")


SQL["op2_quality_rules"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, source, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + j AS p FROM rep, (VALUES (0), (1), (2)) o(j)) GROUP BY rid),
ln AS (SELECT rid, source, text, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS ws
       FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS l FROM docs)),
lines AS (SELECT rid, source, text, l, len(ws) AS nw, regexp_replace(regexp_replace(translate(trim(l, ' ' || chr(9) || chr(10)
           || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM ln WHERE len(ws) > 0),
dup AS (SELECT rid, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM docs GROUP BY source),
bad AS (SELECT x.source, x.norm FROM (SELECT source, norm, count(DISTINCT text) AS n FROM lines GROUP BY source, norm) x
        JOIN hosts h ON x.source IS NOT DISTINCT FROM h.source WHERE x.n > 20 AND x.n > 0.002 * h.texts),
gone AS (SELECT l.rid, sum(l.nw) AS n FROM lines l JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.norm = b.norm
         GROUP BY l.rid),
base AS (SELECT d.doc_id, len(w.ws)::BIGINT AS n_words, length(array_to_string(w.ws, ''))::BIGINT AS word_chars,
           length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
           coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
           coalesce(gone.n, 0)::BIGINT AS words_removed
         FROM docs d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             n_words - words_removed < 0.5 * n_words AS depleted FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, words_removed, depleted FROM judged
"""


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each text left when 50-byte strings of smaller documents go."""
    out = SD.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents whose 3-word shingles have Jaccard 0.9 or more."""
    return NJ.join_components(documents(spark, sf_dir).select("doc_id", "text"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of 150 % of all sizes."""
    out = MI.mix(documents(spark, sf_dir))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                      F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"), "source",
                      F.col("_copies").alias("copies"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or paraphrased."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return DC.find_leaks(documents(spark, sf_dir), benchmark)


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, learned from four fifths of the labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 5) != 0)
    model = QC.fit(labels.select("doc_id", F.col("quality").alias("label")), docs)
    out = QC.score(docs, model)
    return out.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"))


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text, learned from six sevenths of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rest = fold(F.col("doc_id"), 7)
    lane = F.when(rest == 2, LM.SCORED).when(rest == 3, LM.WEIGHTS).otherwise(LM.TRAIN)
    return LM.score_texts(docs, lane).select(
        "doc_id", (F.col("lane") == LM.SCORED).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "vocabulary")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from two thirds of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = LI.fit(docs.where(fold(F.col("doc_id"), 3) != 1))
    return LI.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "confident")


@query
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text written as Huffman blocks and read back."""
    vocabulary, path = vocabulary_file("word_bpe_49k.json"), scratch_path(spark, "token-files")
    TO.write_tokens(TO.token_table(documents(spark, sf_dir), vocabulary, END_ID), path, TO.id_width(vocabulary))
    return TO.ids_crc32(TO.read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components, with unit variance."""
    return WH.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases of two to five words."""
    return CO.collocations(documents(spark, sf_dir).select("lang", "text"))


SQL["op12_collocations"] = r"""
WITH docs AS (SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws
      FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
x AS (SELECT lang, pid, unnest(ws) AS w1, unnest(range(len(ws))) AS i FROM (SELECT lang, ws, row_number() OVER () AS pid FROM w)),
seq AS (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4, lead(w1, 4) OVER p AS w5
        FROM x WINDOW p AS (PARTITION BY pid ORDER BY i)),
f AS (SELECT lang, [w1] AS g, 1 AS m, count(*) AS a FROM seq GROUP BY lang, w1 HAVING count(*) >= 100
      UNION ALL SELECT lang, [w1, w2], 2, count(*) FROM seq WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 100
      UNION ALL SELECT lang, [w1, w2, w3], 3, count(*) FROM seq WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 100
      UNION ALL SELECT lang, [w1, w2, w3, w4], 4, count(*) FROM seq WHERE w4 IS NOT NULL
                GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 100
      UNION ALL SELECT lang, [w1, w2, w3, w4, w5], 5, count(*) FROM seq WHERE w5 IS NOT NULL
                GROUP BY lang, w1, w2, w3, w4, w5 HAVING count(*) >= 100),
held AS (SELECT lang, g[s:s + k - 1] AS g, max(a) AS a
         FROM (SELECT lang, g, a, m, k, unnest(range(1, m - k + 2)) AS s FROM f, range(2, 5) AS r(k) WHERE k < m) GROUP BY ALL),
cand AS (SELECT c.lang, c.g, c.a, k, c.g[1:k] AS head, c.g[k + 1:c.m] AS tail FROM f c
         LEFT JOIN held h ON h.lang = c.lang AND h.g = c.g, range(1, 5) AS q(k)
         WHERE c.m >= 2 AND k < c.m AND (h.a IS NULL OR 100 * h.a < 100 * c.a)),
cuts AS (SELECT c.lang, c.g, c.a, t.n, x.a AS l, y.a AS r, c.k,
           ((1000::HUGEINT * c.a * t.n) // (x.a::HUGEINT * y.a))::BIGINT AS score
         FROM cand c JOIN f x ON x.lang = c.lang AND x.g = c.head JOIN f y ON y.lang = c.lang AND y.g = c.tail
         JOIN total t ON t.lang = c.lang),
best AS (SELECT *, array_to_string(g, ' ') AS phrase FROM cuts
         QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, k AS cut
FROM best QUALIFY rank <= 2000
"""


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's byte-level BPE ids and of what they decode to."""
    return BB.encode_decode(documents(spark, sf_dir), vocabulary_file("byte_bpe_50k.json"))
