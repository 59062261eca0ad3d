"""Phrase collocations against a brute-force count."""

import random
import re
from collections import Counter, defaultdict

import pytest

from gridlens.llm import chunks as CH
from gridlens.llm import collocations as CO

LOWER = {a: a + 32 for a in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, rank string, a long, phrase string, key long"


def brute(rows, min_count, top=2000, max_words=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, max_words + 1):
                f[lang].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= min_count}
        inside = {g[s:s + k]: True for g, a in cand.items() for k in range(2, len(g)) for s in range(len(g) - k + 1)
                  if a >= c[g[s:s + k]]}
        found = []
        for g, a in cand.items():
            if g not in inside:
                score, k = min((1000 * a * n[lang] // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]], k))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s, k)
                for i, (s, a, p, left, right, k) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    words = ["New", "york", "city", "the", "of", "é", "漢字", "a b", "x" * 3000, "12", "Ü"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(120):
        out = []
        for _ in range(rng.choice([0, 5, 60, 400])):
            out.append(rng.choice(["new york city", "NEW york", "of the", "a\tb c  d e"]) if rng.random() < .2 else rng.choice(words))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "; x;", "!?"]))
        rows.append(("".join(out), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", None), ("   ", "de"), ("...", "fr"), (None, None), ("go " * 5000, "en"), rows[3], rows[3]]
    return rows


def frame(spark, rows, parts):
    return spark.createDataFrame([(i, t, g, "s", "r", 1, "p", 2) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(parts)


# the second: many chunks, and the frequent groups joined by shuffle
@pytest.mark.parametrize("broadcast_most, chunk_bytes", [(1 << 20, 4 << 20), (0, 2000)])
def test_collocations_match_brute_force(spark, broadcast_most, chunk_bytes):
    rows = corpus()
    got = CO.collocations(frame(spark, rows, 4), min_count=6, broadcast_most=broadcast_most, chunk_bytes=chunk_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]
    want = brute(rows, 6)
    assert len(want) > 150 and sorted(tuple(r) for r in got.collect()) == want


def test_top_and_ties(spark):
    rows = [("b a. b a. a b. a b. c d. c d", "en")] * 2 + [("p q r. p q r", "de")] * 3
    for top in (1, 2, 2000):
        got = sorted(tuple(r) for r in CO.collocations(frame(spark, rows, 2), min_count=4, top=top).collect())
        assert got == brute(rows, 4, top)


def test_products_beyond_64_bits(spark):
    # 1000 * a * n passes 2^63 and l * r does not fit a long: counts are given to the cut directly
    a, n, left, right = 3 * 10 ** 9, 10 ** 12 + 7, 4 * 10 ** 9, 5 * 10 ** 9 + 1
    rows = spark.createDataFrame([("en", "x y", 2, a, [left], [right], False, n)],
                                 "lang string, phrase string, m int, a long, ls array<long>, rs array<long>, inside boolean, n long")
    keep, CO.candidates = CO.candidates, lambda *_: rows
    try:
        assert CO.collocations(rows).first()["score"] == 1000 * a * n // (left * right)
    finally:
        CO.candidates = keep


def test_empty_tables_and_odd_rows(spark, odd, odd_rows, none):
    assert CO.collocations(none).collect() == []
    assert CO.collocations(odd, min_count=10 ** 6).collect() == []
    got = sorted(tuple(r) for r in CO.collocations(odd, min_count=3).collect())
    assert got == brute([(r[1], r[2]) for r in odd_rows], 3)


def test_a_hot_phrase_is_one_row_a_chunk(spark):
    docs = frame(spark, [("hot phrase here " * 4000, "en")] * 40, 4)
    relation = CO.word_relation(docs, 1 << 16)
    assert CO._asked(relation).count() == 3 * relation.count() == 3 * 40
    row = relation.first()
    assert len(CH.unsqueeze(row["code"], "uint32")) == 12000
