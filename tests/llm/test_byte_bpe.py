"""Byte-level BPE against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridlens.llm import byte_bpe as BB
from tests.llm.conftest import SCHEMA

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(VOCABULARY)


def brute(rows):
    out = []
    for i, t in rows:
        ids = WHOLE.encode(t or "", add_special_tokens=False).ids
        back = WHOLE.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def strange(rng, n):
    pool = ["a", "the", "'re", "'", "ll", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c", "\x1c", "\x1f",
            "\x85", "\xa0", " ", "᠎", " ", "​", " ", " ", " ", " ", "　", "é", "漢字", "ñ", "😀", "ß",
            "0", "123", "²", "!", "?!", "”", "—", "\x00", "\x7f", "ab", "th", "in"]
    return "".join(rng.choice(pool) for _ in range(n))


def test_odd_rows_and_strange_texts(spark, odd, odd_rows, none):
    got = sorted((tuple(r) for r in BB.encode_decode(odd, VOCABULARY).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in odd_rows])
    assert BB.encode_decode(none, VOCABULARY).collect() == []
    rng = random.Random(1)
    rows = [(i, strange(rng, rng.choice([1, 3, 10, 200]))) for i in range(600)]
    docs = spark.createDataFrame([(*r, *[None] * 10) for r in rows], SCHEMA).repartition(4)
    assert sorted((tuple(r) for r in BB.encode_decode(docs, VOCABULARY).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("leaf, fan_in", [(7, 2), (64, 3)])
def test_long_unsplit_texts_are_joined_exactly(spark, leaf, fan_in):
    rng = random.Random(leaf)
    rows = [(i, "".join(rng.choice(a) for _ in range(rng.choice([5, 90, 700]))))
            for i, a in enumerate(["a", "ab", "aeinrst", "etaoinshrdlu", "éè漢字", "0123456789", "-=*#", "😀ß"] * 6)]
    rows += [(100 + i, strange(rng, 150).replace(" ", "")) for i in range(40)]
    rows += [(None, "x" * 900), (200, None), (200, ""), (7, "some words " + "ab" * 400 + " and more <|endoftext|>" + "zq" * 300 + "'s end")]
    docs = spark.createDataFrame([(*r, *[None] * 10) for r in rows], SCHEMA).repartition(3)
    parts = BB._parts(docs, VOCABULARY, leaf)
    assert parts.where("kind = 2").count() > 100  # the tree is used
    assert sorted((tuple(r) for r in BB.encode_decode(docs, VOCABULARY, leaf, fan_in).collect()), key=str) == brute(rows)


def test_join_equals_whole_encoding():
    enc, rng = BB.ByteBpe(VOCABULARY), random.Random(8)
    merges = [t for t in enc.names if 2 < len(t) < 9 and t.isascii() and t.isalpha()]
    for _ in range(400):
        text = "".join(rng.choice([rng.choice(merges), "a" * rng.randrange(9), rng.choice("etaoinshr")]) for _ in range(rng.choice([2, 8, 40])))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text), 5)))
        nodes = [enc.merge(text[a:z]) for a, z in zip([0, *cuts], [*cuts, len(text)])]
        assert enc.join_all(nodes).tolist() == enc.merge(text).tolist(), text


def test_long_runs_with_the_real_leaf():
    enc, n = BB.ByteBpe(VOCABULARY), 3 * BB.LEAF + 11
    for text in ("a" * n, "ab" * (n // 2), "".join(random.Random(2).choices("abcdefghij", k=n))):
        cut = [enc.merge(text[i:i + BB.LEAF]) for i in range(0, n, BB.LEAF)]
        assert np.array_equal(enc.join_all(cut), enc.merge(text))


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        BB.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))
