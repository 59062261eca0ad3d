"""Sharding, quality rules and mixing against brute force, and odd rows."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridlens.llm import mixing, quality_rules, sharding
from gridlens.llm.cuts import Cut, weighted_cuts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def test_weighted_cuts_match_a_sort(spark):
    rows = [(g, (k * k * 7919) % 10_007, 1 + k % 5) for g in (1, 2) for k in range(400)]
    df = spark.createDataFrame(rows, "g long, k long, w int")
    got = weighted_cuts(df, "g", "k", "w", {g: Cut(0, 20_000, 300.0 * g, 0.0) for g in (1, 2)})
    for g in (1, 2):
        inside = sum(w for h, k, w in rows if h == g and k <= got[g])
        every = sorted((k, w) for h, k, w in rows if h == g)
        best = min(abs(sum(w for k, w in every if k <= cut) - 300 * g) for cut in [-1, *[k for k, _ in every]])
        assert abs(inside - 300 * g) == best


def test_weighted_cuts_target_beyond_all_rows(spark):
    df = spark.createDataFrame([(1, 5, 1)], "g long, k long, w int")
    assert weighted_cuts(df, "g", "k", "w", {1: Cut(0, 9, 50.0, 0.0)}) == {1: 9}


def test_shards_are_nearly_equal_and_slots_gapless(spark):
    docs = spark.createDataFrame([(i, "w" * (1 + i * 37 % 900), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(4000)],
                                 "doc_id long, text string, lang string, source string")
    tree = sharding.fit_kd_tree(docs, n_shards=8)
    out = sharding.assign_shards(docs, tree)
    sizes = defaultdict(int)
    for r in out.collect():
        sizes[r["shard"]] += len(r["text"]) + 16
    mean = sum(sizes.values()) / 8
    assert set(sizes) == set(range(8)) and max(abs(v - mean) for v in sizes.values()) < 0.02 * mean
    slots = sharding.number_slots(out.drop("text"), "shard", ["doc_id"], 4000, 8).collect()
    by = defaultdict(list)
    for r in slots:
        by[r["shard"]].append(r["slot"])
    assert len(slots) == 4000 and all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_reach_the_target_bytes(spark):
    docs = spark.createDataFrame([(i, "z" * 84, "en", "s") for i in range(1000)], "doc_id long, text string, lang string, source string")
    tree = sharding.fit_kd_tree(docs, target_bytes=10_000)
    assert len(tree.leaves) == 10


def test_sharding_of_odd_rows(odd, none, odd_rows):
    out = sharding.assign_shards(odd, sharding.fit_kd_tree(odd, n_shards=4))
    assert out.count() == len(odd_rows)
    assert [c for c in out.columns if c != "shard"] == [c for c in odd.columns if c != "shard"]
    assert sharding.assign_shards(none, sharding.fit_kd_tree(none, n_shards=4)).count() == 0


def brute_quality(rows, limits):
    hosts, held = defaultdict(set), defaultdict(set)

    def lines(t):
        return [x for x in (t or "").split("\n") if words(x)]

    def normal(x):
        low = x.strip(" \t\n\x0b\x0c\r").translate({a: a + 32 for a in range(65, 91)})
        return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", low))

    for doc_id, t, host in rows:
        hosts[host].add(t)
        for x in lines(t):
            held[host, normal(x)].add(t)
    out = []
    for doc_id, t, host in rows:
        w = words(t)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n, covered = Counter(grams), set()
        for i, g in enumerate(grams):
            if n[g] > 1:
                covered |= {i, i + 1, i + 2}
        own = lines(t)
        gone = sum(len(words(x)) for x in own if len(held[host, normal(x)]) > max(limits.min_docs, limits.share * len(hosts[host])))
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(own) - len(set(own)),
                    len(covered), failed, gone, not failed and len(w) - gone >= limits.min_left * len(w)))
    return out


@pytest.mark.parametrize("min_docs", [2, 20])
def test_quality_rules_match_brute_force(odd, odd_rows, min_docs):
    limits = quality_rules.LineLimits(min_docs=min_docs)
    got = quality_rules.quality_rules(odd, limits)
    got = [tuple(r) for r in got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                        "base_failed", "words_removed", "kept").collect()]
    want = brute_quality([(r[0], r[1], r[3]) for r in odd_rows], limits)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quality_rules_very_long_text_uses_the_wide_sort(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "PACKED_WORDS", 10)
    rows = [(1, "a b c d e a b c x y z a b c", "h"), (2, "one two three", "h"), (3, "p q r s t u v w x y z " * 2, "h")]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert {r["doc_id"]: r["n_repeat_words"] for r in got.collect()} == {1: 9, 2: 0, 3: 22}


def test_frequent_lines_leave_the_text(spark):
    shared = "this page is under the same licence as all the others"
    body = " ".join("w" + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(60))
    rows = [(i, f"{shared.upper() if i % 2 else shared}\n{body} {chr(97 + i % 26) * (1 + i // 26)}\n\nend {chr(97 + i % 26) * (1 + i // 26)} x", "h") for i in range(30)]
    rows.append((99, "\n".join([shared] * 8), "h"))
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"),
                                      quality_rules.LineLimits(min_docs=20, share=0.1), clean_text=True).collect()
    by = {r["doc_id"]: r for r in out}
    assert by[0]["text_cleaned"] == f"{body} a\n\nend a x" and by[0]["kept"]
    assert by[99]["depleted"] and not by[99]["kept"] and by[99]["text_cleaned"] == ""


def test_quality_rules_empty_table(none):
    assert quality_rules.quality_rules(none).count() == 0
    assert quality_rules.quality_rules(none, clean_text=True).count() == 0


def test_targets_are_shared_again():
    # weights 3 1 2 of 150: 75 25 50; the first stops at 20, the second at 40
    assert mixing.share_targets([10, 20, 70], [3, 1, 2], 150, 2) == pytest.approx([20, 40, 90])
    assert mixing.share_targets([50, 50], [1, 1], 150, 2) == pytest.approx([75, 75])
    assert mixing.share_targets([], [], 0, 2) == []
    assert mixing.share_targets([0, 10], [3, 1], 15, 2) == pytest.approx([0, 15])


def test_mix_comes_near_its_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i * 13 % 200), f"s{i % 10 if i % 3 else 0}") for i in range(6000)],
                                 "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["_copies"] in (0, 1, 2)
        taken[r["source"]] += r["_copies"] * r["_size"]
        size[r["source"]] += r["_size"]
        target[r["source"]] = r["_target"]
    assert all(abs(taken[s] - target[s]) <= 200 and target[s] <= 2 * size[s] + 1e-6 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    again = {(r["doc_id"], r["_copies"]) for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["_copies"]) for r in rows}


def test_longer_documents_are_likelier(spark):
    docs = spark.createDataFrame([(i, "w " * (2 if i % 2 else 400), "s") for i in range(4000)], "doc_id long, text string, source string")
    out = mixing.mix(docs, total_share=0.5).groupBy("_size").agg(F.avg("_copies").alias("p")).collect()
    p = {r["_size"]: r["p"] for r in out}
    assert p[400] > 2 * p[2] > 0


def test_mix_of_odd_rows(odd, none, odd_rows):
    out = mixing.mix(odd)
    assert out.count() == len(odd_rows)
    assert "_row" in out.columns and "shard" in out.columns
    assert {r["_size"] for r in out.where("text is null").collect()} == {0}
    assert mixing.mix(none).count() == 0


def test_crc_of_text(spark):
    df = spark.createDataFrame([("é x",), (None,)], "text string")
    got = [r[0] for r in df.select(sharding.text_crc(F.col("text"))).collect()]
    assert got == [zlib.crc32("é x".encode()), 0]
