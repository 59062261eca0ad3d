"""Dedup, join, decontamination, models and token files against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlens.llm import chunks as CH
from gridlens.llm import components, common, decontamination, language_id, lm_scoring, ngram_join, quality_classifier
from gridlens.llm import suffix_dedup, token_output
from tests.llm.conftest import SCHEMA, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def test_word_hashes_match_the_regex(odd_rows):
    texts = [r[1] for r in odd_rows]
    h, off = common.hashed_words(pa.array(texts, pa.large_string()), lower=True)
    words = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    assert np.diff(off).tolist() == [len(w) for w in words]
    seen = dict(zip(itertools.chain(*words), h.tolist()))
    assert len(set(seen.values())) == len(seen)
    assert h.tolist() == [seen[w] for w in itertools.chain(*words)]


# ------------------------------------------------------------- suffix dedup
def brute_dedup(rows):
    first = {}
    key = lambda i: -1 if i is None else i
    for i, t in sorted(((key(i), t) for i, t in rows), key=lambda x: x[0]):
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < key(i):
                gone[k:k + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])[:len(gone)]).sum()) if len(b) else 0
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_LEADS, 1])
def test_suffix_dedup_matches_brute_force(odd, odd_rows, spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_LEADS", hot)
    got = [tuple(r) for r in suffix_dedup.remove_repeats(odd).collect()]
    assert sorted(got, key=str) == sorted(brute_dedup([(r[0], r[1]) for r in odd_rows]), key=str)


def test_suffix_dedup_of_overlapping_and_periodic_texts(spark):
    rng = random.Random(1)
    base = "".join(rng.choice("ab ") for _ in range(400))
    texts = [base[:120], base[60:200] + "q" + base[100:160], "ab" * 100, "ab" * 60, base[:49], base, "x" + base[149:260] + base[0:51]]
    rows = list(enumerate(texts))
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_bytes=True).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute_dedup(rows))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_multikey_order_sorts_and_groups():
    rng = np.random.default_rng(0)
    m = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order, group = suffix_dedup.multikey_order(m)
    rows = [tuple(r) for r in m[order].tolist()]
    assert rows == sorted(rows)
    assert [rows[i] == rows[i - 1] for i in range(1, 500)] == [group[i] == group[i - 1] for i in range(1, 500)]


def test_suffix_dedup_empty_table(none):
    assert suffix_dedup.remove_repeats(none).count() == 0


# -------------------------------------------------------------- n-gram join
def brute_components(rows, n, threshold):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(zip(*[w[k:] for k in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else []))
    name = list(range(len(rows)))

    def root(x):
        while name[x] != x:
            x = name[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            name[root(a)] = root(b)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[root(i)].append(d)
    return [(d, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def near_copies(rng, n, size, edits):
    base = prose(rng, size).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"zz{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("n,threshold,block", [(3, 90, 1024), (5, 80, 1024), (3, 90, 4)])
def test_ngram_join_matches_brute_force(spark, odd_rows, monkeypatch, n, threshold, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(n)
    texts = [r[1] for r in odd_rows[:70]]
    for size in (4, 11, 12, 20, 21, 25, 60, 150):
        texts += near_copies(rng, 14, size, 3)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), n, threshold)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_components(rows, n, threshold))


def test_ngram_join_of_odd_rows(odd, odd_rows, none):
    got = [tuple(r) for r in ngram_join.join_components(odd).collect()]
    assert sorted(got, key=str) == sorted(brute_components([(r[0], r[1]) for r in odd_rows], 3, 90), key=str)
    assert ngram_join.join_components(none).count() == 0


def test_ngram_join_links_through_null_and_repeated_ids(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    edit = lambda *at: " ".join("x%d" % i if i in at else w for i, w in enumerate(base))
    rows = [(1, edit(10, 110)), (None, edit()), (3, edit(50, 70)),        # 1 and 3 meet in a row without a doc_id only
            (None, edit(*range(0, 120, 9))), (None, "alone here today"), (None, None),
            (8, "one text under a repeated id " * 9), (8, "quite another text of the same id " * 9), (8, None),
            (9, "quite another text of the same id " * 9), (10, " ".join(f"q{i}" for i in range(200))), (4, "one text under a repeated id " * 9)]
    for k, size in enumerate((12, 40, 150)):                                # groups whose rows share few ids
        rows += [(20 + k + i % 3, t) for i, t in enumerate(near_copies(rng, 12, size, 3))]
        rows += [(None, t) for t in near_copies(rng, 6, size, 2)]
    want = brute_components(rows, 3, 90)
    assert [w[2] for w in want[:3]] == [1, 1, 1] and brute_components([rows[0], rows[2]], 3, 90)[1][2] == 3
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_light_subsets_reach_every_linkable_pair():
    for s in range(1, 30):
        for t in range(s, 30):
            c = ngram_join.overlap(s, t, 90)
            fits = any((a, b) == (s, t) for a, b, _ in ngram_join.subset_sizes(s, 30, 90))
            assert fits == (c <= s) and (not fits or 100 * c >= 90 * (s + t - c) and 100 * (c - 1) < 90 * (s + t - c + 1))


def test_boundary_follows_the_cost():
    assert ngram_join.choose_boundary({10: 5000}, 90) > 10  # ten subsets are cheaper than a list scan
    assert ngram_join.choose_boundary({39: 5000}, 90) <= 39


def test_components_of_a_path_a_star_and_an_empty_table(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(200, 260)} == {7} and 5 not in got
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --------------------------------------------------------- decontamination
@pytest.fixture(scope="module")
def leaky(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 9))) for _ in range(4000)]
    words = lambda n: [rng.choice(vocabulary) if rng.random() < 0.7 else rng.choice(["the", "of", "and", "to"]) for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(15, 60))) + ".") for i in range(30)]
    docs, truth = [], set()
    for d in range(300):
        body = words(rng.randrange(20, 400))
        if d % 5 == 0:
            i = rng.randrange(30)
            put = items[i][1].rstrip(".").split()
            if d % 10 == 0:  # a paraphrase: every seventh word replaced, but not the answer
                put = [rng.choice(vocabulary) if k % 7 == 3 and k < len(put) - 5 else w for k, w in enumerate(put)]
            at = rng.randrange(len(body))
            body = body[:at] + [w.upper() + "," if k % 4 == 0 else w for k, w in enumerate(put)] + body[at:]
            truth.add((d, i))
        docs.append((d, " ".join(body)))
    docs += [(None, items[3][1]), (900, None), (901, "")]
    truth.add((None, 3))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(items + [(98, None), (99, "")], "item_id long, text string"), truth, docs)


def test_decontamination_finds_copies_and_paraphrases_alone(leaky):
    docs, benchmark, truth, _ = leaky
    rows = decontamination.find_leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == truth


def test_drop_leaks_keeps_all_other_rows_whole(leaky, spark, odd, none, odd_rows):
    docs, benchmark, truth, rows = leaky
    kept = decontamination.drop_leaks(docs, benchmark).collect()
    assert sorted(map(str, (tuple(r) for r in kept))) == sorted(str(r) for r in rows if not any(r[0] == d for d, _ in truth))
    out = decontamination.drop_leaks(odd, benchmark)
    assert out.count() == len(odd_rows) and out.columns == odd.columns
    assert decontamination.drop_leaks(none, benchmark).count() == 0
    assert decontamination.drop_leaks(odd, benchmark.limit(0)).count() == len(odd_rows)


def test_candidate_recall_against_brute_force(leaky):
    """Latent candidates hold all but a few of the passages whose exact TF-IDF cosine is high."""
    docs, benchmark, _, rows = leaky
    p = decontamination.LsaParams()
    table, weights, bench = decontamination.fit(docs, benchmark, p)
    h, off = decontamination.words(pa.array([t for _, t in rows], pa.large_string()))
    found = decontamination.candidates(h, off, table, weights, bench, p)
    got = {(int(t), int(i)) for t, i, _, _ in found}

    def exact(h, off):
        block, a, z, text = decontamination.passages(off)
        m = np.zeros((len(a), 1 << p.bits), np.float32)
        end = np.append(block[1:], len(h))
        for k in range(len(a)):
            np.add.at(m[k], decontamination._bucket(h[block[a[k]]:end[z[k] - 1]], p.bits), 1)
        m *= weights.norm
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9), text
    x, text = exact(h, off)
    items = [r["text"] for r in sorted((r for r in benchmark.collect() if r["text"] is not None), key=lambda r: r["item_id"])]
    y, item = exact(*decontamination.words(pa.array(items, pa.large_string())))
    want = {(int(text[i]), int(item[j])) for i, j in zip(*np.nonzero(x @ y.T >= 0.6))}
    assert len(want) > 40 and len(want & got) >= 0.9 * len(want)


def test_items_that_many_rows_hold_are_found(leaky, spark):
    """Copies that are a third of the rows, and two rows of twelve."""
    _, benchmark, _, rows = leaky
    item = benchmark.where("item_id = 3").first()["text"]
    clean = [t for d, t in rows if d is not None and d < 300 and d % 5]
    for n, hold in ((90, 30), (12, 2)):
        texts = [f"{clean[0]} {item} {clean[1]}"] * hold + clean[2:2 + n - hold]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {(r["doc_id"], r["item_id"]) for r in decontamination.find_leaks(docs, benchmark).collect()}
        assert got == {(d, 3) for d in range(hold)}


def test_weights_of_benchmark_words_are_exact(leaky, spark):
    """The other words of a bucket say nothing about a word of the benchmark."""
    _, benchmark, _, _ = leaky
    p = decontamination.LsaParams(bits=4)
    item = benchmark.where("item_id = 3").first()["text"]
    docs = [(0, item), (1, None)] + [(i, " ".join(f"w{i}x{k}" for k in range(200))) for i in range(2, 40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    h, _ = decontamination.words(pa.array([item], pa.large_string()))
    for n, (_, weights, _) in ((40, decontamination.fit(frame, benchmark.where("item_id = 3"), p)),
                               (1, decontamination.fit(frame.limit(1), benchmark.where("item_id = 3"), decontamination.LsaParams()))):
        row, weight = weights.of(h, int(np.log2(len(weights.norm))))
        assert (row >= 0).all() and np.allclose(weight, math.log((1 + n) / 2) + 1)


def test_basis_is_learned_from_all_documents(leaky, monkeypatch):
    """More documents than ``corpus_docs`` are all taken, each at a smaller
    weight; the summed products are those of the dense passage matrix."""
    docs, benchmark, _, rows = leaky
    p, learn, seen = decontamination.LsaParams(corpus_docs=7), decontamination.latent_basis, {}
    monkeypatch.setattr(decontamination, "latent_basis", lambda b, d, w, p: seen.update(docs=d, table=learn(b, d, w, p)) or seen["table"])
    _, weights, _ = decontamination.fit(docs, benchmark, p)
    texts = [t for _, t in rows if t is not None]
    each = p.corpus_weight * math.sqrt(7 / len(rows))
    taken = seen["docs"].collect()
    assert sorted(r["text"] for r in taken) == sorted(texts) and np.allclose([r["row_weight"] for r in taken], each)
    assert seen["table"].shape == (len(weights.used), min(p.rank, len(weights.used))) and np.isfinite(seen["table"]).all()
    h, off = decontamination.words(pa.array(texts, pa.large_string()))
    block, a, z, _ = decontamination.passages(off)
    row, end = weights.of(h, p.bits)[0], np.append(block[1:], len(h))
    m = np.zeros((len(a), len(weights.used)))
    for k in range(len(a)):
        w = row[block[a[k]]:end[z[k] - 1]]
        np.add.at(m[k], w[w >= 0], each)
    m *= weights.used
    q = np.random.default_rng(1).normal(size=(len(weights.used), 5))
    got, want = decontamination.gram_product(seen["docs"], weights, q, p), m.T @ (m @ q)
    assert np.allclose(got, want, rtol=1e-3, atol=1e-5 * np.abs(want).max())


def test_candidates_hold_what_the_lcs_accepts(leaky, spark):
    """Short items, items cut to 8 or 10 words, LCS down to 0.6, an item in a
    third of all documents: nine of ten pairs the check accepts are candidates."""
    rng = random.Random(4)
    filler = [w for d, t in leaky[3] if d is not None and d < 300 and d % 5 for w in t.split()]
    sizes = [8, 10, 16, 20, 25, 40] * 10
    items = [(i, " ".join(rng.choice(filler) for _ in range(n)) + ".") for i, n in enumerate(sizes)]
    docs, kind = [], []
    for d in range(1500):
        i = 5 if d % 3 == 0 else rng.randrange(60)
        put = items[i][1].rstrip(".").split()
        if i != 5 and len(put) > 10:
            lose = rng.sample(range(len(put) - 5), int(len(put) * rng.choice([0.2, 0.3, 0.4])))
            put = [rng.choice(filler) if k in lose else w for k, w in enumerate(put)]
        body = [f"q{rng.randrange(10 ** 6)}" if rng.random() < 0.3 else rng.choice(filler) for _ in range(rng.randrange(60, 200))]
        at = rng.randrange(len(body))
        docs.append((d, " ".join(body[:at] + put + body[at:])))
        kind.append((i, "shared" if i == 5 else "short" if len(put) < 11 else "edited"))
    p = decontamination.LsaParams()
    table, weights, bench = decontamination.fit(spark.createDataFrame(docs, "doc_id long, text string"),
                                                spark.createDataFrame(items, "item_id long, text string"), p)
    h, off = decontamination.words(pa.array([t for _, t in docs], pa.large_string()))
    got = {(int(t), int(i)) for t, i, _, _ in decontamination.candidates(h, off, table, weights, bench, p)}
    every = np.array([(d, i, off[d] + k, 1.0) for d, (i, _) in enumerate(kind) for k in range(0, off[d + 1] - off[d], 16)])
    accepted = [(d, int(bench.ids.tolist().index(i))) for d, i, *_ in decontamination.confirm(h, off, every, bench, p)]
    recall = {k: np.mean([x in got for x in accepted if kind[x[0]][1] == k]) for k in ("short", "edited", "shared")}
    assert len(accepted) > 1200 and min(recall.values()) >= 0.9, recall


def test_signatures_drop_nothing_the_lcs_accepts(leaky, spark, monkeypatch):
    docs, benchmark, _, rows = leaky
    p = decontamination.LsaParams(cosine=0.05)
    table, weights, bench = decontamination.fit(docs, benchmark, p)
    h, off = decontamination.words(pa.array([t for _, t in rows], pa.large_string()))
    found = decontamination.candidates(h, off, table, weights, bench, p)
    some = decontamination.confirm(h, off, found, bench, p)
    monkeypatch.setattr(decontamination, "_possible", lambda h, off, item, *_: np.ones(len(item), bool))
    assert some == decontamination.confirm(h, off, found, bench, p) and len(some) >= 61


def test_items_of_repeated_words_and_short_items(spark):
    """Words that repeat count as often as they do; short items match as a whole sequence, not across documents."""
    rng = random.Random(6)
    new = lambda n, c="w": [f"{c}{rng.randrange(10 ** 8)}" for _ in range(n)]
    one, tail = new(14, "a"), new(5, "b")
    item = ["go"] * 16 + one + tail  # 35 words, 20 distinct; 14 of them change below
    docs = [(0, " ".join(new(40) + ["go"] * 16 + new(14) + tail + new(40))), (1, " ".join(new(40) + ["go"] * 3 + tail + new(60)))]
    short = [(1, "Alpha, beta gamma!"), (2, "alpha beta gamma"), (3, "beta"), (4, "gamma delta epsilon zeta"), (5, "?!")]
    docs += [(2, "we say ALPHA beta. Gamma again and Alpha beta gamma"), (3, "alpha beta x gamma"), (4, "gamma delta"),
             (5, "epsilon zeta"), (6, "gamma delta epsilon zeta"), (7, None), (8, "")]
    benchmark = spark.createDataFrame([(0, " ".join(item) + "."), *short], "item_id long, text string")
    got = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), benchmark).collect()
    want = [(0, 0), (2, 1), (2, 2), (2, 3), (3, 3), (6, 4)]
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == want


def test_lcs_matches_the_table():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontamination.lcs(np.array(a), np.array(b)) == t[-1][-1]


def test_empty_tables_have_no_leaks(none, odd, leaky):
    assert decontamination.find_leaks(none, leaky[1]).count() == 0
    assert decontamination.find_leaks(odd, leaky[1].limit(0)).count() == 0


# ------------------------------------------------------- quality classifier
def test_classifier_on_held_out_rows(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 80) if i % 3 else " ".join(["BUY!!", "NOW$$$"][k % 2] for k in range(60)), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] < 300], "doc_id long, label int")
    w = quality_classifier.fit(labels, docs)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, w).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 300)


def test_classifier_odd_rows(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(i, i % 2 if i % 7 else None) for i in range(40)] + [(3, 0), (None, 1)], "doc_id long, label int")
    w = quality_classifier.fit(labels, odd)
    out = quality_classifier.score(odd, w).collect()
    assert len(out) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in out)
    blank = {r["score"] for r in out if r["doc_id"] in (60, 61, 62)}
    assert len(blank) == 1  # null, empty and white space: the bias alone
    assert quality_classifier.score(none, w).count() == 0
    zero = quality_classifier.fit(labels.limit(0), odd)
    assert {r["score"] for r in quality_classifier.score(odd, zero).collect()} == {0.5}


# ------------------------------------------------------------- LM scoring
def test_lm_scores_match_brute_force(odd, odd_rows, none):
    lane = F.when(F.col("doc_id") % 7 == 2, lm_scoring.SCORED).when(F.col("doc_id") % 7 == 3, lm_scoring.WEIGHTS).otherwise(lm_scoring.TRAIN)
    got = lm_scoring.score_texts(odd, lane).collect()
    tokens = [WORD.findall((r[1] or "").translate(LOWER)) + ["</s>"] for r in odd_rows]
    learned = [t for r, t in zip(odd_rows, tokens) if r[0] is None or r[0] % 7 != 2]
    count = Counter(itertools.chain(*learned))
    total, v = sum(count.values()), len(count)
    want = []
    for r, t in zip(odd_rows, tokens):
        want.append((r[0], len(t), sum(count[w] > 0 for w in t), total,
                     round(sum(math.log10((count[w] + 1) / (total + v + 1)) for w in t), 6)))
    have = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert {r["vocabulary"] for r in got} == {v}
    # the mixture beats add-one on the texts not learned from
    held = [r for r in got if r["lane"] == lm_scoring.SCORED and r["n_tokens"] > 30]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in got)
    assert lm_scoring.score_texts(none, F.lit(lm_scoring.TRAIN)).count() == 0


def test_mixture_is_a_distribution(spark):
    """The probabilities of all words and the unknown word after a context sum to one."""
    texts = ["a b a c", "b a b", "c c a", "a b"]
    vocabulary = sorted({w for t in texts for w in t.split()}) + [""]
    docs = [(i, t) for i, t in enumerate(texts)] + [(10 + k, f"a {w}".strip()) for k, w in enumerate([*vocabulary, "zzz"])] + [(99, "a")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lane = F.when(F.col("doc_id") >= 10, lm_scoring.SCORED).when(F.col("doc_id") == 1, lm_scoring.WEIGHTS).otherwise(lm_scoring.TRAIN)
    p = {r["doc_id"]: r["score"] for r in lm_scoring.score_texts(df, lane).collect()}
    alone = {t: c for t, c in ((w, 10 + k) for k, w in enumerate([*vocabulary, "zzz"]))}
    ends = {r: 10 ** p[r] for r in p}
    # P("a </s>") and P("a w </s>") = P(a) P(w|a) P(</s>|w): compare to the sums over a common start
    assert ends[alone[""]] == pytest.approx(ends[99])
    assert sum(ends[alone[w]] for w in alone if w) < 10 ** 0


def test_em_learns_the_better_component():
    q = lambda p: 1 + round(-math.log10(p) * lm_scoring.BINS_PER_DECADE)
    w = lm_scoring.learn_weights([(5, q(0.9), q(0.001), 1000), (3, 0, q(0.1), 1000)], 10_000)
    assert w[5][0] > 0.98 and w[3][1] > 0.98 and np.allclose(w.sum(axis=1), 1)


# ------------------------------------------------------------- language id
def test_language_id_on_held_out_rows(spark):
    rng = random.Random(6)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["str", "eng", "ung"], "cc": ["ción", "ñez", "que"]}
    rows = [(i, " ".join("".join(rng.choice(syllables[g]) for _ in range(rng.randrange(1, 4))) for _ in range(30)), g)
            for i, g in ((i, "aabbcc"[i % 3 * 2:][:2]) for i in range(300))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df.where("doc_id < 200"))
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(df, model).collect()}
    assert np.mean([got[i] == g for i, _, g in rows if i >= 200]) > 0.97


def test_language_id_odd_rows(odd, none, odd_rows, spark):
    model = language_id.fit(odd)
    out = language_id.predict(odd, model).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        text = next(o[1] for o in odd_rows if o[0] == r["doc_id"])
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", text or ""))
        assert 0 <= r["score"] <= 1
    assert language_id.predict(none, model).count() == 0
    empty = language_id.predict(odd, language_id.fit(none)).collect()
    assert {(r["lang_pred"], r["score"], r["confident"]) for r in empty} == {("und", 0.0, False)}


def test_gradient_table_equals_embedding_times_softmax():
    p = language_id.LangParams(bits=10, epochs=2)
    col = pa.array(["alpha beta", "gamma"], pa.large_string())
    table = np.random.default_rng(0).normal(size=(1 << 10, 3)).astype(np.float32)
    by_counts = np.stack([f @ table[i] for i, f in language_id._counts(col, p)])
    assert np.allclose(by_counts, language_id.mean_rows(col, table, p), atol=1e-5)


# ------------------------------------------------------------ token files
VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(VOCABULARY)


def test_word_by_word_equals_whole_texts(tokenizer, odd_rows):
    texts = [r[1] or "" for r in odd_rows] + [
        "á b", "e ́x", "<|endoftext|>x <|startoftext|>", "İ ǅ", "　y z", "don't I'LL  '  s", "ﬁ Å", "\x85x \x1cy",
        "a<|endoftext|> b <|end oftext|>", "'s 's' t's", "x​y ﻿"]
    ids, off = token_output.WordEncoder(VOCABULARY).encode(pa.array(texts, pa.large_string()))
    assert [ids[a:z].tolist() for a, z in itertools.pairwise(off)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_files_round_trip(spark, odd, odd_rows, none, tokenizer):
    path = common.scratch_path(spark, "test-tokens")
    tokens = token_output.token_table(odd, VOCABULARY, 2)
    token_output.write_tokens(tokens, path, token_output.id_width(VOCABULARY))
    got = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    want = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in odd_rows]
    have = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert [d for d, _ in have] == sorted([d for d, _ in want], key=lambda d: -1 if d is None else d)
    assert [r["start"] for r in got] == [0, *itertools.accumulate(r["n_tokens"] for r in got)][:-1]
    digest = {r["doc_id"]: r["ids_crc32"] for r in token_output.ids_crc32(token_output.read_tokens(spark, path)).collect()}
    assert digest[0] == zlib.crc32(np.array(want[0][1], "<u4").tobytes())
    empty = common.scratch_path(spark, "test-none")
    token_output.write_tokens(token_output.token_table(none, VOCABULARY, 2), empty, 2)
    assert token_output.read_tokens(spark, empty).count() == 0


@pytest.mark.parametrize("n,most", [(1, 16), (2, 16), (300, 9), (300, 20), (5, 3)])
def test_huffman_codes_are_limited_complete_and_optimal(n, most):
    import heapq
    rng = random.Random(n)
    counts = {i * 3: int(2 ** (rng.random() * 9)) for i in range(n)}
    bits = token_output.code_lengths(counts, most)
    assert max(bits.values()) <= most
    if n > 1:
        assert sum(2.0 ** -b for b in bits.values()) == 1
    if n > 1 and most == 20:
        heap, cost = sorted(counts.values()), 0
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            cost += s
            heapq.heappush(heap, s)
        assert sum(counts[i] * bits[i] for i in counts) == cost
    code, length = token_output.canonical_codes(bits)
    ids = np.array(rng.choices(list(counts), weights=list(counts.values()), k=1000), np.uint32)
    words, marks = token_output.pack(ids, code, length)
    decoder = token_output.Decoder(code, length)
    for m in (1000, 64, 65, 1):
        words, marks = token_output.pack(ids[:m], code, length)
        assert decoder.unpack(words.tobytes(), marks, m).tolist() == ids[:m].tolist()


def test_too_many_ids_for_the_bits():
    with pytest.raises(ValueError):
        token_output.code_lengths({i: 1 for i in range(9)}, 3)


# -------------------------------------------------------------- chunks
def test_exchanged_counts_match(spark, odd, odd_rows):
    texts = CH.chunk_table(odd, F.col("doc_id"), F.lit(0), "test-chunks")
    got = CH.exchange_keys(texts, ngram_join._counted(1), [8], ngram_join._total, 8, "test-counts")

    def back(c, found):
        elements, _, _ = CH.distinct(np.concatenate([np.zeros(0, np.uint64), *ngram_join.shingle_sets(c.data, c.off, 1)]))
        return pa.table({"k": pa.array(elements.view(np.int64)), "n": pa.array(found[0].astype(np.int64))})
    rows = CH.with_answers(texts, got, back, "k long, n long").distinct().collect()
    want = Counter(w for r in odd_rows for w in set(WORD.findall((r[1] or "").translate(LOWER))))
    assert Counter(r["n"] for r in rows) == Counter(want.values())


def test_schema_names_clash_with_internal_ones():
    assert {"_row", "_size", "shard", "score", "kept", "part", "h"} <= {c.split()[0] for c in SCHEMA.split(", ")}
