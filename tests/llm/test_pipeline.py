"""The corpus pipeline against a brute-force version, stage by stage."""

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from gridlens.llm import common, decontamination, mixing, quality_rules
from tests.llm.test_native_operators import brute_quality
from tests.llm.test_text_operators import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = common.documents(spark, SF), []
    for name, fn in corpus_pipeline.STAGES:
        before = docs
        docs = common.materialize(fn(spark, docs, SF), "test-stage")
        out.append((name, before, docs))
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_stage_order_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination",
                                         "mixing sources to target weights", "sharding"]
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes
    assert stages[-1][2].columns == [*stages[-1][1].columns, "shard"]


def test_quality_stage_keeps_what_the_rules_keep(stages):
    _, before, after = stages[0]
    rs = rows(before)
    want = {d for d, *_, kept in brute_quality([(r["doc_id"], r["text"], r["source"]) for r in rs], quality_rules.LineLimits()) if kept}
    texts = {r["doc_id"]: r["text"] for r in rs}
    got = rows(after)
    assert {r["doc_id"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) and set(r["text"].split("\n")) <= set(texts[r["doc_id"]].split("\n")) for r in got)


def test_one_document_of_each_component_stays(stages):
    _, before, after = stages[1]
    parts = brute_components([(r["doc_id"], r["text"]) for r in rows(before)], corpus_pipeline.SHINGLE, corpus_pipeline.SIMILARITY)
    assert {r["doc_id"] for r in rows(after)} == {c for _, _, c in parts}


def test_rows_of_one_doc_id_and_without_doc_id(spark):
    """Rows are joined by what they are: other texts of a doc_id stay, copies without a doc_id go."""
    text = lambda c, n=60: " ".join(f"{c}{k}" for k in range(n))
    docs = [(7, text("a")), (7, text("b")), (3, text("b") + " end"), (7, text("c")), (None, text("a")), (None, text("d")), (None, text("d")),
            (None, text("e")), (9, text("f")), (9, text("f"))]
    frame = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, frame.repartition(3), SF)
    want = [(3, text("b") + " end"), (7, text("a")), (7, text("c")), (9, text("f")), (None, text("d")), (None, text("e"))]
    assert got.dtypes == frame.dtypes
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(str, want))


def test_decontamination_stage_drops_the_documents_with_items(stages, spark):
    _, before, after = stages[2]
    plain = lambda t: re.sub(r"[^0-9a-z\u0080-\U0010ffff]+", " ", (t or "").translate({a: a + 32 for a in range(65, 91)}))
    items = [plain(r["text"]).strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r["doc_id"] for r in rows(before) if any(f" {i} " in f" {plain(r['text']).strip()} " for i in items)}
    gone = {r["doc_id"] for r in rows(before)} - {r["doc_id"] for r in rows(after)}
    assert leaks and gone == leaks


def test_mixing_stage_repeats_rows_as_the_mix_says(stages):
    _, before, after = stages[3]
    want = Counter({r["doc_id"]: r["_copies"] for r in mixing.mix(before).collect() if r["_copies"]})
    assert Counter(r["doc_id"] for r in rows(after)) == want


def test_sharding_stage_keeps_all_rows_in_nearly_equal_shards(stages):
    _, before, after = stages[4]
    sizes, n = defaultdict(int), Counter()
    for r in rows(after):
        sizes[r["shard"]] += len(r["text"].encode()) + 16
        n[r["doc_id"]] += 1
    assert n == Counter(r["doc_id"] for r in rows(before)) and set(sizes) <= set(range(corpus_pipeline.N_SHARDS))
    largest = max(len(r["text"].encode()) + 16 for r in rows(before))
    # repeated rows are not parted, so a shard may miss its share by a few long documents
    assert max(sizes.values()) <= sum(sizes.values()) / corpus_pipeline.N_SHARDS + 4 * largest


def test_run_gives_the_last_stage(spark, stages):
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect())
    assert got == Counter(r["doc_id"] for r in rows(stages[-1][2]))


def test_pipeline_of_an_empty_table(none, spark):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, fn in corpus_pipeline.STAGES:
        docs = common.materialize(fn(spark, docs, SF), "test-empty")
    assert docs.count() == 0 and docs.columns[-1] == "shard"


def test_odd_rows_pass_through(odd, spark):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, fn in corpus_pipeline.STAGES:
        docs = common.materialize(fn(spark, docs, SF), "test-odd")
    assert docs.count() > 0


def test_all_eleven_queries_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert decontamination.LsaParams().rank > 0
