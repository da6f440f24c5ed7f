"""The registered queries and the pipeline over whole tables."""

import math

import pytest
from oracle import compare, connect

import corpus_pipeline
from fragcube.llm import quality
from fragcube.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    cursor = connect(sf_dir).execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, cursor.fetchall()) is None


def test_language_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op6_language_id"](spark, sf_dir).join(docs, "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.97 * len(got)


def test_quality_on_labelled_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op8_quality_rules"](spark, sf_dir).join(labels, "doc_id").collect()
    clean = [r for r in got if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in got if r["quality"] == 0]
    assert sum(r["kept"] for r in clean) >= 0.97 * len(clean)
    assert sum(r["kept"] for r in junk) <= 0.1 * len(junk)


def test_pipeline_stages(spark, sf_dir):
    """Each stage's decisions, recomputed in plain Python from what its predecessor kept."""
    from test_llm_copies import components_by_hand, exact_by_hand, spans_by_hand
    from test_llm_texts import check_places

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "substring_dedup", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.001')}/documents.parquet").cache()
    tables = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        tables[name] = stage(spark, docs, sf_dir).cache()
        docs = tables[name]
        if name != "best_fit_packing":
            assert docs.columns == tables["documents"].columns
    ids = lambda name: sorted(r["doc_id"] for r in tables[name].select("doc_id").collect())
    rows = lambda name: [(r["doc_id"], r["text"]) for r in tables[name].collect()]
    field = quality.train(tables["documents"], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids("quality_rules") == sorted(i for i, t in rows("documents") if quality.judge_text((t or "").encode(), field)[-1])
    assert ids("exact_dedup") == sorted(r[0] for r in exact_by_hand(rows("quality_rules")) if r[3])
    assert ids("near_dedup") == sorted(r[0] for r in components_by_hand(rows("exact_dedup")) if r[0] == r[2])
    cut = {i: (n, gone) for i, n, gone, _ in spans_by_hand(rows("near_dedup"), 50)}
    after = dict(rows("substring_dedup"))
    assert {i: len(t.encode().split()) for i, t in after.items()} == {i: n - gone for i, (n, gone) in cut.items()}
    assert sum(gone for _, gone in cut.values()) > 0
    packed = tables["best_fit_packing"].collect()
    used = check_places(packed, 2048)
    assert {r["doc_id"] for r in packed} == set(after)
    assert used <= math.ceil(sum(r["length"] for r in packed) / 2048) + 2


def test_copies_go_whatever_their_ids(spark, tmp_path):
    """Repeated and null ids: one row of each group of equal or similar texts stays."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:58], "x", "y"])
    table = [(1, " ".join(words), "a"), (1, " ".join(words), "b"), (None, " ".join(words), "c"), (None, "  ".join(words), "d"), (2, near, "e"), (None, near, "f"), (3, "alone", "g"), (None, None, "h"), (4, "", "i")]
    docs = spark.createDataFrame(table, "doc_id long, text string, source string").repartition(3)
    once = corpus_pipeline.exact_dedup(spark, docs, "")
    assert once.columns == docs.columns
    kept = sorted(("" if r["text"] is None else "".join(r["text"].split())) for r in once.collect())
    assert kept == sorted({"".join((t or "").split()) for _, t, _ in table})
    left = corpus_pipeline.near_dedup(spark, once, "")
    assert left.columns == docs.columns
    assert sorted(len((r["text"] or "").split()) for r in left.collect()) == [0, 1, 60]
    empty = docs.limit(0)
    assert corpus_pipeline.near_dedup(spark, corpus_pipeline.exact_dedup(spark, empty, ""), "").count() == 0
    repeated = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(len((r["text"] or "").split()) for r in repeated.collect() if r["text"]) == [1, 60]
