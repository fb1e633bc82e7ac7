"""The pipeline stage by stage against plain versions of what each keeps."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest

import __spark_entry__ as entry_mod
from test_groups import brute_components, normal
from test_scans import base_spans


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        assert result.columns == docs.columns
        docs = spark.createDataFrame(rows := result.collect(), docs.schema)
        out.append(rows)
    out.append(corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect())
    return out


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "personal data", "best-fit packing"]
    assert entry_mod.queries()["pipeline"] is corpus_pipeline.run


def test_classifier_keeps_clean_documents(stages, spark, sf_dir):
    kept = {r.doc_id for r in stages[1]}
    assert kept < {r.doc_id for r in stages[0]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)
    assert sum(i not in kept for i, q in labels.items() if q == 0) >= 0.7 * sum(q == 0 for q in labels.values())


def test_one_of_each_group_of_copies_stays(stages):
    groups = defaultdict(list)
    for r in stages[1]:
        groups[normal(r.text)].append((-len(r.text), r.doc_id))
    assert sorted(r.doc_id for r in stages[2]) == sorted(min(g)[1] for g in groups.values())


def test_one_of_each_group_of_near_copies_stays(stages):
    found = brute_components([(r.doc_id, r.text) for r in stages[2]], 5, 80)
    assert sorted(r.doc_id for r in stages[3]) == sorted({c for _, c in found.values()})


def test_personal_data_is_gone_and_other_texts_are_untouched(stages):
    before = {r.doc_id: r for r in stages[3]}
    assert sorted(before) == sorted(r.doc_id for r in stages[4])
    for r in stages[4]:
        assert base_spans(r.text) == []
        if not base_spans(before[r.doc_id].text):
            assert r == before[r.doc_id] or "[" in r.text


def test_every_document_is_packed(stages):
    assert {r.doc_id for r in stages[5]} == {r.doc_id for r in stages[4]}
    filled = Counter()
    for r in stages[5]:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and len(filled) <= sum(filled.values()) // 2048 + 2


def test_run_gives_the_rows_of_the_stages(stages, spark, sf_dir):
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(corpus_pipeline.run(spark, sf_dir).collect()) == key(stages[5])


def test_stages_take_odd_rows_and_none(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
