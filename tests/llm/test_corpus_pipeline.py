"""The stages one by one against plain Python, and the whole run."""

import re

import numpy as np
import pyarrow as pa
import pytest
from edge_cases import ROWS, documents, no_documents
from test_simhash import components, fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlens.llm import mixing, toxicity
from ledgerlens.llm.common import Workspace
from ledgerlens.llm.tokens import vocabulary_path

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    layout = docs.schema
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), Workspace(spark, "t"), held_out=None)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {i for i, t in texts.items() if model.score(np.unique(toxicity.gram_slots(t.encode()))) < 0.5}
    assert 0 < len(kept) < len(texts)
    seen: dict[str, int] = {}
    for i in sorted(kept):
        seen.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    unique = sorted(seen.values())
    label = components([fingerprint(texts[i]) for i in unique])
    first: dict[int, int] = {}
    for i, own in zip(unique, label, strict=True):
        first.setdefault(own, i)
    wanted = [kept, set(unique), set(first.values())]

    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, SF)
        found.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if number < 3:
            rows = docs.collect()
            assert sorted(r.doc_id for r in rows) == sorted(wanted[number]), name
            assert all(r.text == texts[r.doc_id] for r in rows)
        if name == "mixing":
            plan = mixing.mix_plan(spark.read.parquet(str(tmp_path / "simhash_near_dedup")), Workspace(spark, "t"))
            mixed = docs.collect()
            words = {}
            for r in mixed:
                words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
            assert words == {r.doc_id: r.taken for r in plan.collect() if r.taken}
        if name != "packing":
            assert docs.schema == layout, name
    whole = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    tokens = sorted((r.doc_id, len(whole.encode(r.text, add_special_tokens=False).ids) + 1) for r in mixed)
    pieces = docs.collect()
    assert sum(r.length for r in pieces) == sum(n for _, n in tokens)
    assert sorted((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == tokens
    run = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, run.select(*columns).collect())) == sorted(map(tuple, docs.select(*columns).collect()))


def tables(path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (7, 0, 1)], [(1, None, None), (99, 1, 1), (None, 0, 0)]])
def test_without_labels_of_both_kinds_nothing_is_rejected(spark, tmp_path, labels):
    docs = documents(spark)
    sf_dir = tables(tmp_path, docs, spark.createDataFrame(labels, LABELS))
    kept = corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_run_on_edge_cases_and_empty_tables(spark, tmp_path):
    spark.conf.set(corpus_pipeline.PACKED_PATH, str(tmp_path / "packed"))
    try:
        rows = corpus_pipeline.run(spark, tables(tmp_path / "edge", documents(spark), spark.createDataFrame([], LABELS))).collect()
        # Equal texts are one document, texts without words give nothing to the mix.
        assert {r.doc_id for r in rows} <= {i for i, text in ROWS if (text or "").split()} and len({r.doc_id for r in rows}) > 3
        assert spark.read.parquet(str(tmp_path / "packed")).count() == len(rows)
        empty = tables(tmp_path / "empty", no_documents(spark), spark.createDataFrame([], LABELS))
        assert corpus_pipeline.run(spark, empty).count() == 0
    finally:
        spark.conf.unset(corpus_pipeline.PACKED_PATH)


def test_texts_go_to_python_in_small_batches(spark):
    docs = spark.range(0, 2500, 1, 1).selectExpr("id doc_id", "concat('a b ', id) text")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    sizes = lambda batches: (pa.record_batch([pa.array([b.num_rows], pa.int64())], names=["doc_id"]) for b in batches)
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        corpus_pipeline.drop_exact_copies(spark, docs, SF)
        assert max(r.doc_id for r in docs.mapInArrow(sizes, "doc_id long").collect()) == 1000
        spark.conf.set(key, "77")
        corpus_pipeline.drop_exact_copies(spark, docs, SF)
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
