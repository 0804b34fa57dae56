import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from edge_cases import ROWS, documents, no_documents

from ledgerlens.llm import exact_dedup
from ledgerlens.llm.common import Workspace
from ledgerlens.llm.exact_dedup import build_directory, drop_copies, exact_groups, normalised


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str), len(groups)


def check(rows, found):
    want, groups = expected(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_edge_cases(spark):
    check(ROWS, exact_groups(documents(spark), Workspace(spark, "t")).collect())
    assert exact_groups(no_documents(spark), Workspace(spark, "t")).count() == 0


def test_colliding_keys_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 40}") for i in range(400)]
    found = exact_groups(documents(spark, rows).repartition(5), Workspace(spark, "t"), key=lambda text: len(text) << 50).collect()
    check(rows, found)
    assert {r.chain for r in found} > {0, 1, 2}


def test_copies_over_many_tasks_and_small_batches(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    check(rows, exact_groups(documents(spark, rows).repartition(16), Workspace(spark, "t"), bucket_bytes=1000).collect())


def test_directory_doubles_and_keeps_buckets_within_capacity():
    weights = np.zeros(256, dtype=np.int64)
    weights[[0, 1, 2, 3, 100, 200, 255]] = [5, 5, 5, 5, 30, 1, 1]
    directory, depth = build_directory(weights, 10)
    assert len(directory) == 1 << depth
    at = directory[np.arange(256) >> (8 - depth)]
    for bucket in np.unique(at):
        own = weights[at == bucket]
        assert own.sum() <= 10 or np.count_nonzero(own) == 1
        # A bucket is one range of keys.
        assert (np.diff(np.flatnonzero(at == bucket)) == 1).all()
    assert build_directory(np.zeros(16, dtype=np.int64), 1)[1] == 0


def test_normalised():
    assert [normalised(t) for t in (b"", b" ", b"\n\t", b"a", b" a\x0b\x0cb ", b"a\xc2\xa0 b")] == [b"", b" ", b" ", b"a", b" a b ", b"a\xc2\xa0 b"]


def test_drop_copies_keeps_columns(spark):
    docs = documents(spark)
    kept = drop_copies(docs, Workspace(spark, "t"))
    assert kept.schema == docs.schema
    want, groups = expected(ROWS)
    rows = kept.collect()
    assert len(rows) == groups
    assert {r.doc_id for r in rows} == {keep for _, keep, _, _ in want}
    assert drop_copies(no_documents(spark), Workspace(spark, "t")).count() == 0


def test_entries_leave_a_task_in_small_batches(monkeypatch):
    class Rows:
        def mapInArrow(self, combine, layout):
            return combine

    monkeypatch.setattr(exact_dedup, "documents", lambda docs: docs)
    monkeypatch.setattr(exact_dedup, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 3})())}))
    monkeypatch.setattr(exact_dedup, "SENT_BYTES", 5000)
    texts = [f"{i % 50:04d}" * 250 for i in range(100)]
    batch = pa.record_batch([pa.array(range(100), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sent = list(exact_dedup.entries(Rows())(iter([batch])))
    assert max(b.num_rows for b in sent) <= 5 and len(sent) >= 10
    rows = [row for b in sent for row in b.to_pylist()]
    assert sorted(row["entry"] for row in rows) == [(3 << 33) + i for i in range(50)]
    assert {row["text"].decode(): row["ids"] for row in rows} == {texts[i]: [i, i + 50] for i in range(50)}
    assert all(row["least"] == row["ids"][0] and row["copies"] == 2 for row in rows)
