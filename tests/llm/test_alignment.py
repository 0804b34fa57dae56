import glob
import hashlib
import random
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from edge_cases import ROWS, documents, no_documents
from tokenizers import Tokenizer

from ledgerlens.llm import alignment, queries
from ledgerlens.llm.common import Workspace
from ledgerlens.llm.tokens import vocabulary_path

PATHS = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

MORE = [
    (20, "the cat sat on the mat"),
    (21, "the cat sat on the mat"),
    (22, "▁ is dropped by one side"),
    (23, "two  spaces\nand lines\r\n\tand <s> <0x0A> <unk> </s>"),
    (24, "日本語のテキスト und Straße, naïve café 😀😀"),
    (25, " "),
    (26, "ﬁ ligature, fullwidth ＡＢＣ, combining é"),
    (27, " leading and trailing "),
]


def brute_force(rows):
    """Every pair of tokens of a text compared by their byte ranges; groups end where both sides do."""
    whole, pieces = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    whole.encode_special_tokens = True
    characters = whole.decoder
    texts = []
    for i, text in rows:
        spaced = " " + (text or "")
        a, b = whole.encode(spaced, add_special_tokens=False), pieces.encode(text or "", out_type=int)
        spelled = [pieces.id_to_piece(x) for x in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(b, spelled, strict=True)]
        ends_b = np.cumsum([len(p) for p in bytes_b]).tolist()
        lengths = [len(token) for token in a.tokens]  # each character of a byte-level token is a byte
        ends_a = np.cumsum(lengths).tolist()
        same = characters.decode(a.tokens) == spaced and b"".join(bytes_b) == spaced.encode()
        texts.append((i, a.ids, ends_a, b, ends_b) if text and same else (i, [], [], [], []))
    links = []
    for _, a, ends_a, b, ends_b in texts:
        starts_a, starts_b = [0, *ends_a][:-1], [0, *ends_b][:-1]
        own = []
        for x, low, high in zip(a, starts_a, ends_a, strict=True):
            first = bisect_right(ends_b, low)
            for j in range(first, len(b)):
                if starts_b[j] >= high:
                    break
                own.append((x, b[j]))
        links.append(own)
    counts = Counter(link for own in links for link in own)
    highest = {}
    for (_, y), n in counts.items():
        highest[y] = max(highest.get(y, 0), n)
    result = []
    for (i, a, ends_a, b, ends_b), own in zip(texts, links, strict=True):
        groups, k, m = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = bisect_right(ends_a, end), bisect_right(ends_b, end)
            groups.append(f"{','.join(map(str, a[k:to_a]))}|{','.join(map(str, b[m:to_b]))}")
            k, m = to_a, to_b
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[link] == highest[link[1]] for link in own)
        result.append((i, len(a), len(b), len(groups), len(own), best, sum(counts[link] for link in own), digest))
    return result, counts, highest


@pytest.mark.parametrize("block_tokens", [40, alignment.BLOCK_TOKENS])
def test_figures_and_pairs_equal_brute_force(spark, block_tokens):
    rows = [(i, text if text is None else text[:20_000]) for i, text in ROWS] + MORE
    want, counts, highest = brute_force(rows)
    figures, pairs = alignment.alignment(documents(spark, rows).repartition(3), *PATHS, Workspace(spark, "t"), block_tokens)
    assert figures.columns == ["doc_id", *FIGURES]
    assert sorted(map(tuple, figures.collect()), key=str) == sorted(want, key=str)
    zeros = {r[0] for r in want if r[1:] == (0, 0, 0, 0, 0, 0, "")}
    assert {4, 5, 22} <= zeros and not {20, 24} & zeros
    found = {(r.id_a, r.id_b): (r.n, r.best) for r in pairs.collect()}
    assert found == {pair: (n, n == highest[pair[1]]) for pair, n in counts.items()}


def test_groups_and_links_of_random_cuts():
    rng = random.Random(5)
    size = [0, 1, 2, 3, 4, 5]
    for _ in range(500):
        sides = []
        total = rng.randint(1, 40)
        for _ in range(2):
            ids, left = [], total
            while left:
                ids.append(rng.randint(1, min(5, left)))
                left -= ids[-1]
            sides.append(ids)
        (a, b), ends = sides, [np.cumsum(ids).tolist() for ids in sides]
        to_a, to_b = alignment.common_ends(*ends)
        groups = [(a[i:k], b[j:m]) for i, k, j, m in zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)]
        assert alignment.common_ends(*ends, 7, 9) == ([i + 7 for i in to_a], [i + 9 for i in to_b])
        assert [x for left, _ in groups for x in left] == a and [y for _, right in groups for y in right] == b
        assert len(groups) == len(set(ends[0]) & set(ends[1]))
        links = [link for left, right in groups for link in alignment.group_links(left, right, size, size)]
        want = [
            (x, y) for x, end in zip(a, ends[0], strict=True) for y, other in zip(b, ends[1], strict=True) if max(end - x, other - y) < min(end, other)
        ]
        assert links == want


def test_empty_table_and_texts_without_tokens(spark):
    figures, pairs = alignment.alignment(no_documents(spark), *PATHS, Workspace(spark, "t"))
    assert figures.count() == pairs.count() == 0
    figures, pairs = alignment.alignment(documents(spark, [(1, None), (None, "")]), *PATHS, Workspace(spark, "t"))
    assert sorted(map(tuple, figures.collect()), key=str) == [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")]
    assert pairs.count() == 0


def test_bytes_of_ids():
    tokens = alignment.byte_level_tokens(PATHS[0])
    whole = Tokenizer.from_file(PATHS[0])
    assert b"".join(tokens[i] for i in whole.encode("Ünï 日本\n\x00\x7f\xad").ids) == "Ünï 日本\n\x00\x7f\xad".encode()
    assert sorted(token for token in tokens if len(token) == 1) == [bytes([i]) for i in range(256)]
    assert tokens[50256] == b"<|endoftext|>"


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.op13_alignment(spark, sf).collect())) == sorted(brute_force(rows)[0])


def test_a_row_holds_part_of_a_block(spark):
    texts = [(i, "the cat sat on the mat " * 500 + f"word{i}") for i in range(100)]
    blocks = alignment.aligned_blocks(documents(spark, texts).coalesce(1), *PATHS).toPandas()
    parts = blocks[blocks.kind == alignment._PART]
    assert blocks.block.nunique() == 1 and len(blocks) == len(parts) + 1
    assert sorted(i for ids in parts.doc_ids for i in ids) == list(range(100))
    sizes = [len(own) // 4 for own in parts.groups]
    assert max(sizes) <= alignment.PART_GROUPS < sum(sizes)


def test_row_groups_of_blocks_have_few_rows(spark):
    space = Workspace(spark, "t")
    rows = [(i, f"text {i} of a few words") for i in range(200)]
    figures, _ = alignment.alignment(documents(spark, rows).coalesce(1), *PATHS, space, 1)
    assert figures.count() == 200
    metadata = [pq.ParquetFile(path).metadata for path in glob.glob(f"{space.root.removeprefix('file:')}/blocks/*.parquet")]
    groups = [own.row_group(i) for own in metadata for i in range(own.num_row_groups)]
    assert sum(own.num_rows for own in groups) > 1 and max(own.num_rows for own in groups) <= 32
    assert not any("DICT" in encoding for own in groups for encoding in own.column(8).encodings)


def test_batches_to_python_are_bounded_while_a_table_is_written(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 2000, 1, 1).selectExpr("id doc_id", "repeat('a b ', 250) text")
    sizes = lambda batches: (pa.record_batch([pa.array([b.num_rows], pa.int64())], names=["n"]) for b in batches)
    before, space = spark.conf.get(key, None), Workspace(spark, "t")
    small = [r.n for r in space.table("small", docs.mapInArrow(sizes, "n long"), 1 << 17).collect()]
    assert sum(small) == 2000 and max(small) <= 200
    assert spark.conf.get(key, None) == before
    whole = [r.n for r in space.table("whole", docs.mapInArrow(sizes, "n long")).collect()]
    assert max(whole) == 2000


def test_groups_that_are_forgotten_change_no_links(monkeypatch):
    rows = [(i, text if text is None else text[:2000]) for i, text in ROWS] + MORE
    whole = type("Docs", (), {"mapInArrow": lambda self, align, layout: align})()
    monkeypatch.setattr(alignment, "documents", lambda docs: docs)
    monkeypatch.setattr(alignment, "TaskContext", type("Context", (), {"get": classmethod(lambda cls: cls), "partitionId": lambda: 3}))

    def links_of(remembered):
        monkeypatch.setattr(alignment, "REMEMBERED_GROUPS", remembered)
        monkeypatch.setattr(alignment, "_SLICE_BYTES", 60)
        align = alignment.aligned_blocks(whole, *PATHS)
        batches = [pa.record_batch([pa.array(own) for own in zip(*part, strict=True)], names=["doc_id", "text"]) for part in (rows[:7], rows[7:])]
        found, held, dictionaries = [], [], 0
        for row in (row for batch in align(iter(batches)) for row in batch.to_pylist()):
            if row["kind"] == alignment._PART:
                held.append(row)
                continue
            dictionaries += 1
            sizes, place = (np.frombuffer(row[name], dtype="<u4") for name in ("group_links", "link_pairs"))
            of_group = np.split(np.array(row["pairs"], dtype=np.int64)[place], np.cumsum(sizes)[:-1]) if len(sizes) else []
            for part in held:
                groups, n = np.frombuffer(part["groups"], dtype="<u4"), np.frombuffer(part["n_groups"], dtype="<i8")
                for i, own, digest in zip(part["doc_ids"], np.split(groups, np.cumsum(n)[:-1]), part["digests"], strict=True):
                    found.append((i, [pair for group in own for pair in of_group[group].tolist()], digest))
            held = []
        assert not held
        return found, dictionaries

    (once, one), (often, many) = links_of(1_000_000), links_of(3)
    assert once == often and one == 1 < many


def test_tasks_of_a_worker_share_the_tokenizers():
    assert alignment.kept_stretches(*PATHS) is alignment.kept_stretches(*PATHS)
