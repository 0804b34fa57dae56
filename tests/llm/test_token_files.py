import random
import zlib

import numpy as np
import pytest
from edge_cases import ROWS, documents, no_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import token_files
from ledgerlens.llm.common import Workspace
from ledgerlens.llm.tokens import bytes_of, encoder, plain_runs, vocabulary_path

PATH = vocabulary_path("byte_bpe_50k.json")


@pytest.mark.parametrize("top", [2, 1 << 8, 1 << 16, 1 << 24, 1 << 32])
@pytest.mark.parametrize("count", [0, 1, 3, 4, 5, 1001])
def test_values_round_trip(top, count):
    values = np.random.default_rng(count).integers(0, top, count, dtype=np.uint32)
    control, data = token_files.encode_values(values)
    assert len(control) == -(-count // 4)
    assert len(data) == sum(1 + (v > 0xFF) + (v > 0xFFFF) + (v > 0xFFFFFF) for v in values.tolist())
    assert np.array_equal(token_files.decode_values(control, data, count), values)


@pytest.mark.parametrize(("name", "blanks_dropped"), [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_units_give_the_ids_of_whole_texts(name, blanks_dropped):
    rng = random.Random(3)
    parts = ["a", "B", "é", " ", "  ", "\n", "\t", "\x0b", "\x1c", "　", "\xa0", "1", "!", "'s", "'", "the", "ß", "İ", "́", "<|endoftext|>", "日本", "😀", "\x85", "Σ", "\x00", "ª", ".", " the", "\r\n", "-"]
    texts = [text or "" for _, text in ROWS] + ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5000)]
    whole = Tokenizer.from_file(vocabulary_path(name))
    whole.encode_special_tokens = True
    encode = encoder(vocabulary_path(name), blanks_dropped)
    for low in range(0, len(texts), 500):
        part = texts[low : low + 500]
        ids, counts = encode([t.encode() for t in part])
        ends = np.cumsum(counts)
        for text, end, n in zip(part, ends, counts, strict=True):
            assert ids[end - n : end].tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_plain_units_are_cut_into_the_pieces_of_the_tokenizer():
    rng = random.Random(5)
    parts = [*"aZé×÷ÿĀɏɐ9١.,-!'_\n\t", "\u0301", "日", "\x00", "ª", "the", "Straße", "\x85"]
    units = list(dict.fromkeys("".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in range(20_000)))
    whole = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    plain, pieces, counts = plain_runs([unit.encode() for unit in units])
    cut = iter(bytes_of(pieces))
    counts = iter(counts.tolist())
    for unit, own in zip(units, plain.tolist(), strict=True):
        lines = "\n\n" in unit or unit[:1] == "\n" or unit[-1:] == "\n"
        assert own == (bool(unit) and not lines and set(unit) <= set("aZéÿĀɏ9.,-!_\ntheSraß")), unit
        if own:
            # The tokenizer tells pieces by places in characters.
            found = [(" " + unit)[low:high] for _, (low, high) in whole.pre_tokenizer.pre_tokenize_str(" " + unit)]
            assert [next(cut).decode() for _ in range(next(counts))] == found, unit
    assert next(cut, None) is None and sum(plain.tolist()) > 1000


def test_pieces_of_units_go_to_the_library_once(monkeypatch):
    import tokenizers

    given = []

    class Counted:
        def __init__(self, model):
            self.own = Tokenizer(model)

        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return self.own.encode_batch_fast(texts, **options)

        def __setattr__(self, name, value):
            object.__setattr__(self, name, value) if name == "own" else setattr(self.own, name, value)

        from_file = staticmethod(Tokenizer.from_file)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    encode = encoder(vocabulary_path("byte_bpe_50k.json"), False)
    encode(["x début, début.\nfin début! 12".encode(), b"x 12, fin fin."])
    pieces = [piece for text in given for piece in text.split("\n")]
    assert sorted(pieces) == sorted(["ĠdÃ©but", ",", ".", "Ċ", "fin", "!", "Ġ12", "Ġfin"])


def expected(rows):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    encoded = [(i, np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")) for i, t in rows]
    return sorted(encoded, key=lambda row: (row[0] is not None, row[0] or 0))


@pytest.mark.parametrize("block_tokens", [50, 1 << 20])
def test_files_give_back_every_document(spark, block_tokens):
    space = Workspace(spark, "t")
    found = token_files.token_file_roundtrip(documents(spark).repartition(5), PATH, space, block_tokens=block_tokens, with_ids=True)
    rows = sorted(found.collect(), key=lambda r: r.start)
    want = expected(ROWS)
    assert [r.doc_id for r in rows] == [i for i, _ in want]
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), ids.tobytes()) for i, ids in want)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    files, ranks = token_files.load_token_files(spark, space.root)
    assert files.where("part IS NULL OR total <> octet_length(lengths) AND octet_length(control) <> ceil(total / 4)").count() == 0
    counted = ranks.orderBy("rank").collect()
    every = np.concatenate([ids for _, ids in want])
    assert [r.n for r in counted] == sorted(np.bincount(every)[np.unique(every)].tolist(), reverse=True)
    digest = token_files.read_token_files(files, ranks, with_ids=False).collect()
    assert {(r.start, r.ids_crc32) for r in digest} == {(r.start, zlib.crc32(r.ids)) for r in rows}


def test_empty_table(spark):
    assert token_files.token_file_roundtrip(no_documents(spark), PATH, Workspace(spark, "t")).count() == 0


def test_a_third_of_all_rows_without_an_id_spreads_over_tasks(spark):
    rows = [(None, f"text {i % 3}") for i in range(1000)] + [(i, f"own text {i}") for i in range(2000)]
    space = Workspace(spark, "t")
    found = token_files.token_file_roundtrip(documents(spark, rows).repartition(5), PATH, space).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None] * 1000 + list(range(2000))
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1].tolist()]
    files, _ = token_files.load_token_files(spark, space.root)
    parts = [r["docs"] // 8 for r in files.groupBy("part").agg(F.sum(F.octet_length("lengths")).alias("docs")).collect()]
    assert sum(parts) == 3000 and len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(parts) < 2 * 3000 / len(parts)
