import random
import zlib

import numpy as np
import pytest
import tokenizers
from edge_cases import ROWS, documents, no_documents
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlens.llm import packing, queries
from ledgerlens.llm.tokens import encoder, vocabulary_path

PATH = vocabulary_path("word_bpe_49k.json")


def test_binary_lengths():
    for n in (*range(1, 70), 2047, 2048, 2049, 10_000):
        lengths = packing.binary_lengths(n, 2048)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(length & (length - 1) == 0 and length <= 2048 for length in lengths)
        assert len(lengths) == n // 2048 + (n % 2048).bit_count()


def test_pieces_hold_each_id_once(spark):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    want = sorted(((i, [*whole.encode(text or "", add_special_tokens=False).ids, 1]) for i, text in ROWS), key=str)
    pieces = packing.binary_pieces(documents(spark).repartition(3), PATH)
    rows = pieces.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.offset == 0 and len(r.ids) == 4 * r.length <= 4 * 2048 for r in rows)
    found, open_texts = [], {}
    for r in sorted(rows, key=lambda r: r.sequence_id):
        ids = open_texts.setdefault((r.doc_id, r.doc_tokens), [])
        assert r.start == len(ids)
        ids.extend(np.frombuffer(r.ids, dtype="<u4").tolist())
        if len(ids) == r.doc_tokens:
            found.append((r.doc_id, open_texts.pop((r.doc_id, r.doc_tokens))))
    assert not open_texts
    assert sorted(found, key=str) == want
    for d, r in zip(packing.pieces_digest(pieces).orderBy("sequence_id").collect(), sorted(rows, key=lambda r: r.sequence_id), strict=True):
        assert d.ids_crc32 == zlib.crc32(r.ids)
    assert packing.binary_pieces(no_documents(spark), PATH).count() == 0


def test_buckets_are_written_by_length(spark, tmp_path):
    pieces = packing.binary_pieces(documents(spark), PATH, max_tokens=64)
    packing.write_buckets(pieces, str(tmp_path / "packed"))
    back = spark.read.parquet(str(tmp_path / "packed"))
    assert back.count() == pieces.count()
    assert back.where("length = 64 AND octet_length(ids) <> 256").count() == 0


def test_query_and_pipeline_read_what_is_bucketed(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset"]
    want = sorted(map(tuple, packing.pieces_digest(packing.binary_pieces(docs, PATH)).select(*columns).collect()))
    for found in (queries.op6_packing(spark, sf), corpus_pipeline.pack(spark, docs, sf)):
        files = found.inputFiles()
        assert files and all("/buckets/length=" in file for file in files)
        assert sorted(map(tuple, found.select(*columns).collect())) == want
        assert dict(found.dtypes)["length"] == "bigint"
        folder = files[0].split("/length=")[0]
        for length in (1, 64, 2048):
            rows = spark.read.parquet(f"{folder}/length={length}").collect()
            assert rows and all(len(r.ids) == 4 * length for r in rows)
    assert packing.bucketed_digest(packing.binary_pieces(no_documents(spark), PATH), f"{folder}-empty").count() == 0


@pytest.mark.parametrize("cache_units", [5, 500_000])
def test_latin_letters_in_any_case_give_the_ids_of_whole_texts(cache_units):
    rng = random.Random(6)
    letters = [chr(c) for c in range(0xC0, 0x250)]
    parts = [*letters, *"aZ'.-&_9 \t\x00\u0331\u0301\u0307\u212b", "The", "THE", "日", "'S"]
    texts = ["", " ", *letters, *("x" + c for c in letters), *("(" + c + "H\u0331" for c in letters)]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    encode = encoder(PATH, True, cache_units)
    for low in range(0, len(texts), 250):
        ids, counts = encode([text.encode() for text in texts[low : low + 250]])
        ends = np.cumsum(counts)
        for text, end, n in zip(texts[low : low + 250], ends, counts, strict=True):
            assert ids[end - n : end].tolist() == whole.encode(text, add_special_tokens=False).ids, text
    ids, counts = encode([b"", b" \n"])
    assert not len(ids) and counts.tolist() == [0, 0]


def test_words_go_to_the_library_once_whatever_case_and_marks(monkeypatch):
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
    encode = encoder(PATH, True)
    encode([b"Word, word. WORD", "(word) début-word".encode()])
    encode([b"word; Word"])
    words = [word for text in given for word in (text.split("\n") if isinstance(text, str) else text)]
    # A piece that begins a unit and one that does not are told apart by the space before the first.
    assert sorted(set(words)) == sorted({"word", "dÃ©but", "(", ")", ",", ".", "-", ";"}) and words.count("word") <= 2
