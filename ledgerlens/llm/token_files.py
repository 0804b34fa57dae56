"""Token ids as files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

An id is replaced by its rank, the most frequent id being 0. A rank takes 1 to 4 bytes, little-endian, in the data
stream; its length minus one takes two bits of the control stream, four ranks to a control byte, the first in the lowest
bits. A block holds the ranks of consecutive documents. Blocks are rows of Parquet files (so that Spark commits, splits and
places them), in ascending doc_id order:

    part int, block int      order of the blocks
    doc_ids binary           int64 per document; no_id binary: one byte per document, 1 for a NULL doc_id
    lengths binary           int64 per document: its ids
    total long               ids in the block
    control binary, data binary

The rank table (rank, id) lies beside them. Decoding looks up the four lengths of each control byte in a table of 256 rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, record_batch
from ledgerlens.llm.tokens import kept_encoder, text_slices

END_ID = 2
BLOCK_TOKENS = 1 << 20

_TOKENS = "doc_id long, n_tokens long, ids binary, counts binary"
_BLOCKS = "part int, block int, doc_ids binary, no_id binary, lengths binary, total long, control binary, data binary"
_READ = "part int, block int, doc_id long, local_start long, n_tokens long, ids binary"
_DIGEST = "part int, block int, doc_id long, local_start long, n_tokens long, ids_crc32 long"

#: Lengths in bytes of the four values of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8) + 1
_BYTE = np.arange(4, dtype=np.uint8)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit values. The last control byte is filled with zero bits."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    quads[: len(values)] = extra
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    data = values.view(np.uint8).reshape(-1, 4)[_BYTE <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, count: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    values = np.zeros((count, 4), dtype=np.uint8)
    values[_BYTE < lengths[:, None]] = np.frombuffer(data, dtype=np.uint8)
    return values.reshape(-1).view("<u4")


def tokenised(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, ids (the end id last; little-endian, unsigned, of two bytes each where all ids fit and
    four otherwise). The last row of each task has only `counts`: pairs of an id and how often the task wrote it, as
    64-bit integers."""
    layout, width = arrow_schema(_TOKENS), id_width(vocabulary, end_id)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_encoder(vocabulary, blanks_dropped=False)
        end = end_id.to_bytes(width, "little")
        seen = np.zeros(end_id + 1, dtype=np.int64)
        for batch in batches:
            doc_ids, texts = batch.column(0), byte_texts(batch.column(1))
            for low, high in text_slices(texts):
                found, counts = encode(texts[low:high])
                own = np.bincount(found, minlength=len(seen))
                own[: len(seen)] += seen
                own[end_id] += high - low
                seen = own
                packed, stops = found.astype(f"<u{width}").tobytes(), (width * np.cumsum(counts)).tolist()
                ids = [packed[i:j] + end for i, j in zip([0, *stops[:-1]], stops, strict=True)]
                columns = {"doc_id": doc_ids.slice(low, high - low).to_pylist(), "n_tokens": counts + 1, "ids": ids, "counts": [None] * len(ids)}
                yield record_batch(columns, layout)
        known = np.flatnonzero(seen)
        pairs = np.column_stack([known, seen[known]]).astype("<i8").tobytes()
        yield record_batch({"doc_id": [None], "n_tokens": [None], "ids": [None], "counts": [pairs]}, layout)

    return documents(docs).mapInArrow(tokenise, _TOKENS)


def id_width(vocabulary: str, end_id: int) -> int:
    """Bytes of an id in the table of tokens."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def id_ranks(tokens: DataFrame) -> DataFrame:
    """(rank, id, n) over all documents, the most frequent id first, ties by id; one row per id of the vocabulary that
    occurs. Each task counted its own."""
    layout = arrow_schema("id long, n long")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs in batch.column(0).to_pylist():
                id_, n = np.frombuffer(pairs, dtype="<i8").reshape(-1, 2).T
                yield record_batch({"id": id_.copy(), "n": n.copy()}, layout)

    counts = tokens.where("counts IS NOT NULL").select("counts").mapInArrow(unpack, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)
    return ranked.select("rank", "id", "n")


def write_token_files(tokens: DataFrame, space: Workspace, width: int, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Writes a table of tokens (with a number `row` of their own), with ids of `width` bytes, as blocks in doc_id order (NULL first) and the rank table; returns both as read back.

    The rank table has one row per vocabulary entry, so it is small whatever the documents are, and goes to the tasks as
    an array. Range partitions hold consecutive ids; a document longer than a block has a block of its own.
    """
    spark = tokens.sparkSession
    table = space.table("ranks", id_ranks(tokens))
    known = sorted((row["id"], row["rank"]) for row in table.collect())
    rank_of = np.zeros(known[-1][0] + 1 if known else 1, dtype=np.uint32)
    for id_, rank in known:
        rank_of[id_] = rank
    shared, layout = spark.sparkContext.broadcast(rank_of), arrow_schema(_BLOCKS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rank_of = TaskContext.get().partitionId(), 0, shared.value
        held: list[tuple] = []
        total = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join([own for _, own in held]), dtype=f"<u{width}")
            control, data = encode_values(rank_of[ids])
            columns = {
                "part": [part],
                "block": [number],
                "doc_ids": [np.array([i or 0 for i, _ in held], dtype="<i8").tobytes()],
                "no_id": [bytes(i is None for i, _ in held)],
                "lengths": [np.array([len(own) // width for _, own in held], dtype="<i8").tobytes()],
                "total": [total],
                "control": [control],
                "data": [data],
            }
            return record_batch(columns, layout)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and total + len(ids) // width > block_tokens:
                    yield block()
                    number, held, total = number + 1, [], 0
                held.append((doc_id, ids))
                total += len(ids) // width
        if held:
            yield block()

    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rows of one id, or without, are told apart by a hash of their ids and by their number, so that any mass of them is cut.
    order = ["doc_id", F.xxhash64("ids"), "row"]
    texts = tokens.where("counts IS NULL").select("doc_id", "ids", "row")
    ordered = texts.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    return space.table("files", ordered.mapInArrow(encode, _BLOCKS)), table


def _positions(files: DataFrame) -> DataFrame:
    """(part, block, base): ids in all blocks before. Light columns only; one row per part meets in a single task."""
    parts = files.groupBy("part").agg(F.sum("total").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    ahead = Window.partitionBy("part").orderBy("block")
    blocks = files.select("part", "block", (F.sum("total").over(ahead) - F.col("total")).alias("inside"))
    return blocks.join(before, "part").select("part", "block", (F.col("before") + F.col("inside")).alias("base"))


def _decoded(files: DataFrame, ranks: DataFrame, with_ids: bool) -> DataFrame:
    known = sorted((row["rank"], row["id"]) for row in ranks.collect())
    shared = files.sparkSession.sparkContext.broadcast(np.array([id_ for _, id_ in known], dtype="<u4"))
    layout = arrow_schema(_READ if with_ids else _DIGEST)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                ids = id_of[decode_values(block["control"], block["data"], block["total"])]
                lengths = np.frombuffer(block["lengths"], dtype="<i8")
                ends = np.cumsum(lengths)
                doc_ids, none = np.frombuffer(block["doc_ids"], dtype="<i8").tolist(), block["no_id"]
                packed = memoryview(ids.tobytes())
                slices = [packed[4 * (end - n) : 4 * end] for n, end in zip(lengths.tolist(), ends.tolist(), strict=True)]
                columns = {
                    "part": [block["part"]] * len(lengths),
                    "block": [block["block"]] * len(lengths),
                    "doc_id": [None if gone else i for i, gone in zip(doc_ids, none, strict=True)],
                    "local_start": ends - lengths,
                    "n_tokens": lengths,
                }
                columns |= {"ids": [bytes(s) for s in slices]} if with_ids else {"ids_crc32": [zlib.crc32(s) for s in slices]}
                yield record_batch(columns, layout)

    return files.mapInArrow(decode, _READ if with_ids else _DIGEST)


def read_token_files(files: DataFrame, ranks: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and ids (or only their crc32) per document, from the files."""
    found = _decoded(files, ranks, with_ids).join(_positions(files), ["part", "block"])
    return found.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids" if with_ids else "ids_crc32")


def token_file_roundtrip(docs: DataFrame, vocabulary: str, space: Workspace, *, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS, with_ids: bool = False) -> DataFrame:
    """Encodes every text, writes the files and reads them back.

    NULL text is empty and gives the end id alone. Rows with a NULL doc_id come first; repeated rows are documents of
    their own, those of one doc_id ordered by a hash of their ids. An empty table gives no rows; other columns are ignored.
    """
    tokens = space.table("tokens", tokenised(docs, vocabulary, end_id).withColumn("row", F.monotonically_increasing_id()))
    files, ranks = write_token_files(tokens, space, id_width(vocabulary, end_id), block_tokens)
    space.drop("tokens")
    return read_token_files(files, ranks, with_ids)


def load_token_files(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The blocks and ranks that a workspace holds."""
    return spark.read.parquet(f"{root}/files"), spark.read.parquet(f"{root}/ranks")
