"""Packing by power-of-two decomposition.

A document of n ids is cut, from its start, into as many pieces of `max_tokens` as fit and then into the powers of two of
what is left, largest first. Every piece is a sequence of its own and its length is a power of two, so equal lengths
are batched together, nothing is padded, and no sequence crosses documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import arrow_schema, byte_texts, documents, record_batch
from ledgerlens.llm.tokens import kept_encoder, text_slices

MAX_TOKENS = 2048
END_ID = 1

_PIECES = "doc_id long, doc_tokens long, start long, length long, ids binary"


def binary_lengths(n: int, most: int) -> list[int]:
    """Powers of two that sum to n, falling, none above `most` (itself one): the 1-bits of n, and `most` repeated."""
    whole, rest = divmod(n, most)
    return [most] * whole + [1 << bit for bit in range(most.bit_length() - 2, -1, -1) if rest >> bit & 1]


def binary_pieces(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """doc_id, doc_tokens, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset: one row per piece.

    `vocabulary` is the path of a `tokenizers` file whose tokenizer drops white space. NULL text is empty and gives the
    end id alone. NULL doc_ids and repeated rows are kept: each row is a document. An empty table gives no rows; other
    columns are ignored. One pass over the texts, no shuffle; sequence ids are unique and rise within a task, and
    `offset` is always 0 because a sequence holds one piece.
    """
    if max_tokens & (max_tokens - 1):
        raise ValueError("max_tokens must be a power of two")
    layout = arrow_schema(_PIECES)
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_encoder(vocabulary, blanks_dropped=True)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for low, high in text_slices(texts):
                rows = []
                found, counts = encode(texts[low:high])
                packed, stop = found.astype("<u4").tobytes(), 0
                for doc_id, count in zip(doc_ids[low:high], counts.tolist(), strict=True):
                    ids = packed[4 * stop : 4 * (stop + count)] + end
                    stop += count
                    start, total = 0, count + 1
                    for length in binary_lengths(total, max_tokens):
                        rows.append((doc_id, total, start, length, ids[4 * start : 4 * (start + length)]))
                        start += length
                yield record_batch(dict(zip(layout.names, zip(*rows, strict=True), strict=True)), layout)

    pieces = documents(docs).mapInArrow(cut, _PIECES)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Files by sequence length: a reader of one folder gets batches of equal lengths. A length's rows stay in the
    files of their tasks, so a length that holds most of the pieces is no hot key."""
    pieces.write.mode("overwrite").option("compression", "zstd").partitionBy("length").parquet(path)


def read_buckets(pieces: DataFrame, path: str) -> DataFrame:
    """What `write_buckets` has written of `pieces`; the columns are as there."""
    return pieces.sparkSession.read.schema(pieces.schema).parquet(path).select(pieces.columns)


def bucketed_digest(pieces: DataFrame, path: str) -> DataFrame:
    """Writes the pieces by length and gives the digest of what is read back."""
    write_buckets(pieces, path)
    return pieces_digest(read_buckets(pieces, path))


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
