"""Exact dedup with an extendible-hash index on shared files.

1. Every scan task combines equal texts and writes one *entry* per distinct text: hash key, bytes, ids.
2. A directory is built from the weights of key prefixes: it starts with one bucket; an overfull bucket is split by its
   next key bit, and the directory doubles when that needs one more bit than it has.
3. Owner tasks take whole buckets, that is key ranges. They walk the entries of a key, chain those that collide with
   other bytes, and write the index: which text of the chain an entry holds, the document that stays, the group's size.
4. Ids find their group through their entry, a join on entries that are as small as their task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, record_batch

BUCKET_BYTES = 16 << 20
MAX_DEPTH = 16
ENTRY_BATCH_BYTES = 32 << 20
ENTRY_BATCH_IDS = 100_000
#: Entries leave a task in Arrow batches of about so many bytes.
SENT_BYTES = 4 << 20

_ENTRIES = "entry long, key long, sha string, least long, copies long, ids array<long>, text binary"
_INDEX = "entry long, bucket int, key long, chain int, sha string, keep_id long, group_size long, keeper boolean"


def normalised(text: bytes) -> bytes:
    """Runs of ASCII blanks as one space, at the ends too."""
    words = text.split()
    if not words:
        return b" " if text else b""
    head = b" " if text[:1].isspace() else b""
    tail = b" " if text[-1:].isspace() else b""
    return head + b" ".join(words) + tail


def text_key(text: bytes) -> int:
    """The 64-bit hash key, signed as Spark stores it. Texts that collide are told apart by their bytes."""
    return int(np.uint64(xxhash.xxh64_intdigest(text)).view(np.int64))


def entries(docs: DataFrame, key=text_key, batch_bytes: int = ENTRY_BATCH_BYTES) -> DataFrame:
    """One row per distinct text of a scan task, with its ids in order, NULL last. A task that meets more than
    `batch_bytes` of text starts anew; owners join the parts."""
    layout = arrow_schema(_ENTRIES)
    large = (1 << 63) - 1

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 33
        seen: dict[bytes, list] = {}
        held = rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made, held, rows
            while seen:
                part, size = [], 0
                while seen and size < SENT_BYTES:
                    text, ids = seen.popitem()
                    ids.sort(key=lambda i: large if i is None else i)
                    part.append((text, ids))
                    size += len(text) + 8 * len(ids)
                columns = {
                    "entry": range(made, made + len(part)),
                    "key": [key(text) for text, _ in part],
                    "sha": [hashlib.sha256(text).hexdigest() for text, _ in part],
                    "least": [ids[0] for _, ids in part],
                    "copies": [len(ids) for _, ids in part],
                    "ids": [ids for _, ids in part],
                    "text": [text for text, _ in part],
                }
                made += len(part)
                yield record_batch(columns, layout)
            held = rows = 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                text = normalised(text)
                ids = seen.get(text)
                if ids is None:
                    seen[text] = [doc_id]
                    held += len(text) + 100
                else:
                    ids.append(doc_id)
                rows += 1
                if held >= batch_bytes or rows >= ENTRY_BATCH_IDS:
                    yield from flush()
        if seen:
            yield from flush()

    return documents(docs).mapInArrow(combine, _ENTRIES)


def build_directory(weights: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """(directory, global depth) for the weights of all prefixes of log2(len(weights)) bits.

    `directory[p]` is the bucket of the keys whose leading `global depth` bits are p. A bucket stays overfull only at
    the full prefix length, or when one prefix holds all of its weight: copies of one key cannot be split.
    """
    most = int(len(weights)).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(weights)])

    def weight(depth: int, prefix: int) -> int:
        width = most - depth
        return int(total[(prefix + 1) << width] - total[prefix << width])

    depth, directory, buckets, overfull = 0, np.zeros(1, dtype=np.int32), [(0, 0)], [0]
    while overfull:
        bucket = overfull.pop()
        local, prefix = buckets[bucket]
        inside = weights[prefix << (most - local) : (prefix + 1) << (most - local)]
        if local == most or weight(local, prefix) <= capacity or np.count_nonzero(inside) <= 1:
            continue
        if local == depth:
            directory, depth = np.repeat(directory, 2), depth + 1
        buckets[bucket] = (local + 1, 2 * prefix)
        buckets.append((local + 1, 2 * prefix + 1))
        width = depth - local - 1
        directory[(2 * prefix + 1) << width : (2 * prefix + 2) << width] = len(buckets) - 1
        overfull += [bucket, len(buckets) - 1]
    return directory, depth


def key_directory(found: DataFrame, bucket_bytes: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH) -> tuple[np.ndarray, int]:
    """The directory for a table of entries. Its size is bounded by 2^max_depth, and so is what the driver gets:
    one weight per prefix. Buckets are smaller than `bucket_bytes` where that leaves shuffle partitions without any, and
    grow with the table once 2^max_depth would be too few."""
    prefix = F.expr(f"shiftrightunsigned(key, {64 - max_depth})").cast("int")
    rows = found.groupBy(prefix.alias("prefix")).agg(F.sum(F.octet_length("text") + 100).alias("bytes")).collect()
    weights = np.zeros(1 << max_depth, dtype=np.int64)
    for row in rows:
        weights[row["prefix"]] = row["bytes"]
    total = int(weights.sum())
    owners = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return build_directory(weights, max(min(bucket_bytes, total // (2 * owners)), total >> (max_depth - 2)))


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains the entries of each key by their bytes. Holds one key at a time: its distinct texts, and a number per entry."""
    layout = arrow_schema(_INDEX)
    rows: list[tuple] = []
    chain: list[list] = []  # bytes, sha, (least id, entry) of the keeper, size, entries
    at: tuple[int, int] | None = None
    last = (1, 0)

    def close() -> None:
        bucket, key = at
        for place, (_, sha, keeper, size, own) in enumerate(chain):
            keep_id = keeper[0][1] if keeper[0] != last else None
            rows.extend((entry, bucket, key, place, sha, keep_id, size, entry == keeper[1]) for entry in own)

    def batch() -> pa.RecordBatch:
        columns = dict(zip(layout.names, zip(*rows, strict=True), strict=True))
        return record_batch(columns, layout)

    for part in batches:
        names = part.schema.names
        for row in zip(*[part.column(names.index(n)).to_pylist() for n in ("bucket", "key", "entry", "sha", "least", "copies", "text")], strict=True):
            bucket, key, entry, sha, least, copies, text = row
            if at != (bucket, key):
                if at is not None:
                    close()
                at, chain = (bucket, key), []
                if len(rows) >= 20_000:
                    yield batch()
                    rows.clear()
            rank = ((0, least) if least is not None else last, entry)
            for link in chain:
                if link[0] == text:
                    link[2] = min(link[2], rank)
                    link[3] += copies
                    link[4].append(entry)
                    break
            else:
                chain.append([text, sha, rank, copies, [entry]])
    if at is not None:
        close()
    if rows:
        yield batch()


def build_index(found: DataFrame, space: Workspace, bucket_bytes: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The index over a written table of entries: one row per entry, in files of whole buckets."""
    directory, depth = key_directory(found, bucket_bytes, max_depth)
    slots = found.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(directory)], "slot int, bucket int")
    slot = F.expr(f"shiftrightunsigned(key, {64 - depth})").cast("int") if depth else F.lit(0)
    owned = (
        found.drop("ids")
        .withColumn("slot", slot)
        .join(F.broadcast(slots), "slot")  # at most 2^max_depth rows of two ints
        .drop("slot")
        .repartition(max(1, int(directory.max()) + 1), "bucket")
        .sortWithinPartitions("bucket", "key", "entry")
    )
    return space.table("index", owned.mapInArrow(_resolve, _INDEX))


def exact_groups(docs: DataFrame, space: Workspace, *, bucket_bytes: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH, key=text_key) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and chain for every row of `docs`, dropped ones too.

    Texts are equal when their bytes are, after each run of ASCII blanks became one space. NULL counts as the empty
    text, which differs from a text of blanks only. The smallest doc_id of a group stays, NULL being larger than any
    id; of repeated rows with that id exactly one is kept. `chain` numbers the different texts of one hash key.
    An empty table gives no rows; other columns are ignored.

    Texts are shuffled once, after copies within a scan task were combined, so a group with a third of all rows
    reaches its owner as one entry per task, and is walked as a stream.
    """
    found = space.table("entries", entries(docs, key))
    index = build_index(found, space, bucket_bytes, max_depth)
    ids = found.select("entry", F.posexplode("ids").alias("place", "doc_id"))
    return ids.join(index.drop("bucket", "key"), "entry").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("keeper") & (F.col("place") == 0)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "chain",
    )


def drop_copies(docs: DataFrame, space: Workspace, **options) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one per group, that with the smallest doc_id.

    Rows with the same doc_id and equal texts are copies of each other; which of them stays is open."""
    kept = exact_groups(docs, space, **options).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    blanks = F.regexp_replace(F.coalesce(docs["text"].cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("_id"), F.sha2(blanks.cast("binary"), 256).alias("_sha"),
        F.struct(*[docs[name] for name in docs.columns]).alias("row"),
    )
    same = rows["_id"].eqNullSafe(kept["_id"]) & (rows["_sha"] == kept["_sha"])
    staying = rows.join(kept, same, "left_semi").groupBy("_id", "_sha").agg(F.first("row").alias("row"))
    return staying.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])
