"""SimHash near-dedup with multi-index hashing.

A 64-bit fingerprint has two segments of 32 bits. Fingerprints that differ in at most three bits agree in one segment up to
one bit. So each fingerprint is filed under both its segment values and also asks, for each segment, the values of the
Hamming ball of radius one around its own. Of two values at distance one, one is the other with a bit cleared; asking
only such values finds every pair once. Whoever meets in a bucket is verified over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, record_batch, runs, with_partners, with_tiles
from ledgerlens.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
TILE_ROWS = 20_000

_FINGERPRINTS = "doc_id long, fingerprint long, seal long"
_EDGES = "a long, b long"
_PART_BYTES = 4 << 20

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)


def shingle_hashes(text: bytes, words_each: int) -> np.ndarray:
    """XXH64 of each shingle; shingles are slices of the words joined by single spaces."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= words_each:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    slices = map(joined.__getitem__, map(slice, begins[: len(words) - words_each + 1].tolist(), ends[words_each - 1 :].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, slices, repeat(SEED)), dtype=np.uint64, count=len(words) - words_each + 1)


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """A fingerprint for each array of hashes: the bits set in over half of them. None gives zero.

    Bits are counted by byte values: one histogram for each of the eight bytes, times the bits of each value.
    """
    counts = np.array([len(own) for own in hashes], dtype=np.int64)
    owner = np.repeat(np.arange(len(hashes)) * 256, counts)
    every = np.concatenate(hashes) if len(hashes) else np.empty(0, dtype=np.uint64)
    as_bytes = every.view(np.uint8).reshape(-1, 8)
    prints = np.zeros(len(hashes), dtype=np.uint64)
    for place in range(8):
        seen = np.bincount(owner + as_bytes[:, place], minlength=256 * len(hashes)).reshape(-1, 256)
        ones = seen @ _BITS
        value = ((2 * ones > counts[:, None]) @ (1 << np.arange(8))).astype(np.uint64)
        prints |= value << np.uint64(8 * place)
    return prints


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint and seal (XXH64 of the text; both signed longs) of every row; NULL text is empty."""
    layout = arrow_schema(_FINGERPRINTS)

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size, prints, seals = [], 0, [], []
            for text in byte_texts(batch.column(1)):
                seals.append(xxhash.xxh64_intdigest(text, SEED))
                held.append(shingle_hashes(text, words_each))
                size += len(text)
                if size >= _PART_BYTES or len(held) >= 1000:
                    prints.append(majority_bits(held))
                    held, size = [], 0
            prints.append(majority_bits(held))
            columns = {"fingerprint": np.concatenate(prints), "seal": np.array(seals, dtype=np.uint64)}
            yield record_batch({"doc_id": batch.column(0), **{name: own.view(np.int64) for name, own in columns.items()}}, layout)

    return documents(docs).mapInArrow(fingerprint, _FINGERPRINTS)


def reach(prints: np.ndarray, max_bits: int, across: np.ndarray | None = None) -> np.ndarray:
    """Label of each distinct fingerprint: the first of those it reaches through links.

    From each one found, the rest are compared at once and whoever links leaves the rest, so members of one close
    group cost one comparison each, not one per pair. With `across`, only pairs of different sides are compared.
    """
    label = np.full(len(prints), -1, dtype=np.int64)
    rest = np.arange(len(prints))
    while len(rest):
        root, rest = rest[0], rest[1:]
        label[root] = root
        found = [root]
        while found and len(rest):
            here = found.pop()
            near = np.bitwise_count(prints[rest] ^ prints[here]) <= max_bits
            if across is not None:
                near &= across[rest] != across[here]
            label[rest[near]] = root
            found += rest[near].tolist()
            rest = rest[~near]
    return label


def spanning_links(prints: DataFrame, max_bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): fingerprints connected by links of at most `max_bits` differing bits, enough of them to keep every
    component whole. `prints` has distinct fingerprints. A bucket is walked by one task; one with more than `tile_rows`
    members is cut into tiles, every pair of which meets."""
    if max_bits > 3:
        raise ValueError("two segments with balls of radius one find at most three differing bits")
    segment = lambda low: F.shiftrightunsigned(F.col("fingerprint"), low).bitwiseAND(F.lit(0xFFFFFFFF))

    def asked(number: int, low: int):
        value = segment(low)
        tag = F.lit(number << 32)
        own = F.array(F.struct((tag + value).alias("key"), F.lit(True).alias("filed")))
        set_bits = F.filter(F.array(*[F.lit(1 << i) for i in range(32)]), lambda bit: value.bitwiseAND(bit) != 0)
        ball = F.transform(set_bits, lambda bit: F.struct((tag + value - bit).alias("key"), F.lit(False).alias("filed")))
        return F.concat(own, ball)

    entries = prints.select("fingerprint", F.explode(F.concat(asked(0, 0), asked(1, 32))).alias("e")).select("e.key", "e.filed", "fingerprint")
    met = with_partners(entries, "key").select("key", "fingerprint", "rows")
    tiled = with_tiles(met, "key", "fingerprint", F.col("rows"), tile_rows).select("key", "lo", "hi", "tile", "fingerprint")
    dealt = tiled.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    layout = arrow_schema(_EDGES)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        for group in runs(batches, ["key", "lo", "hi"]):
            own = group["fingerprint"].view(np.uint64)
            # In a group of two tiles, only pairs across them are new; those inside meet in the tile's own group.
            label = reach(own, max_bits, group["tile"] if group["lo"][0] != group["hi"][0] else None)
            joined = label != np.arange(len(own))
            a.append(group["fingerprint"][label[joined]])
            b.append(group["fingerprint"][joined])
            held += int(joined.sum())
            if held >= 20_000:
                yield record_batch({"a": np.concatenate(a), "b": np.concatenate(b)}, layout)
                a, b, held = [], [], 0
        if held:
            yield record_batch({"a": np.concatenate(a), "b": np.concatenate(b)}, layout)

    return dealt.mapInArrow(walk, _EDGES)


def _rooted(docs: DataFrame, space: Workspace, words_each: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fingerprint, seal) of every row, and the root of every fingerprint: one name for each component."""
    found = space.table("fingerprints", fingerprints(docs, words_each))
    nodes = space.table("nodes", found.select("fingerprint").distinct())
    roots = components(space.table("links", spanning_links(nodes, max_bits)), space)
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left")
    return found, rooted.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def simhash_components(docs: DataFrame, space: Workspace, *, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (signed long) and component_id of every row: the smallest doc_id reachable through links.

    Documents without words have fingerprint zero and link like any other. Rows with equal fingerprints, repeated rows
    among them, are one node, so copies add no pairs. NULL doc_ids take part but never name a component, unless
    it has no other id; then component_id is NULL. An empty table gives no rows; other columns are ignored.
    """
    found, rooted = _rooted(docs, space, words_each, max_bits)
    least = found.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(rooted, "fingerprint")
    named = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, space: Workspace, *, words_each: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of each component the row with the smallest doc_id, NULL
    being larger than any. Of several rows with that id, the one with the smallest seal stays, and of equal rows one."""
    found, rooted = _rooted(docs, space, words_each, max_bits)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "seal")
    first = found.groupBy("fingerprint").agg(F.min(place).alias("first")).join(rooted, "fingerprint")
    staying = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_id"), F.col("first.seal").alias("_seal"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("_id"), F.xxhash64(text).alias("_seal"), F.struct(*[docs[name] for name in docs.columns]).alias("row"))
    same = rows["_id"].eqNullSafe(staying["_id"]) & (rows["_seal"] == staying["_seal"])
    kept = rows.join(staying, same, "left_semi").groupBy("_id", "_seal").agg(F.first("row").alias("row"))
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def hex_fingerprint(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
