"""Embedding near-dedup by iterative quantisation.

Vectors get binary codes: a sample gives the mean and the principal axes, and a rotation is learned that brings the
rotated vectors close to their signs, which balances the bits. A code is cut into segments. As in multi-index hashing, each
vector is filed under each of its segment values and asks for the values of a Hamming ball of radius one; what meets and
is close over the whole code is verified by the cosine of the original vectors.

The number of segments follows from the wanted recall, as measured: vectors of the sample that the rotations were not
learned from get partners at the threshold cosine, some in any direction, some in directions in which the sample varies, and segments are
added until so many of both are found. So a common mean, which centring removes, and bits that depend on each other count
as they are. The width b of a segment follows the number of vectors (its logarithm), which keeps buckets small at every
size, unless that takes too many segments. Each length of vectors has a quantiser of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, record_batch, runs, with_partners, with_tiles
from ledgerlens.llm.components import components

THRESHOLD = 0.95
RECALL = 0.985
SAMPLE_ROWS = 8192
ROTATE_STEPS = 30
#: Pairs of each kind that the recall is measured on.
TEST_PAIRS = 4096
#: Beyond so many segments they become narrower instead, down to a bit, which finds everything.
MOST_SEGMENTS = 64
TILE_ROWS = 2048
SEED = 42

_CODES = "cls long, dims int, codes binary"
_KEYS = "key long, filed boolean, cls long"
_MET = "key long, lo int, hi int, tile int, filed boolean, cls long, codes binary"
_FOUND = "cls long, links long, root long"


@dataclass
class Quantiser:
    """Mean, one projection matrix for all bits, and how the bits form segments."""

    mean: np.ndarray
    projection: np.ndarray
    segments: int
    bits: int
    most_apart: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Segment values, one uint32 per segment, of unit vectors of the quantiser's length."""
        signs = (vectors - self.mean) @ self.projection > 0
        return (signs.reshape(len(vectors), self.segments, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))).astype(np.uint32)


def segment_plan(rows: int, flip: float, recall: float) -> tuple[int, int]:
    """(segments, bits each) where each bit of a pair at the threshold differs with probability `flip`."""
    bits = min(32, max(10, math.ceil(math.log2(max(2, rows)))))
    while True:
        found = (1 - flip) ** bits + bits * flip * (1 - flip) ** (bits - 1)
        segments = max(2, _needed(found, recall))
        if segments <= MOST_SEGMENTS or bits == 1:
            return segments, bits
        bits -= 1


def _needed(found: float, recall: float) -> int:
    """Independent segments for that recall if each finds so many."""
    found = min(max(found, 1e-9), 1 - 1e-9)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def threshold_pairs(vectors: np.ndarray, threshold: float, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Two sets of (unit vectors, partners at the threshold cosine): partners in any direction, and in the direction of
    the difference between two others of the vectors."""
    random = np.random.default_rng(seed)
    rows = random.permutation(np.resize(np.arange(len(vectors)), TEST_PAIRS))
    own = vectors[rows]
    pairs = []
    for off in (random.standard_normal(own.shape), vectors[random.permutation(rows)] - vectors[random.permutation(rows)]):
        off = off - (off * own).sum(axis=1, keepdims=True) * own
        size = np.sqrt(np.square(off).sum(axis=1))
        usable = size > 1e-6
        if usable.any():
            off = off[usable] / size[usable, None]
            pairs.append((own[usable], threshold * own[usable] + math.sqrt(1 - threshold**2) * off))
    return pairs


def bits_apart(quantiser: Quantiser, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Differing bits of each pair in each segment."""
    return np.bitwise_count(quantiser.codes(pairs[0]) ^ quantiser.codes(pairs[1])).astype(np.int64)


def fit(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, recall: float = RECALL, seed: int = SEED) -> Quantiser:
    """The quantiser for `rows` unit vectors of one length, of which `sample` is a sample.

    `most_apart` is never below what any of the measured pairs differ in, nor four deviations above their mean.
    """
    held = np.arange(len(sample)) % 4 == 3
    learned, tested = (sample[~held], sample[held]) if len(sample) >= 256 else (sample, sample)
    tests = threshold_pairs(tested, threshold, seed)
    width = sample.shape[1]
    one = Quantiser(*learn_rotations(learned, width, seed), width, 1, 0)
    flip = max((bits_apart(one, pairs).mean() for pairs in tests), default=0.0)
    segments, bits = segment_plan(rows, flip, recall)
    while True:
        quantiser = Quantiser(*learn_rotations(learned, segments * bits, seed), segments, bits, segments * bits)
        apart = [bits_apart(quantiser, pairs) for pairs in tests]
        found = [(own.min(axis=1) <= 1).mean() for own in apart]
        if bits == 1 or min(found, default=1.0) >= recall:
            break
        more = _needed(1 - (1 - min(found)) ** (1 / segments), recall)
        segments = max(segments + 1, min(more, 2 * segments))
        if segments > MOST_SEGMENTS:
            bits -= 1
            segments = max(2, segments // 2)
    totals = [own.sum(axis=1) for own in apart]
    quantiser.most_apart = max((math.ceil(max(own.max(), own.mean() + 4 * own.std())) for own in totals), default=segments * bits)
    return quantiser


def learn_rotations(sample: np.ndarray, total_bits: int, seed: int = SEED, steps: int = ROTATE_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection to `total_bits`): one learned rotation for each stretch of as many bits as there are axes."""
    width = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False) if len(sample) >= width else np.linalg.svd(np.vstack([centred, np.eye(width)]), full_matrices=False)
    random = np.random.default_rng(seed)
    parts = []
    for begin in range(0, total_bits, width):
        # Each further rotation sees its own half of the sample, so that it settles elsewhere.
        own = centred if not begin else centred[random.permutation(len(centred))[: max(1, len(centred) // 2)]]
        shown = own @ axes.T
        rotation, _ = np.linalg.qr(random.standard_normal((width, width)))
        for _ in range(steps):
            signs = np.where(shown @ rotation > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(shown.T @ signs)
            rotation = left @ right
        parts.append((axes.T @ rotation)[:, : total_bits - begin])
    return mean, np.hstack(parts)


def vector_classes(vectors: DataFrame) -> DataFrame:
    """(embedding, size, least, dims): distinct usable vectors. Unusable ones, which link with nothing, are left out."""
    embedding = F.col("embedding")
    usable = embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.where(usable & F.exists(embedding, lambda x: x != 0))
        .groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"))
        .withColumn("dims", F.size("embedding"))
    )


def _unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one; scaled first, so that huge components do not overflow."""
    rows = np.array(column.to_pylist(), dtype=np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.square(rows).sum(axis=1, keepdims=True))


def learn(classes: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> dict[int, Quantiser]:
    """A quantiser for each length of which there are two vectors, each from at most `sample_rows` vectors of that length,
    the first in an order by hash."""
    quantisers = {}
    for size in classes.groupBy("dims").count().where("count > 1").orderBy("dims").collect():
        drawn = classes.where(F.col("dims") == size["dims"]).orderBy(F.xxhash64("embedding", F.lit(seed)), "embedding").limit(sample_rows)
        sample = _unit(pa.array([row["embedding"] for row in drawn.select("embedding").collect()]))
        quantisers[size["dims"]] = fit(sample, size["count"], threshold, recall, seed)
    return quantisers


def coded(classes: DataFrame, quantisers: dict[int, Quantiser]) -> DataFrame:
    """cls, dims and the code of every vector whose length another one has."""
    layout = arrow_schema(_CODES)
    plain = {dims: (q.mean, q.projection, q.segments, q.bits, q.most_apart) for dims, q in quantisers.items()}
    shared = classes.sparkSession.sparkContext.broadcast(plain)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quantisers = {dims: Quantiser(*parts) for dims, parts in shared.value.items()}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for length in np.unique(dims).tolist():
                if length in quantisers:
                    mine = np.flatnonzero(dims == length)
                    codes = quantisers[length].codes(_unit(batch.column(2).take(pa.array(mine))))
                    own = {"cls": batch.column(0).to_numpy()[mine], "dims": [length] * len(mine), "codes": [row.tobytes() for row in codes]}
                    yield record_batch(own, layout)

    return classes.select("cls", "dims", "embedding").mapInArrow(code, _CODES)


def bucket_keys(codes: DataFrame, quantisers: dict[int, Quantiser]) -> DataFrame:
    """Every place where a vector is filed or asks: its segment values, and those with one set bit cleared. Of two
    values at distance one, one asks for the other, so each pair meets once in a segment. Lengths have keys of their own."""
    layout, bits = arrow_schema(_KEYS), {dims: q.bits for dims, q in quantisers.items()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for length in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == length)
                packed = b"".join(batch.column(2).take(pa.array(mine)).to_pylist())
                own = np.frombuffer(packed, dtype=np.uint32).reshape(len(mine), -1)
                masks = np.concatenate([[0], 1 << np.arange(bits[length])]).astype(np.int64)
                values = own.astype(np.int64)[:, :, None]
                row, segment, mask = np.nonzero((values & masks) == masks)
                keys = (length << 40) + (segment.astype(np.int64) << 32) + own[row, segment] - masks[mask]
                for low in range(0, len(row), 50_000):
                    part = slice(low, low + 50_000)
                    yield record_batch({"key": keys[part], "filed": mask[part] == 0, "cls": cls[mine[row[part]]]}, layout)

    return codes.mapInArrow(ask, _KEYS)


def _met_here(codes: np.ndarray, filed: np.ndarray, segment: int, tile: np.ndarray | None, left: slice, most_apart: int | None) -> np.ndarray:
    """Pairs (rows of `left`, all rows) that this bucket owns: the first is filed here, the second is filed after it or
    asks here; this is their first segment with at most one difference; all in all few bits differ."""
    apart = np.zeros((left.stop - left.start, len(codes)), dtype=np.int32)
    own = np.ones(apart.shape, dtype=bool)
    for s in range(codes.shape[1]):
        bits = np.bitwise_count(codes[left, s, None] ^ codes[None, :, s])
        apart += bits
        if s < segment:
            own &= bits > 1
    own &= filed[left, None]
    after = np.arange(len(codes))[None, :] > np.arange(left.start, left.stop)[:, None]
    own &= after | ~filed[None, :]
    if tile is not None:
        own &= tile[left, None] != tile[None, :]
    return own & (apart <= most_apart) if most_apart is not None else own


_STRIPE = 512


def candidates(keys: DataFrame, codes: DataFrame, quantisers: dict[int, Quantiser], tile_rows: int = TILE_ROWS) -> DataFrame:
    """Members of buckets that have a partner there, close enough over the whole code. Buckets with more than
    `tile_rows` members are cut into tiles. Codes are joined to the members only."""
    tiled = with_tiles(with_partners(keys, "key"), "key", "cls", F.col("rows"), tile_rows).select("key", "lo", "hi", "tile", "filed", "cls")
    dealt = tiled.join(codes.select("cls", "codes"), "cls").select("key", "lo", "hi", "tile", "filed", "cls", "codes")
    dealt = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", F.desc("filed"), "cls")
    layout, most = arrow_schema(_MET), {dims: q.most_apart for dims, q in quantisers.items()}

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {name: [] for name in layout.names}
        for group in runs(batches, ["key", "lo", "hi"]):
            codes = np.frombuffer(b"".join(group["codes"]), dtype=np.uint32).reshape(len(group["codes"]), -1)
            segment = int(group["key"][0]) >> 32 & 0xFF
            tile = group["tile"] if group["lo"][0] != group["hi"][0] else None
            taking = np.zeros(len(codes), dtype=bool)
            for low in range(0, int(group["filed"].sum()) if tile is None else len(codes), _STRIPE):
                left = slice(low, min(low + _STRIPE, len(codes)))
                pairs = _met_here(codes, group["filed"], segment, tile, left, most[int(group["key"][0]) >> 40])
                taking |= pairs.any(axis=0)
                taking[left] |= pairs.any(axis=1)
            for name in layout.names:
                held[name] += group[name][taking].tolist()
            if len(held["key"]) >= 20_000:
                yield record_batch(held, layout)
                held = {name: [] for name in layout.names}
        if held["key"]:
            yield record_batch(held, layout)

    return dealt.mapInArrow(close, _MET)


def verified(members: DataFrame, classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(cls, links, root) for members of buckets: the rows they link with there, and a member they reach. Cosines are
    computed in double precision from the original vectors, in stripes of a bucket; no pair leaves its task."""
    sized = members.join(classes.select("cls", "embedding", "size"), "cls")
    names = ["key", "lo", "hi", "tile", "filed", "cls", "codes", "embedding", "size"]
    dealt = sized.select(*names).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", F.desc("filed"), "cls")
    layout = arrow_schema(_FOUND)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {name: [] for name in layout.names}
        for group in runs(batches, ["key", "lo", "hi"]):
            codes = np.frombuffer(b"".join(group["codes"]), dtype=np.uint32).reshape(len(group["codes"]), -1)
            vectors = _unit(pa.array(group["embedding"].tolist()))
            tile = group["tile"] if group["lo"][0] != group["hi"][0] else None
            sizes, links = group["size"], np.zeros(len(codes), dtype=np.int64)
            label = np.arange(len(codes))
            for low in range(0, len(codes), _STRIPE):
                left = slice(low, min(low + _STRIPE, len(codes)))
                pairs = _met_here(codes, group["filed"], int(group["key"][0]) >> 32 & 0xFF, tile, left, None)
                pairs &= vectors[left] @ vectors.T >= threshold
                links[left] += pairs @ sizes
                links += sizes[left] @ pairs
                first, second = np.nonzero(pairs)
                _join(label, first + low, second)
            linked = links > 0
            held["cls"] += group["cls"][linked].tolist()
            held["links"] += links[linked].tolist()
            held["root"] += group["cls"][label[linked]].tolist()
            if len(held["cls"]) >= 20_000:
                yield record_batch(held, layout)
                held = {name: [] for name in layout.names}
        if held["cls"]:
            yield record_batch(held, layout)

    return dealt.mapInArrow(rerank, _FOUND)


def _join(label: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
    """Lowers labels in place until both ends of every pair share one."""
    while len(first):
        low = np.minimum(label[first], label[second])
        if (label[first] == low).all() and (label[second] == low).all():
            return
        for end in (label[first], label[second], first, second):
            np.minimum.at(label, end, low)
        label[:] = label[label]


def embedding_links(vectors: DataFrame, space: Workspace, *, threshold: float = THRESHOLD, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of (vec_id, embedding).

    Two rows link at a cosine of at least `threshold`. Vectors that are NULL, empty, zero, or hold a NULL or non-finite
    component link with nothing, and vectors of different lengths never link. Rows with equal vectors are one node
    that counts for all of them, so copies add no pairs. A NULL vec_id takes part but never names a component
    with other ids. component_id is the smallest vec_id reachable, kept whether it is the row's own (of repeated rows
    with one vec_id all count as kept). An empty table gives no rows; other columns are ignored. Every vector is indexed;
    only the rotations and the number of segments are learned from samples, one of each length.
    """
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding"))
    classes = space.table("classes", vector_classes(rows).withColumn("cls", F.monotonically_increasing_id()))
    quantisers = learn(classes, threshold=threshold, recall=recall, sample_rows=sample_rows, seed=seed)
    codes = space.table("codes", coded(classes, quantisers))
    members = candidates(bucket_keys(codes, quantisers), codes, quantisers)
    found = space.table("found", verified(members, classes, threshold))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), space)
    counted = found.groupBy("cls").agg(F.sum("links").alias("links"))
    rooted = classes.select("cls", "embedding", "size", "least").join(counted, "cls", "left").join(roots, F.col("cls") == F.col("node"), "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.col("component_id")
    )
    placed = rows.join(named, "embedding", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return placed.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
