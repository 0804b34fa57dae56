"""Target-distribution importance resampling by hashed n-grams.

Separators of a text collapse to single spaces; an overlapped regex scan with lookarounds at the boundaries then gives the
span of every run of n words, whose bytes are hashed by CRC-32 into buckets. The smoothed log ratio of a bucket's share in
the target to its share in the corpus is its gain; a document's weight is the mean gain of its features. Weight plus
seeded Gumbel noise orders the documents, and the first of that order are a sample without replacement in proportion to the
exponentiated weights.

1. Tasks count the buckets of whole texts; Spark sums the counts. Gains are one number per bucket.
2. A second pass over the texts gives weights and scores, which are written without the texts.
3. Eligible documents are ordered by ranges of the score, so no task ranks them all; ranks follow from positions.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, record_batch

MOST_WORDS = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024

_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: Lower-cases A-Z and turns every separator into a space.
_FOLDED = bytes.maketrans(_UPPER + _SEPARATORS, _LOWER + b" " * len(_SEPARATORS))

_COUNTS = "bucket int, n long"
_WEIGHTS = "doc_id long, n_words long, n_features long, weight long, score long"
_PLACED = "part int, place long, doc_id long, n_features long, weight long, score long"


def folded(text: bytes) -> bytes:
    """The words of a text, lower-cased, with one space between them and perhaps around them."""
    return b" ".join(text.translate(_FOLDED).split())


def scanner(most_words: int) -> Callable[[bytes], list[list[tuple[int, int]]]]:
    """A function from folded texts to the spans of their runs of 1, 2, ... words."""
    import regex

    runs = [regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % more) for more in range(most_words)]
    return lambda text: [[match.span() for match in run.finditer(text, overlapped=True)] for run in runs]


def _buckets(text: bytes, scan: Callable, buckets: int) -> tuple[int, list[int]]:
    """(words, bucket of every feature)."""
    plain = folded(text)
    found, crc32 = scan(plain), zlib.crc32
    return len(found[0]), [crc32(plain[low:high]) % buckets for spans in found for low, high in spans]


def bucket_counts(docs: DataFrame, most_words: int = MOST_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts of a table with a column text."""
    layout = arrow_schema(_COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, total = scanner(most_words), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                _, own = _buckets(text, scan, buckets)
                if own:
                    total += np.bincount(own, minlength=buckets)
        held = np.flatnonzero(total)
        yield record_batch({"bucket": held, "n": total[held]}, layout)

    return docs.select(docs["text"].cast("string")).mapInArrow(count, _COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))


def _by_bucket(counts: DataFrame, buckets: int) -> list[int]:
    """One number per bucket reaches the driver."""
    found = [0] * buckets
    for row in counts.collect():
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(corpus: DataFrame, target: DataFrame, most_words: int = MOST_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratios of smoothed shares, target to corpus, in thousandths."""
    own, wanted = (_by_bucket(bucket_counts(table, most_words, buckets), buckets) for table in (corpus, target))
    total, total_wanted = float(sum(own) + buckets), float(sum(wanted) + buckets)
    ratios = [(t + 1) * total / ((s + 1) * total_wanted) for s, t in zip(own, wanted, strict=True)]
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Seeded noise of a document in thousandths; an absent id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def document_scores(docs: DataFrame, gains: np.ndarray, most_words: int = MOST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row. One pass over the texts, no shuffle."""
    layout, buckets = arrow_schema(_WEIGHTS), len(gains)
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, gain = scanner(most_words), shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                n_words, own = _buckets(text, scan, buckets)
                weight = int(gain[own].sum()) // len(own) if own else 0
                rows.append((doc_id, n_words, len(own), weight, weight + gumbel(doc_id, seed)))
            if rows:
                yield record_batch(dict(zip(layout.names, zip(*rows, strict=True), strict=True)), layout)

    return documents(docs).mapInArrow(score, _WEIGHTS)


def _placed(scores: DataFrame, space: Workspace) -> DataFrame:
    """Rows by falling score, then doc_id, with their part and their place in it; parts follow each other.

    `row` tells rows apart that are equal otherwise, so any number of them is cut into ranges like all others.
    """
    spark, layout = scores.sparkSession, arrow_schema(_PLACED)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = ["doc_id", "n_features", "weight", "score"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, reached = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            own = [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(reached, reached + n), pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, *batch.columns], schema=layout)
            reached += n

    ordered = scores.select(*columns, "row").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return space.table("placed", ordered.select(*columns).mapInArrow(place, _PLACED))


def resample(
    docs: DataFrame, target: DataFrame, space: Workspace, *, most_words: int = MOST_WORDS, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; `rank` is NULL unless the row is drawn.

    Of the rows of at least `least_words` words, `percent` in a hundred (rounded down) are drawn, by falling score, ties to the
    smaller doc_id. NULL text has no words: weight 0, never drawn while `least_words` is above 0. A NULL doc_id is
    hashed as empty text and comes last among ties; repeated rows are rows of their own, next to each other. An empty
    corpus gives no rows; an empty target has equal shares in all buckets. Other columns are ignored.
    """
    gains = bucket_gains(docs, target, most_words, buckets)
    scores = space.table("scores", document_scores(docs, gains, most_words, seed).withColumn("row", F.monotonically_increasing_id()))
    eligible = F.col("n_words") >= least_words
    placed = _placed(scores.where(eligible), space)
    # One row per part, no more of them than shuffle partitions.
    sizes = {row["part"]: row["n"] for row in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    ahead, total = [], 0
    for part in sorted(sizes):
        ahead.append((part, total))
        total += sizes[part]
    before = docs.sparkSession.createDataFrame(ahead, "part int, ahead long")
    rank = F.col("ahead") + F.col("place") + 1
    kept = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.join(F.broadcast(before), "part").select(*kept, F.when(rank <= percent * total // 100, rank).alias("rank"))
    return ranked.unionByName(scores.where(~eligible).select(*kept, F.lit(None).cast("long").alias("rank")))
