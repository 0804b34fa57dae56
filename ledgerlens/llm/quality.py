"""Quality: random Fourier features over document statistics, ridge scores, isotonic calibration.

1. One pass over the texts leaves a row of numbers per document (see `NAMES`).
2. Means and deviations of the labelled training rows standardise them; `FEATURES` random cosines approximate the
   Gaussian kernel on the standardised numbers.
3. Each partition sums the normal equations of its rows, by cross-fitting fold; the sums are added by blocks of matrix
   rows. The ridge penalty is the one with the least squared error on the folds left out, which follows from the sums.
4. Scores of rows by the fit without their fold are counted by fine bins; pooling adjacent violators over the bins
   turns scores into shares of label 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, fold, record_batch, runs

FEATURES = 256
PENALTIES = (1e-5, 1e-4, 1e-3, 1e-2, 1e-1)
FITS = 5
BINS = 4096
LOW, HIGH = -0.5, 1.5
BLOCK = 32
SEED = 42
FOLDS, HELD_OUT = 3, 1

NAMES = (
    "log bytes", "log words", "log lines", "mean word", "longest word", "upper", "digits", "symbols", "non-ascii", "blanks",
    "exclamations", "stops", "brackets", "symbols a word", "distinct words", "distinct pairs", "top word", "distinct lines",
    "entropy", "top byte",
)

_STATS = "doc_id long, stats binary"
_SUMS = "fit int, block int, sums binary"
_SCORES = "doc_id long, score double"


def _classes() -> np.ndarray:
    """Rows of 256 flags: letters, upper case, digits, symbols, non-ASCII, blanks, exclamations, stops, brackets."""
    flags = np.zeros((9, 256))
    for byte in range(256):
        char = chr(byte)
        if byte >= 128:
            flags[4, byte] = 1
        elif char.isalpha():
            flags[0, byte] = 1
            flags[1, byte] = char.isupper()
        elif char.isdigit():
            flags[2, byte] = 1
        elif char in " \t\n\r\x0b\x0c":
            flags[5, byte] = 1
        else:
            flags[3, byte] = 1
    for row, chars in ((6, "!"), (7, ".?,;"), (8, "<>{}[]|\\")):
        flags[row, [ord(c) for c in chars]] = 1
    return flags


_CLASSES = _classes()


def statistics(text: bytes) -> np.ndarray:
    """The numbers of one text, finite for every text; shares of nothing are 0."""
    size = len(text)
    if not size:
        return np.zeros(len(NAMES))
    bytes_seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters, upper, digits, symbols, other, blanks, exclamations, stops, brackets = _CLASSES @ bytes_seen
    words = text.lower().split()
    counts = Counter(words)
    n = max(1, len(words))
    lines = text.split(b"\n")
    share = bytes_seen[bytes_seen > 0] / size
    return np.array(
        [
            np.log1p(size),
            np.log1p(len(words)),
            np.log1p(len(lines)),
            (size - blanks) / n,
            np.log1p(max(map(len, counts), default=0)),
            upper / max(1, letters),
            digits / size,
            symbols / size,
            other / size,
            blanks / size,
            exclamations / n,
            stops / n,
            brackets / n,
            symbols / n,
            len(counts) / n,
            len(set(zip(words, words[1:], strict=False))) / max(1, n - 1),
            max(counts.values(), default=0) / n,
            len(set(lines)) / len(lines),
            -(share * np.log(share)).sum(),
            bytes_seen.max() / size,
        ]
    )


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the packed statistics of every row; NULL text is empty."""
    layout = arrow_schema(_STATS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield record_batch({"doc_id": batch.column(0), "stats": [statistics(t).tobytes() for t in byte_texts(batch.column(1))]}, layout)

    return documents(docs).mapInArrow(measure, _STATS)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, len(NAMES))


@dataclass
class Kernel:
    """Standardisation and random cosines."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    phases: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Cosines and a constant; standardised numbers are limited to 5 deviations."""
        scaled = np.clip((stats - self.mean) / self.deviation, -5, 5)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(scaled @ self.weights + self.phases)
        return np.hstack([cosines, np.ones((len(stats), 1))])


def _summed(parts: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Adds (fit, block, sums) over all partitions by key; the driver gets one row per key."""
    layout = arrow_schema(_SUMS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["fit", "block"]):
            total = np.sum([np.frombuffer(own, dtype=np.float64) for own in group["sums"]], axis=0)
            yield record_batch({"fit": group["fit"][:1], "block": group["block"][:1], "sums": [total.tobytes()]}, layout)

    dealt = parts.repartition("fit", "block").sortWithinPartitions("fit", "block")
    return {(row["fit"], row["block"]): np.frombuffer(row["sums"], dtype=np.float64) for row in dealt.mapInArrow(add, _SUMS).collect()}


def fit_kernel(training: DataFrame, features: int = FEATURES, seed: int = SEED) -> Kernel:
    """Means and deviations over all training rows; the kernel's width is the root of the number of statistics."""
    layout = arrow_schema(_SUMS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * len(NAMES))
        for batch in batches:
            rows = _matrix(batch.column(0))
            total += np.concatenate([[len(rows)], rows.sum(axis=0), np.square(rows).sum(axis=0)])
        yield record_batch({"fit": [0], "block": [0], "sums": [total.tobytes()]}, layout)

    found = _summed(training.select("stats").mapInArrow(moments, _SUMS))
    total = found.get((0, 0), np.zeros(1 + 2 * len(NAMES)))
    count = max(1.0, total[0])
    mean = total[1 : 1 + len(NAMES)] / count
    deviation = np.sqrt(np.maximum(total[1 + len(NAMES) :] / count - mean * mean, 0))
    random = np.random.default_rng(seed)
    weights = random.standard_normal((len(NAMES), features)) / np.sqrt(len(NAMES))
    return Kernel(mean, np.where(deviation > 1e-9, deviation, 1.0), weights, random.uniform(0, 2 * np.pi, features))


def normal_equations(training: DataFrame, kernel: Kernel) -> np.ndarray:
    """For each fit, the symmetric matrix of sums of products of (features, 1, label) over its rows."""
    side = len(kernel.phases) + 2
    layout = arrow_schema(_SUMS)
    shared = training.sparkSession.sparkContext.broadcast((kernel.mean, kernel.deviation, kernel.weights, kernel.phases))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel, sums = Kernel(*shared.value), {}
        for batch in batches:
            label, fit = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            rows = np.hstack([kernel.features(_matrix(batch.column(0))), label[:, None]])
            for own in np.unique(fit).tolist():
                mine = rows[fit == own]
                sums[own] = sums.get(own, 0) + mine.T @ mine
        for own, total in sums.items():
            starts = range(0, side, BLOCK)
            parts = [total[start : start + BLOCK].tobytes() for start in starts]
            yield record_batch({"fit": [own] * len(parts), "block": range(len(parts)), "sums": parts}, layout)

    found = _summed(training.select("stats", "label", "fit").mapInArrow(add, _SUMS))
    whole = np.zeros((FITS, side, side))
    for (own, block), sums in found.items():
        whole[own, block * BLOCK : (block + 1) * BLOCK] = sums.reshape(-1, side)
    return whole


def ridge_fits(sums: np.ndarray, penalties=PENALTIES) -> tuple[np.ndarray, np.ndarray]:
    """(weights from all rows, weights without each fit's rows) under the penalty of least error on rows left out.
    A penalty is a share of the number of rows; the constant is not penalised."""
    total = sums.sum(axis=0)

    def solve(part: np.ndarray, penalty: float) -> np.ndarray:
        rows = max(1.0, part[-2, -2])
        ridge = np.full(len(part) - 1, penalty * rows)
        ridge[-1] = 1e-9 * rows
        return np.linalg.solve(part[:-1, :-1] + np.diag(ridge), part[:-1, -1])

    def error(part: np.ndarray, w: np.ndarray) -> float:
        return float(part[-1, -1] - 2 * w @ part[:-1, -1] + w @ part[:-1, :-1] @ w)

    def without(penalty: float) -> np.ndarray:
        return np.array([solve(total - own, penalty) for own in sums])

    best = min(penalties, key=lambda penalty: sum(map(error, sums, without(penalty))))
    return solve(total, best), without(best)


def pool_adjacent(position: np.ndarray, count: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of the share of ones, by pooling adjacent violators: (mean position, share) by block."""
    blocks: list[list[float]] = []
    for x, n, k in zip(position, count, ones, strict=True):
        blocks.append([x * n, n, k])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


@dataclass
class QualityModel:
    """Ridge weights on kernel features; `position` and `share` are the corners of the calibration."""

    kernel: Kernel
    weights: np.ndarray
    position: np.ndarray
    share: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = np.clip(self.kernel.features(stats) @ self.weights, LOW, HIGH)
        return np.interp(raw, self.position, self.share)


def train(stats: DataFrame, labels: DataFrame, space: Workspace, *, features: int = FEATURES, held_out: int | None = HELD_OUT) -> QualityModel:
    """The model from all labelled rows outside the fold `held_out` (None: from all).

    A document with several labels takes the largest; labels that are NULL, other than 0 and 1, or without a document
    are ignored. Without labelled rows every text scores 0.5; with one label only, that label.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = stats.join(known, "doc_id")
    if held_out is not None:
        rows = rows.where(fold(F.col("doc_id"), FOLDS) != held_out)
    # Folds by content: copies of a text never lie on both sides.
    training = space.table("training", rows.select("stats", "label", F.pmod(F.xxhash64("stats"), F.lit(FITS)).cast("int").alias("fit")))
    kernel = fit_kernel(training, features)
    sums = normal_equations(training, kernel)
    if not sums.any():
        return QualityModel(kernel, np.zeros(features + 1), np.zeros(1), np.full(1, 0.5))
    weights, without = ridge_fits(sums)
    layout = arrow_schema("bin int, label int")
    shared = training.sparkSession.sparkContext.broadcast((kernel.mean, kernel.deviation, kernel.weights, kernel.phases, without))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, without = shared.value
        kernel = Kernel(*parts)
        for batch in batches:
            raw = (kernel.features(_matrix(batch.column(0))) * without[batch.column(2).to_numpy()]).sum(axis=1)
            bins = (np.clip((raw - LOW) / (HIGH - LOW), 0, 1) * (BINS - 1)).round().astype(np.int32)
            yield record_batch({"bin": bins, "label": batch.column(1)}, layout)

    placed = training.select("stats", "label", "fit").mapInArrow(place, "bin int, label int")
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).orderBy("bin").collect()
    bins, n, ones = (np.array([row[name] for row in counted], dtype=float) for name in ("bin", "n", "ones"))
    return QualityModel(kernel, weights, *pool_adjacent(LOW + bins / (BINS - 1) * (HIGH - LOW), n, ones))


def quality_scores(stats: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row of a table of statistics.

    Empty and NULL texts have statistics of zero and are scored by them. NULL doc_ids and repeated rows are scored
    like others. An empty table gives no rows. No shuffle.
    """
    layout = arrow_schema(_SCORES)
    k = model.kernel
    shared = stats.sparkSession.sparkContext.broadcast((k.mean, k.deviation, k.weights, k.phases, model.weights, model.position, model.share))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, weights, position, share = shared.value
        model = QualityModel(Kernel(*parts), weights, position, share)
        for batch in batches:
            yield record_batch({"doc_id": batch.column(0), "score": model.score(_matrix(batch.column(1)))}, layout)

    return stats.select("doc_id", "stats").mapInArrow(score, _SCORES)
