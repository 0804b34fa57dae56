"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct n-grams of the words of a text (each word lower-cased and bounded by blanks), hashed to
`SLOTS` slots. All labelled training rows give the counts p and q of rows with a slot, by label; r = log of the ratio of
the smoothed shares. A text is the vector of r over its slots, and a logistic regression on such vectors gives the
score. Only slots with the clearest evidence take part in the regression, |r| alone being large for rare slots too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, fold, record_batch
from ledgerlens.operators.sizing import broadcast_within

GRAMS = (3, 4, 5, 6)
SLOTS = 1 << 18
FEATURES = 1 << 12
#: The regression is fitted on at most so many labelled rows: those first in an order by hashed text and id.
FIT_ROWS = 6_000
FOLDS, HELD_OUT = 5, 0

_COUNTS = "slot int, hits long, rows long"
_FEATURES = "order long, toxic int, bits binary"
_SCORES = "doc_id long, score double"


def spaced_bytes(text: bytes) -> np.ndarray:
    """The text lower-cased in A-Z, with one blank between words and at both ends."""
    return np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", dtype=np.uint8)


def gram_slots(text: bytes, grams=GRAMS, slots: int = SLOTS) -> np.ndarray:
    """Slots of all n-grams that cross no blank inside (one may start or end with one), repeats included."""
    chars = spaced_bytes(text)
    if len(chars) < min(grams):
        return np.empty(0, dtype=np.int64)
    blank = chars == 32
    # Blanks strictly inside an n-gram from i to i+n-1 are those among positions i+1 .. i+n-2.
    seen = np.concatenate([[0], np.cumsum(blank, dtype=np.int32)])
    rolled = chars.astype(np.uint32)
    parts = []
    for n in range(2, max(grams) + 1):
        if len(chars) < n:
            break
        rolled = rolled[:-1] * np.uint32(0x01000193) ^ chars[n - 1 :]  # FNV-1 over the n bytes
        if n in grams:
            inside = seen[n - 1 :][: len(rolled)] - seen[1 : 1 + len(rolled)]
            mixed = rolled[inside == 0] * np.uint32(0x9E3779B1 + 2 * n)
            parts.append(mixed >> np.uint32(32 - slots.bit_length() + 1))
    return np.concatenate(parts).astype(np.int64)


class SlotSet:
    """Distinct slots of one text at a time, by marks in a table that is wiped after each."""

    def __init__(self, slots: int = SLOTS):
        self.marks = np.zeros(slots, dtype=bool)

    def distinct(self, found: np.ndarray) -> np.ndarray:
        if len(found) < 4000:
            return np.unique(found)
        self.marks[found] = True
        own = np.flatnonzero(self.marks)
        self.marks[own] = False
        return own


def labelled(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """Documents with a label 0 or 1 in column `label`. A document with several labels takes the largest; labels that are NULL, or have no document, are ignored. Labels go to
    the documents while their measured size allows it, so that texts need no shuffle."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[name].cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    small = broadcast_within(known, 32 << 20)
    return documents(docs).join(known if small is None else small, "doc_id")


def slot_counts(training: DataFrame) -> DataFrame:
    """slot, hits (toxic rows with it), rows (all rows with it), over every training row. Slot -1 counts the rows."""
    layout = arrow_schema(_COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, hits, rows = SlotSet(), np.zeros(SLOTS, dtype=np.int64), np.zeros(SLOTS, dtype=np.int64)
        total = np.zeros(2, dtype=np.int64)
        for batch in batches:
            for text, label in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                own = marks.distinct(gram_slots(text))
                rows[own] += 1
                if label:
                    hits[own] += 1
                total += (label, 1)
        found = np.flatnonzero(rows)
        if total[1]:
            yield record_batch(
                {"slot": [-1, *found], "hits": [total[0], *hits[found]], "rows": [total[1], *rows[found]]}, layout
            )

    counted = training.select("text", "label").mapInArrow(count, _COUNTS)
    return counted.groupBy("slot").agg(F.sum("hits").alias("hits"), F.sum("rows").alias("rows"))


@dataclass
class ToxicityModel:
    """Weights by slot (w times r) and the intercept. Without labelled rows of both kinds there is no evidence to tell texts
    apart by."""

    weights: np.ndarray
    intercept: float
    evidence: bool = True

    def score(self, slots: np.ndarray) -> float:
        value = self.intercept + float(self.weights[slots].sum())
        return float(1 / (1 + np.exp(-np.clip(value, -60, 60))))


def log_count_ratios(counts: DataFrame, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """(slots, r) of the slots with the strongest evidence, |r| times the root of the row count.

    p and q are the shares of toxic and other rows among all slot hits of their label, smoothed by one. At most
    `features` slots reach the driver.
    """
    total = counts.where("slot < 0").first()
    if total is None or total["hits"] in (0, total["rows"]):
        return np.empty(0, dtype=np.int64), np.empty(0)
    toxic, clean = total["hits"], total["rows"] - total["hits"]
    p, q = (F.col("hits") + 1) / F.lit(toxic + 2), (F.col("rows") - F.col("hits") + 1) / F.lit(clean + 2)
    rated = counts.where("slot >= 0").select("slot", F.log(p / q).alias("r"), "rows")
    best = rated.orderBy(F.desc(F.abs("r") * F.sqrt("rows")), "slot").limit(features).collect()
    return np.array([row["slot"] for row in best], dtype=np.int64), np.array([row["r"] for row in best])


def fit_regression(rows: np.ndarray, labels: np.ndarray, steps: int = 300, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge penalty by accelerated gradient steps; `rows` has a row of numbers per text.

    The rarer label weighs more, by the root of the ratio, which lies between the counts as they are and equal shares.
    """
    count, ones = len(rows), float(labels.sum())
    weight = np.where(labels > 0, np.sqrt((count - ones) / max(1.0, ones)), 1.0)
    weight /= weight.mean()
    rate = 4.0 / (1.0 + float((np.square(rows).sum(axis=1) * weight).mean()) + penalty)
    w, b, momentum = np.zeros(rows.shape[1], dtype=rows.dtype), 0.0, 1.0
    ahead_w, ahead_b = w, b
    for _ in range(steps):
        z = rows @ ahead_w + ahead_b
        error = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels) * weight / count).astype(rows.dtype)
        new_w = ahead_w - rate * (error @ rows + penalty * ahead_w)
        new_b = ahead_b - rate * float(error.sum())
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        speed = (momentum - 1) / following
        ahead_w, ahead_b = (new_w + speed * (new_w - w)).astype(rows.dtype), new_b + speed * (new_b - b)
        w, b, momentum = new_w, new_b, following
    return w, b


def train(docs: DataFrame, labels: DataFrame, space: Workspace, *, features: int = FEATURES, fit_rows: int = FIT_ROWS, held_out: int | None = HELD_OUT) -> ToxicityModel:
    """The model from the labelled rows outside the fold `held_out` (None: from all).

    Log-count ratios use every such row. The regression is one bounded step on the driver: it gets at most `fit_rows`
    of them, the first in an order by a hash, as one bit for each of `features` slots. Without labelled rows of both
    kinds every text gets the same score: 0.5 without labels, else on the side of the one label.
    """
    training = labelled(docs, labels, "toxic")
    if held_out is not None:
        training = training.where(fold(F.col("doc_id"), FOLDS) != held_out)
    counts = space.table("counts", slot_counts(training))
    slots, r = log_count_ratios(counts, features)
    weights = np.zeros(SLOTS)
    if not len(slots):
        total = counts.where("slot < 0").first()
        return ToxicityModel(weights, 0.0 if total is None else (2.0 if total["hits"] else -2.0), evidence=False)
    shared, layout = docs.sparkSession.sparkContext.broadcast(slots), arrow_schema(_FEATURES)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, marks = shared.value, np.zeros(SLOTS, dtype=bool)
        for batch in batches:
            bits = []
            for text in byte_texts(batch.column(1)):
                own = gram_slots(text)
                marks[own] = True
                bits.append(np.packbits(marks[chosen]).tobytes())
                marks[own] = False
            yield record_batch({"order": batch.column(0), "toxic": batch.column(2), "bits": bits}, layout)

    # A threshold on the order leaves few more rows than are wanted.
    total = counts.where("slot < 0").first()["rows"]
    order, most = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)), 1 << 30
    share = min(1.0, 1.2 * fit_rows / total + 100 / total)
    candidates = training.select(order.alias("order"), "text", "label").where(F.col("order") <= int(share * most))
    sample = candidates.mapInArrow(present, _FEATURES).orderBy("order", "toxic", "bits").limit(fit_rows).collect()
    rows = np.unpackbits(np.frombuffer(b"".join(row["bits"] for row in sample), dtype=np.uint8).reshape(len(sample), -1), axis=1)
    rows = rows[:, : len(slots)] * r.astype(np.float32)
    w, b = fit_regression(rows, np.array([row["toxic"] for row in sample], dtype=np.float32))
    weights[slots] = w * r
    return ToxicityModel(weights, b)


def toxicity_scores(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row, whole texts.

    NULL text is empty; an empty text is scored by the intercept. NULL doc_ids and repeated rows are scored like others.
    An empty table gives no rows; other columns are ignored. One pass, no shuffle; the model has a fixed size.
    """
    layout = arrow_schema(_SCORES)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, model = SlotSet(), ToxicityModel(*shared.value)
        for batch in batches:
            scores = [model.score(marks.distinct(gram_slots(text))) for text in byte_texts(batch.column(1))]
            yield record_batch({"doc_id": batch.column(0), "score": scores}, layout)

    return documents(docs).mapInArrow(score, _SCORES)


def clean_documents(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` with a score below `threshold`, with all their columns; the texts stay where they are.

    Every row stays when the model has no evidence, since rejecting all or none of them would rest on nothing. NULL text is
    empty; rows with NULL doc_ids and repeated rows are judged like others, by their text alone.
    """
    if not model.evidence:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, model = SlotSet(), ToxicityModel(*shared.value)
        for batch in batches:
            passed = [model.score(marks.distinct(gram_slots(text))) < threshold for text in byte_texts(batch.column(at).cast(pa.string()))]
            yield batch.filter(pa.array(passed, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
