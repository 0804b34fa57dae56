"""A hidden Markov language model.

Words, lower-cased in A-Z, and an end after each text are emitted by latent states through a bounded alphabet: each of the
most frequent training words is a symbol of its own, every other word belongs to one of `TAIL` symbols by its last three
bytes. P(word | state) = P(symbol | state) * P(word | symbol), where the second factor comes from the counts of all training
words, with 0.5 added to each and to one unseen word per symbol. So the vocabulary may grow with the corpus while what
the driver and the tasks hold does not.

1. Each scan task numbers the distinct words of its blocks (about two million tokens each) and writes the numbered texts.
2. The blocks' dictionaries, one row per word and block rather than per token, are summed to the vocabulary, and a join
   brings each dictionary its counts and symbols.
3. The starting values come from all training texts: a pass sums what surrounds each symbol, and symbols of like surroundings
   are what a state begins with.
4. Baum-Welch: tasks run the scaled forward-backward recursion over all training texts and send expected counts, which
   Spark sums by symbol; the driver turns them into the next model. Training sequences are windows of at most `WINDOW`
   tokens; a window that continues a text starts from the stationary distribution and does not count for the start.
5. The scaled forward recursion over whole texts gives their exact log-likelihood.

The recursions step through time for all texts of a block at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, record_batch, release_shuffles, runs
from ledgerlens.llm.tokens import Numbers, distinct_units, text_slices

STATES = 8
HEAD = 8192
TAIL = 1024
HEAD_WORD_BYTES = 64
#: Larger blocks mean fewer dictionary rows; the recursions take the texts of a block in parts of `PART_TOKENS`.
BLOCK_TOKENS = 1 << 21
PART_TOKENS = 1 << 20
#: Texts whose words are cut and told apart in one call.
SLICE_BYTES = 4 << 20
WINDOW = 1024
ITERATIONS = 4
#: Starting values: components of a symbol's context, and clusterings of the symbols of which the tightest counts.
CONTEXT, START_TRIES, START_STEPS = 32, 20, 25
SEED = 42
FOLDS, HELD_OUT = 5, 1

#: No word is empty, so the empty word can stand for the end.
END = b""

_NUMBERED = "block long, doc_ids array<long>, held binary, lengths binary, ids binary, words array<binary>, counts array<long>"
_LOOKUP = "block long, counts binary, symbols binary"
_CODED = "block long, doc_ids array<long>, held binary, lengths binary, symbols binary, base binary, known binary, inner binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _planes(ids: np.ndarray) -> bytes:
    """Integers of four bytes as four runs of bytes, of which the high ones are nearly all zero and pack well."""
    return ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, dtype=np.uint8).reshape(4, -1).T).view("<i4").reshape(-1)


def _held_out(doc_id: int | None, held_out: int | None) -> bool:
    return held_out is not None and zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == held_out


def numbered_blocks(docs: DataFrame, held_out: int | None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole texts as numbers into a dictionary of their own, with its counts in training texts."""
    layout = arrow_schema(_NUMBERED.replace("array<binary>", "array<long>"))
    layout = layout.set(layout.get_field_index("words"), pa.field("words", pa.list_(pa.binary())))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        numbers, doc_ids, held, total = Numbers(), [], [], 0

        def close() -> pa.RecordBatch:
            ids, lengths = (np.concatenate(parts) for parts in zip(*held, strict=True))
            out = np.array([_held_out(doc_id, held_out) for doc_id in doc_ids])
            columns = {
                "block": [block],
                "doc_ids": [doc_ids],
                "held": [bytes(out.tolist())],
                "lengths": [lengths.tobytes()],
                "ids": [_planes(ids)],
                "words": [numbers.names],
                "counts": [np.bincount(ids[np.repeat(~out, lengths)], minlength=len(numbers))],
            }
            return record_batch(columns, layout)

        for batch in batches:
            own_ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for low, high in text_slices(texts, min(SLICE_BYTES, 4 * block_tokens)):
                words, places, counts = distinct_units([text.lower() for text in texts[low:high]], blanks_dropped=True)
                own = numbers.of([*words, END]).astype(np.int32)
                ids = np.insert(own[places], np.cumsum(counts), own[-1])
                doc_ids += own_ids[low:high]
                held.append((ids, counts + 1))
                total += len(ids)
                if total >= block_tokens:
                    yield close()
                    block, numbers, doc_ids, held, total = block + 1, Numbers(), [], [], 0
        if held:
            yield close()

    return documents(docs).mapInArrow(number, _NUMBERED)


@dataclass
class Vocabulary:
    """Counts of all training words (a table: word, c) and the alphabet of symbols, those of frequent words first."""

    words: DataFrame
    tokens: int
    distinct: int
    head: list[bytes]
    symbol_tokens: np.ndarray
    symbol_words: np.ndarray

    def symbol(self, words: DataFrame) -> DataFrame:
        """Adds `symbol` to a table with a column word. The frequent words are a bounded list of short ones."""
        spark = words.sparkSession
        head = spark.createDataFrame([(bytearray(w), i) for i, w in enumerate(self.head)], "word binary, rank int")
        ending: Column = F.crc32(F.expr("substring(word, greatest(1, octet_length(word) - 2), 3)"))
        joined = words.join(F.broadcast(head), "word", "left")
        return joined.withColumn("symbol", F.coalesce("rank", (F.pmod(ending, F.lit(TAIL)) + len(self.head)).cast("int"))).drop("rank")

    def log_inner(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(word | symbol)."""
        inner = np.log10((counts + 0.5) / (self.symbol_tokens + 0.5 * (self.symbol_words + 1))[symbols])
        return np.where(symbols < len(self.head), 0.0, inner)

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        """log10 P(word) of the memoryless model."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def dictionary_rows(blocks: DataFrame) -> DataFrame:
    zipped = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
    return blocks.select("block", zipped).select("block", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))


def count_words(blocks: DataFrame, space: Workspace, head: int = HEAD) -> Vocabulary:
    rows = dictionary_rows(blocks)
    words = space.table("vocabulary", rows.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")))
    totals = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    frequent = words.where(F.octet_length("word") <= HEAD_WORD_BYTES).orderBy(F.desc("c"), "word").limit(head).collect()
    found = Vocabulary(words, totals[0] or 0, totals[1], [bytes(row["word"]) for row in frequent], np.empty(0), np.empty(0))
    size = len(found.head) + TAIL
    found.symbol_tokens, found.symbol_words = np.zeros(size), np.zeros(size)
    # One row per symbol reaches the driver.
    for row in found.symbol(words).groupBy("symbol").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        found.symbol_tokens[row["symbol"]], found.symbol_words[row["symbol"]] = row["c"], row["n"]
    return found


def coded_blocks(blocks: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Blocks as symbols, with each text's base score, known tokens and log10 of its words given their symbols."""
    known = dictionary_rows(blocks).select("block", "place", "word").join(vocabulary.words, "word", "left")
    looked = vocabulary.symbol(known).select("block", "place", F.coalesce("c", F.lit(0)).alias("c"), "symbol")
    layout, lookup = arrow_schema(_CODED), arrow_schema(_LOOKUP)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["block"]):
            counts, symbols = group["c"].astype(np.int64), group["symbol"].astype(np.uint16)
            yield record_batch({"block": group["block"][:1], "counts": [counts.tobytes()], "symbols": [symbols.tobytes()]}, lookup)

    lookups = looked.repartition("block").sortWithinPartitions("block", "place").mapInArrow(gather, _LOOKUP)
    joined = blocks.drop("words", "counts").join(lookups.withColumnRenamed("symbols", "word_symbols"), "block")
    names = ["block", "doc_ids", "held", "lengths", "ids", "counts", "word_symbols"]
    bare = Vocabulary(None, vocabulary.tokens, vocabulary.distinct, vocabulary.head, vocabulary.symbol_tokens, vocabulary.symbol_words)
    log_inner, log_base = bare.log_inner, bare.log_base

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, doc_ids, held, lengths, ids, counts, symbols = (batch.column(i)[row].as_py() for i in range(len(names)))
                ids, sizes = _from_planes(ids), np.frombuffer(lengths, dtype=np.int64)
                counts, symbols = np.frombuffer(counts, dtype=np.int64), np.frombuffer(symbols, dtype=np.uint16)
                starts = np.cumsum(sizes) - sizes
                columns = {
                    "block": [block],
                    "doc_ids": [doc_ids],
                    "held": [held],
                    "lengths": [lengths],
                    "symbols": [symbols[ids].tobytes()],
                    "base": [np.add.reduceat(log_base(counts)[ids], starts).tobytes()],
                    "known": [np.add.reduceat((counts > 0).astype(np.int64)[ids], starts).tobytes()],
                    "inner": [np.add.reduceat(log_inner(symbols, counts)[ids], starts).tobytes()],
                }
                yield record_batch(columns, layout)

    return joined.select(*names).mapInArrow(code, _CODED)


@dataclass
class Model:
    start: np.ndarray  # by state
    move: np.ndarray  # from state, to state
    emit: np.ndarray  # symbol, state

    def stationary(self) -> np.ndarray:
        power = np.linalg.matrix_power(self.move.astype(np.float64), 64)
        return power.mean(axis=0)


class Steps:
    """Sequences laid out by time: the tokens at step t are those of the sequences longer than t, longest first."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        starts = (np.cumsum(lengths) - lengths)[self.order]
        begins = np.repeat(starts, self.lengths)
        within = np.arange(len(begins)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        longest = int(self.lengths[0]) if len(lengths) else 0
        # Numbers of two bytes are sorted in linear time; windows of training texts are short enough.
        self.index = (begins + within)[np.argsort(within.astype(np.uint16 if longest <= 1 << 16 else np.int32), kind="stable")]
        self.alive = len(lengths) - np.searchsorted(self.lengths[::-1], np.arange(longest), side="right")
        self.offset = np.concatenate([[0], np.cumsum(self.alive)])

    def forward(self, first: np.ndarray, move: np.ndarray, emitted: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray]:
        """(state shares, scale) of each token, or only the scales: P(token | tokens before). `emitted` is laid out by
        time and is overwritten with the shares if they are kept."""
        scale = np.empty(len(emitted), dtype=emitted.dtype)
        shares = None
        for alive, low in zip(self.alive.tolist(), self.offset.tolist(), strict=False):
            here = emitted[low : low + alive]
            shares = (first if shares is None else shares[:alive] @ move) * here
            total = shares.sum(axis=1)
            shares /= total[:, None]
            scale[low : low + alive] = total
            if keep:
                here[:] = shares
        return emitted, scale

    def backward(self, shares: np.ndarray, scale: np.ndarray, move: np.ndarray, emitted: np.ndarray) -> np.ndarray:
        """Turns forward shares into posterior ones in place; returns the expected moves between states."""
        moves = np.zeros(move.shape)
        after = None
        for step in range(len(self.alive) - 1, -1, -1):
            low, alive = int(self.offset[step]), int(self.alive[step])
            back = np.ones((alive, move.shape[0]), dtype=shares.dtype)
            here = shares[low : low + alive]
            if after is not None:
                further = len(after)
                moves += here[:further].T @ after
                back[:further] = after @ move.T
            here *= back
            if step:
                after = emitted[low : low + alive] * back
                after /= scale[low : low + alive, None]
        return moves * move


def windows(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, whether it begins a text) of the windows of consecutive texts."""
    count = -(-lengths // most)
    owner = np.repeat(np.arange(len(lengths)), count)
    first = np.zeros(len(owner), dtype=bool)
    first[np.cumsum(count) - count] = True
    size = np.full(len(owner), most, dtype=np.int64)
    last = np.cumsum(count) - 1
    size[last] = lengths - (count - 1) * most
    return size, first


def expected_counts(model: Model, symbols: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> Model:
    """Expected starts, moves and emissions of the sequences; `begins` marks those that begin a text."""
    steps = Steps(lengths)
    laid = symbols[steps.index].astype(np.intp)
    emitted = model.emit[laid]
    begins = begins[steps.order]
    first = np.where(begins[:, None], model.start, model.stationary().astype(model.start.dtype)).astype(emitted.dtype)
    shares, scale = steps.forward(first, model.move, emitted.copy(), keep=True)
    moves = steps.backward(shares, scale, model.move, emitted)
    seen = np.column_stack([np.bincount(laid, shares[:, k], len(model.emit)) for k in range(shares.shape[1])])
    return Model(shares[: len(lengths)][begins].sum(axis=0, dtype=np.float64), moves, seen)


def maximised(counts: Model, background: np.ndarray) -> Model:
    """The model of expected counts, smoothed: emissions by `background`, worth 50 tokens in each state."""
    start = (counts.start + 1) / (counts.start + 1).sum()
    move = (counts.move + 1) / (counts.move + 1).sum(axis=1, keepdims=True)
    emit = counts.emit + 50 * background[:, None]
    return Model(*(part.astype(np.float32) for part in (start, move, emit / emit.sum(axis=0))))


def symbol_groups(contexts: np.ndarray, weights: np.ndarray, groups: int, random: np.random.Generator) -> np.ndarray:
    """The group of each symbol: k-means of the contexts' directions about their mean, the tightest of several tries."""
    used = np.flatnonzero(weights)
    group = np.full(len(weights), -1)
    if not len(used):
        return group
    share = weights[used] / weights[used].sum()
    points = contexts[used] / weights[used, None]
    points = points - share @ points
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-12)
    best = np.inf
    for _ in range(START_TRIES):
        centres = points[[random.choice(len(used), p=share)]]
        while len(centres) < groups:
            far = share * ((points[:, None] - centres) ** 2).sum(axis=2).min(axis=1)
            if far.sum() <= 1e-9:
                break  # fewer kinds of symbols than groups
            centres = np.vstack([centres, points[random.choice(len(used), p=far / far.sum())]])
        for _ in range(START_STEPS):
            distance = (points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1)
            nearest = distance.argmin(axis=1)
            for k in np.unique(nearest):
                centres[k] = np.average(points[nearest == k], axis=0, weights=share[nearest == k])
        cost = share @ distance.min(axis=1)
        if cost < best:
            best, group[used] = cost, nearest
    return group


def starting_model(contexts: np.ndarray, weights: np.ndarray, background: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """A model whose states prefer symbols that occur together: each state begins with a group of symbols of like contexts.
    `contexts` are summed over the `weights` tokens of each symbol."""
    random = np.random.default_rng(seed)
    group = symbol_groups(contexts, weights, states, random)
    emit = np.tile(background, (states, 1))
    for k in np.unique(group[group >= 0]):
        own = np.where(group == k, background, 0)
        emit[k] = 0.5 * background + 0.5 * own / own.sum()
    emit *= random.uniform(0.9, 1.1, emit.shape)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    return Model(*(part.astype(np.float32) for part in (np.full(states, 1 / states), move, (emit / emit.sum(axis=1, keepdims=True)).T)))


def text_parts(lengths: np.ndarray, most: int = PART_TOKENS) -> Iterator[tuple[slice, slice]]:
    """(texts, their tokens) of consecutive texts with about `most` tokens together; a longer text is a part alone."""
    ends = np.cumsum(lengths)
    low = 0
    while low < len(lengths):
        start = int(ends[low] - lengths[low])
        high = max(low + 1, int(np.searchsorted(ends, start + most, side="right")))
        yield slice(low, high), slice(start, int(ends[high - 1]))
        low = high


def _training(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, lengths) of the training texts of a block."""
    held, lengths, symbols = (batch.column(batch.schema.names.index(name))[row].as_py() for name in ("held", "lengths", "symbols"))
    lengths, own = np.frombuffer(lengths, dtype=np.int64), np.frombuffer(held, dtype=np.uint8) == 0
    symbols = np.frombuffer(symbols, dtype=np.uint16)[np.repeat(own, lengths)]
    return symbols, lengths[own]


def baum_welch_round(coded: DataFrame, model: Model) -> Model:
    """Expected counts over all training texts, summed by Spark: a row per symbol, per state and for the start."""
    states = len(model.start)
    sums = ", ".join(f"s{k} double" for k in range(states))
    layout = arrow_schema(f"item int, {sums}")
    shared = coded.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, total = Model(*shared.value), None
        for batch in batches:
            for row in range(batch.num_rows):
                symbols, lengths = _training(batch, row)
                for texts, tokens in text_parts(lengths):
                    found = expected_counts(model, symbols[tokens], *windows(lengths[texts], WINDOW))
                    parts = np.vstack([found.start, found.move, found.emit])
                    total = parts if total is None else total + parts
        if total is not None:
            item = np.flatnonzero(total.any(axis=1))
            yield record_batch({"item": item, **{f"s{k}": total[item, k] for k in range(states)}}, layout)

    found = coded.select("held", "lengths", "symbols").mapInArrow(expect, f"item int, {sums}")
    rows = found.groupBy("item").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]).collect()
    total = np.zeros((1 + states + len(model.emit), states))
    for row in rows:
        total[row[0]] = row[1:]
    return Model(total[0], total[1 : 1 + states], total[1 + states :])


def symbol_contexts(coded: DataFrame, background: np.ndarray, seed: int = SEED) -> np.ndarray:
    """What surrounds each symbol, summed over all its training tokens: a token's context is the direction of its window,
    which is the sum of a random vector per token, those of rare symbols being longer. Spark sums a row per symbol."""
    size = len(background)
    vectors = np.random.default_rng(seed).standard_normal((CONTEXT, size)) / np.sqrt(background * size)
    sums = ", ".join(f"c{k} double" for k in range(CONTEXT))
    layout = arrow_schema(f"item int, {sums}")
    shared = coded.sparkSession.sparkContext.broadcast(vectors.astype(np.float32))

    def surround(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, total = shared.value, np.zeros((CONTEXT, size))
        for batch in batches:
            for row in range(batch.num_rows):
                symbols, lengths = _training(batch, row)
                for texts, tokens in text_parts(lengths):
                    own, (sizes, _) = symbols[tokens].astype(np.intp), windows(lengths[texts], WINDOW)
                    around = np.array([np.add.reduceat(vector[own], np.cumsum(sizes) - sizes) for vector in vectors])
                    around /= np.maximum(np.linalg.norm(around, axis=0), 1e-12)
                    # The windows of each symbol's tokens, symbol by symbol.
                    by_symbol = np.argsort(symbols[tokens], kind="stable")
                    met = np.repeat(np.arange(len(sizes)), sizes)[by_symbol]
                    here, first = np.unique(own[by_symbol], return_index=True)
                    for k, component in enumerate(around.astype(np.float64)):
                        total[k, here] += np.add.reduceat(component[met], first)
        item = np.flatnonzero(total.any(axis=0))
        yield record_batch({"item": item, **{f"c{k}": total[k, item] for k in range(CONTEXT)}}, layout)

    found = coded.select("held", "lengths", "symbols").mapInArrow(surround, f"item int, {sums}")
    contexts = np.zeros((size, CONTEXT))
    for row in found.groupBy("item").agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(CONTEXT)]).collect():
        contexts[row[0]] = row[1:]
    return contexts


def train(coded: DataFrame, vocabulary: Vocabulary, *, states: int = STATES, iterations: int = ITERATIONS, seed: int = SEED) -> Model:
    """The model after `iterations` rounds over all training texts of the coded blocks, which give its starting values too."""
    background = vocabulary.symbol_tokens + 0.5
    background = background / background.sum()
    model = starting_model(symbol_contexts(coded, background, seed), vocabulary.symbol_tokens, background, states, seed)
    for _ in range(iterations):
        model = maximised(baum_welch_round(coded, model), background)
    return model


def log_likelihood(model: Model, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 of the likelihood of each text: the sum of the logs of its scales."""
    steps = Steps(lengths)
    _, scale = steps.forward(model.start[None, :], model.move, model.emit[symbols[steps.index]], keep=False)
    by_place = np.empty(len(scale))
    by_place[steps.index] = np.log10(scale.astype(np.float64))
    return np.add.reduceat(by_place, np.cumsum(lengths) - lengths)


def coded_scores(coded: DataFrame, model: Model) -> DataFrame:
    """Scores of whole texts: the forward recursion's scales multiply to the likelihood of the symbols."""
    layout = arrow_schema(_SCORES)
    shared = coded.sparkSession.sparkContext.broadcast((model.start, model.move, model.emit))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                lengths, symbols = np.frombuffer(block["lengths"], dtype=np.int64), np.frombuffer(block["symbols"], dtype=np.uint16)
                likelihood = np.concatenate([log_likelihood(model, symbols[tokens], lengths[texts]) for texts, tokens in text_parts(lengths)])
                columns = {
                    "doc_id": block["doc_ids"],
                    "held_out": [bool(out) for out in block["held"]],
                    "n_tokens": lengths,
                    "n_known": np.frombuffer(block["known"], dtype=np.int64),
                    "base_score": np.frombuffer(block["base"]),
                    "score": likelihood + np.frombuffer(block["inner"]),
                }
                yield record_batch(columns, layout)

    return coded.mapInArrow(score, _SCORES)


def hmm_scores(docs: DataFrame, space: Workspace, *, held_out: int | None = HELD_OUT, states: int = STATES, iterations: int = ITERATIONS, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, learned from the rows
    outside the fold `held_out` (None: from all).

    NULL text is empty and has its end as only token. Rows with a NULL doc_id count as fold crc32 of the empty text;
    repeated rows are texts of their own. Without training rows every symbol is equally likely in every state. An
    empty table gives no rows; other columns are ignored. A very long text has a block of its own; whole texts are scored.
    """
    blocks = space.table("blocks", numbered_blocks(docs, held_out))
    vocabulary = count_words(blocks, space)
    release_shuffles(docs.sparkSession)
    coded = space.table("coded", coded_blocks(blocks, vocabulary))
    space.drop("blocks")
    release_shuffles(docs.sparkSession)
    model = train(coded, vocabulary, states=states, iterations=iterations, seed=seed)
    scores = coded_scores(coded, model).withColumn("train_tokens", F.lit(vocabulary.tokens).cast("long"))
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
