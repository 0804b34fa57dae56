"""Alignment of two tokenizers over the same bytes.

Token ends are cumulated in bytes. Dictionaries from end to index are intersected as hash sets; the sorted common ends
slice both id lists into groups, and within a group every pair of tokens whose byte ranges overlap is a link.

1. Each task cuts texts at spaces where both tokenizers begin a token and aligns every different stretch once. It numbers
   the groups of its blocks (some two million tokens each): a document is a list of numbers, and the block's dictionary
   says which id pairs a group links and how often the block has each pair. Documents leave the task in parts of a block,
   so no row grows with the block.
2. The blocks' pairs, one row per pair and block rather than per link, are summed to the corpus-wide counts and compared
   with the highest of their second id; a join brings each dictionary its counts.
3. Each block's counts, dictionary and parts follow one another; sums over groups, then over documents, give the figures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Workspace, arrow_schema, byte_texts, documents, record_batch, runs
from ledgerlens.llm.tokens import UNUSUAL, Numbers, Store, bytes_of, encoder, text_slices

#: Tokens of the first tokenizer after which a block ends: larger blocks mean fewer dictionary rows.
BLOCK_TOKENS = 1 << 21
#: Groups of a part of a block, or those of one document if it has more.
PART_GROUPS = 100_000
#: Stretches of text, and groups, remembered by a task; a full memory starts anew, which changes no result.
REMEMBERED = 250_000
REMEMBERED_GROUPS = 100_000
#: Bytes of rows that go to Python in one batch. JVM and Python hold a batch several times over, beside the JVM's heap.
BATCH_BYTES = 4 << 20
_SLICE_BYTES = 1 << 19
_STRETCHES_A_CALL = 1000

#: Rows of a block, in this order: counts of its pairs, its dictionary, its parts.
_COUNTED, _DICTIONARY, _PART = range(3)
_BLOCKS = (
    "block long, kind int, doc_ids array<long>, n_a binary, n_b binary, n_groups binary, n_links binary, digests array<string>, "
    "groups binary, group_links binary, link_pairs binary, pairs array<long>, counts array<long>"
)
#: Parquet's writer and Spark's reader hold a row group, whose rows here are some hundred KB each, compressed or not.
_FEW_ROWS = {"parquet.block.row.count.limit": "32", "parquet.page.row.count.limit": "4", "parquet.page.size.row.check.min": "4", "parquet.enable.dictionary": "false"}
_LOOKUP = "block long, kind int, pair_counts binary, pair_best binary"
_FIGURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

#: A pair is one number: the first id times this, plus the second.
PAIR = 1 << 32


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary, whose entries spell a byte as one printable character."""
    from tokenizers import Tokenizer

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in set(shown)]
    byte_of = {chr(byte): byte for byte in shown} | {chr(256 + i): byte for i, byte in enumerate(rest)}
    tokenizer = Tokenizer.from_file(path)
    added = tokenizer.get_added_tokens_decoder()
    tokens = [b""] * tokenizer.get_vocab_size()
    for token, id_ in tokenizer.get_vocab().items():
        tokens[id_] = added[id_].content.encode() if id_ in added else bytes(map(byte_of.__getitem__, token))
    return tokens


def piece_tokens(processor) -> list[bytes]:
    """Bytes of each id of a sentencepiece model: U+2581 is a space, <0xHH> one byte."""
    pieces = [processor.id_to_piece(id_) for id_ in range(processor.get_piece_size())]
    return [bytes([int(p[1:-1], 16)]) if processor.is_byte(id_) else p.replace("▁", " ").encode() for id_, p in enumerate(pieces)]


def common_ends(ends_a: list[int], ends_b: list[int], before_a: int = 0, before_b: int = 0) -> tuple[list[int], list[int]]:
    """Places behind the tokens at whose ends both sides of a text end, in order; places count from `before_a` and `before_b`."""
    at_a = dict(zip(ends_a, range(before_a + 1, before_a + len(ends_a) + 1), strict=True))
    at_b = dict(zip(ends_b, range(before_b + 1, before_b + len(ends_b) + 1), strict=True))
    common = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))


def group_ids(group) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Both slices of a group."""
    return group if isinstance(group, tuple) else ((group // PAIR,), (group % PAIR,))


def group_links(a: tuple[int, ...], b: tuple[int, ...], size_a: list[int], size_b: list[int]) -> list[tuple[int, int]]:
    """Id pairs of the tokens of a group whose byte ranges overlap, one for each pair of occurrences."""
    links, i, j = [], 0, 0
    end_a, end_b = size_a[a[0]], size_b[b[0]]
    while True:
        links.append((a[i], b[j]))
        step_a, step_b = end_a <= end_b, end_b <= end_a
        if step_a:
            i += 1
        if step_b:
            j += 1
        if i == len(a) or j == len(b):
            return links
        if step_a:
            end_a += size_a[a[i]]
        if step_b:
            end_b += size_b[b[j]]


def _packed(values, kind: str = "<i8") -> bytes:
    return np.asarray(values, dtype=kind).tobytes()


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, of which some may be empty."""
    ends, reached = np.cumsum(sizes), np.concatenate([[0], np.cumsum(values)])
    return reached[ends] - reached[ends - sizes]


class Spelling:
    """Bytes of ids."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = list(map(len, tokens))
        self.lengths = np.array(self.sizes, dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.every = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        """The bytes of ids one after the other."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.every[shift + np.arange(len(shift))].tobytes()

    def spells(self, ids: np.ndarray, counts: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Which texts consist of the bytes of their ids."""
        spelled, stops = self.spell(ids), np.cumsum(sums(self.lengths[ids], counts)).tolist()
        return np.array([spelled[low:high] == text for low, high, text in zip([0, *stops], stops, texts, strict=False)], dtype=bool)


class Groups:
    """Groups that a task has met, by numbers: their text in a digest, and the pairs they link."""

    def __init__(self, a: Spelling, b: Spelling):
        self.a, self.b = a, b
        self.numbers = Numbers()
        self.texts: list[bytes] = []
        self.links = Store()
        self.links.ids = np.empty(1 << 14, dtype=np.int64)

    def number(self, ids_a: np.ndarray, to_a: np.ndarray, ids_b: np.ndarray, to_b: np.ndarray) -> list[int]:
        """Numbers of the groups that end at given places of both sides."""
        from_a, from_b = (np.concatenate([[0], to])[:-1] for to in (to_a, to_b))
        groups = (ids_a[from_a] * PAIR + ids_b[from_b]).tolist()
        several = np.flatnonzero((to_a - from_a > 1) | (to_b - from_b > 1))
        of_a, of_b = tuple(ids_a.tolist()), tuple(ids_b.tolist())
        for g, i, k, j, m in zip(*(of.tolist() for of in (several, *(at[several] for at in (from_a, to_a, from_b, to_b)))), strict=True):
            groups[g] = of_a[i:k], of_b[j:m]
        found, first, links = list(map(self.numbers.__getitem__, groups)), len(self.texts), []
        for left, right in map(group_ids, self.numbers.names[first:]):
            links.append([x * PAIR + y for x, y in group_links(left, right, self.a.sizes, self.b.sizes)])
            self.texts.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}".encode())
        sizes = np.fromiter(map(len, links), dtype=np.int64, count=len(links))
        self.links.reserve(len(self.texts))
        self.links.put(list(range(first, len(self.texts))), np.fromiter(chain.from_iterable(links), dtype=np.int64, count=int(sizes.sum())), sizes)
        return found


class Stretches:
    """Stretches of text that a task has aligned: tokens of both sides and groups, by numbers.

    Both tokenizers begin a token at a single space between others, so a text is cut there, and each different stretch is
    aligned once. That holds for the first side by what `tokens` says, and for the second if no piece goes on after a
    letter with a space. Texts with other blanks, or with spaces at an end, are one stretch.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.processor.id_to_piece(id_) for id_ in range(self.processor.get_piece_size())]
        self.cuts = not any("▁" in piece.lstrip("▁") for piece in pieces)
        self.encode = encoder(path_a, blanks_dropped=False, cache_units=REMEMBERED // 10)
        self.groups = Groups(Spelling(byte_level_tokens(path_a)), Spelling(piece_tokens(self.processor)))
        self.forget(False)

    def forget(self, groups: bool) -> None:
        """Starts anew, the groups included or not."""
        if groups:
            self.groups = Groups(self.groups.a, self.groups.b)
        self.numbers, self.held = Numbers(), Store()
        self.n_a = self.n_b = np.empty(0, dtype=np.int64)
        self.same = np.empty(0, dtype=bool)

    def cut(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(distinct stretches of texts, place of every stretch among them, number of stretches of each text)."""
        column = pa.array(texts, pa.large_binary()).view(pa.large_string())
        whole = pc.match_substring_regex(column, f"{UNUSUAL}|▁|^ | \\z|\\A\\z") if self.cuts else pa.array([True] * len(texts))
        # A text that is not cut has its place in a list of its own.
        cut = pc.if_else(whole, pa.scalar(None, pa.large_list(pa.large_string())), pc.cast(pc.split_pattern(column, " "), pa.large_list(pa.large_string())))
        counts = pc.fill_null(cut.value_lengths(), 0).to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        units, places = bytes_of(coded.dictionary.view(pa.large_binary())), coded.indices.to_numpy().astype(np.int64)
        alone = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(alone):
            return units, places, counts
        places = np.insert(places, np.cumsum(counts)[alone], np.arange(len(units), len(units) + len(alone)))
        counts[alone] = 1
        return units + [texts[i] for i in alone.tolist()], places, counts

    def number(self, units: list[bytes]) -> np.ndarray:
        """Numbers of stretches, aligned if they are new."""
        first = len(self.numbers.names)
        found = np.fromiter(map(self.numbers.__getitem__, units), dtype=np.int64, count=len(units))
        fresh = self.numbers.names[first:]
        if fresh:
            self.held.reserve(len(self.numbers.names))
            for low, high in text_slices(fresh, _SLICE_BYTES):
                self._align(range(first + low, first + high), fresh[low:high])
        return found

    def _align(self, own: range, units: list[bytes]) -> None:
        a, b = self.groups.a, self.groups.b
        spaced = [b" " + unit for unit in units]
        ids_a, n_a = self.encode(spaced)
        found = self.processor.encode([unit.decode("utf-8", "replace") for unit in units], num_threads=1)
        n_b = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids_b = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(n_b.sum()))
        ids_a = ids_a.astype(np.int64)
        same = a.spells(ids_a, n_a, spaced) & b.spells(ids_b, n_b, spaced) & np.array(list(map(len, units)), dtype=bool)
        ids_a, ids_b = ids_a[np.repeat(same, n_a)], ids_b[np.repeat(same, n_b)]
        n_a, n_b = n_a * same, n_b * same
        # What remains spells the same bytes on both sides, counted from the first stretch on.
        ends_a, ends_b = (np.cumsum(side.lengths[ids]).tolist() for side, ids in ((a, ids_a), (b, ids_b)))
        to_a, to_b, stops_a, stops_b, i, j = [], [], np.cumsum(n_a), np.cumsum(n_b), 0, 0
        for last in range(_STRETCHES_A_CALL - 1, len(units) + _STRETCHES_A_CALL - 1, _STRETCHES_A_CALL):
            k, m = (int(stops[min(last, len(units) - 1)]) for stops in (stops_a, stops_b))
            reached_a, reached_b = common_ends(ends_a[i:k], ends_b[j:m], i, j)
            to_a += reached_a
            to_b += reached_b
            i, j = k, m
        to_a, to_b = np.array(to_a, dtype=np.int64), np.array(to_b, dtype=np.int64)
        groups = self.groups.number(ids_a, to_a, ids_b, to_b)
        counts = np.diff(np.searchsorted(to_a, stops_a, side="right"), prepend=0)
        self.held.put(list(own), np.array(groups, dtype=np.uint32), counts)
        self.n_a, self.n_b = np.concatenate([self.n_a, n_a]), np.concatenate([self.n_b, n_b])
        self.same = np.concatenate([self.same, same])


@lru_cache(maxsize=1)
def kept_stretches(path_a: str, path_b: str) -> Stretches:
    """Both tokenizers, loaded once for the tasks of a Python worker, which run one after the other."""
    return Stretches(path_a, path_b)


class _Block:
    """Places of a block's groups in its dictionary, and how often it has each of them."""

    def __init__(self, number: int):
        self.number, self.tokens = number, 0
        self.places = self.met = self.counts = np.empty(0, dtype=np.int64)

    def _placed(self, groups: np.ndarray, known: int) -> np.ndarray:
        """Places of groups, by their numbers in a task that has met so many."""
        self.places = np.concatenate([self.places, np.full(known - len(self.places), -1)])
        fresh = np.unique(groups[self.places[groups] < 0])
        self.places[fresh] = np.arange(len(self.met), len(self.met) + len(fresh))
        self.met = np.concatenate([self.met, fresh])
        places = self.places[groups]
        counts = np.bincount(places, minlength=len(self.met))
        counts[: len(self.counts)] += self.counts
        self.counts = counts
        return places

    def parts(self, doc_ids: list[int | None], texts: list[bytes], stretches: Stretches) -> list[dict]:
        """Rows of documents with the places of their groups."""
        units, places, counts = stretches.cut(texts)
        every = stretches.number(units)[places]
        same = sums(~stretches.same[every], counts) == 0
        every, counts = every[np.repeat(same, counts)], counts * same
        groups, each = stretches.held.gather(every)
        n_groups = sums(each, counts)
        n_a, n_b = sums(stretches.n_a[every], counts), sums(stretches.n_b[every], counts)
        n_links = sums(stretches.groups.links.count[groups], n_groups)
        self.tokens += int(n_a.sum())
        names, used, stops = list(map(stretches.groups.texts.__getitem__, groups.tolist())), self._placed(groups, len(stretches.groups.texts)), np.cumsum(n_groups)
        starts = stops - n_groups
        digests = [hashlib.sha256(b";".join(names[low:high])).hexdigest() if high > low else "" for low, high in zip(starts.tolist(), stops.tolist(), strict=True)]
        rows, low = [], 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(stops, starts[low] + PART_GROUPS, side="right")))
            row = {"block": self.number, "kind": _PART, "doc_ids": doc_ids[low:high], "digests": digests[low:high]}
            row |= {name: _packed(own[low:high]) for name, own in (("n_a", n_a), ("n_b", n_b), ("n_groups", n_groups), ("n_links", n_links))}
            rows.append(row | {"groups": _packed(used[starts[low] : stops[high - 1]], "<u4")})
            low = high
        return rows

    def dictionary(self, groups: Groups) -> dict:
        """The row that says which pairs the groups link, and how often the block has each pair."""
        every, sizes = groups.links.gather(self.met)
        pairs, place = np.unique(every, return_inverse=True)
        counts = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(counts, place, np.repeat(self.counts, sizes))
        row = {"block": self.number, "kind": _DICTIONARY, "group_links": _packed(sizes, "<u4"), "link_pairs": _packed(place, "<u4")}
        return row | {"pairs": pairs, "counts": counts}


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of whole texts as numbers of groups, in parts, with their dictionaries of groups and pairs.

    `path_a` is a byte-level vocabulary of `tokenizers`, which encodes a space and the text; `path_b` a sentencepiece
    model that adds that space itself.
    """
    layout = arrow_schema(_BLOCKS.replace("array<string>", "array<long>"))
    layout = layout.set(layout.get_field_index("digests"), pa.field("digests", pa.list_(pa.string())))

    def rows(found: list[dict]) -> pa.RecordBatch:
        return record_batch({name: [row.get(name) for row in found] for name in layout.names}, layout)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretches, block = kept_stretches(path_a, path_b), None
        # A worker that waits, or does other work, holds the tokenizers only; a task that failed may have left more.
        stretches.forget(True)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for low, high in text_slices(texts, 2 * _SLICE_BYTES):
                block = block or _Block(TaskContext.get().partitionId() << 33)
                yield rows(block.parts(doc_ids[low:high], texts[low:high], stretches))
                if len(stretches.numbers.names) > REMEMBERED:
                    stretches.forget(False)
                full = len(stretches.groups.texts) > REMEMBERED_GROUPS
                if full or block.tokens >= block_tokens:
                    yield rows([block.dictionary(stretches.groups)])
                    block = _Block(block.number + 1)
                    if full:
                        stretches.forget(True)
            # Else Arrow keeps what it freed, and the worker is as large as its largest moments together.
            pa.default_memory_pool().release_unused()
        if block:
            yield rows([block.dictionary(stretches.groups)])
        stretches.forget(True)

    return documents(docs).mapInArrow(align, _BLOCKS)


def pair_rows(blocks: DataFrame) -> DataFrame:
    """block, place in its dictionary, pair, n: how many links of the block hold the pair."""
    zipped = F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "entry")
    return blocks.select("block", zipped).select("block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.counts").alias("n"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, id_b, n over all blocks."""
    return rows.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("id_b", F.col("pair") % PAIR)


def with_best(counts: DataFrame) -> DataFrame:
    """pair, n, best: whether no other pair of the second id has a higher count."""
    highest = counts.groupBy("id_b").agg(F.max("n").alias("highest"))
    return counts.join(highest, "id_b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def link_figures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """The figures of each document, from blocks and the corpus-wide counts of `with_best`."""
    looked = pair_rows(blocks).select("block", "place", "pair").join(counts, "pair").select("block", "place", "n", "best")
    lookup, layout = arrow_schema(_LOOKUP), arrow_schema(_FIGURES)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["block"]):
            figures = {"pair_counts": [_packed(group["n"])], "pair_best": [_packed(group["best"], "u1")]}
            yield record_batch({"block": group["block"][:1], "kind": [_COUNTED], **figures}, lookup)

    lookups = looked.repartition("block").sortWithinPartitions("block", "place").mapInArrow(gather, _LOOKUP)
    every = blocks.drop("pairs", "counts").unionByName(lookups, allowMissingColumns=True)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block whose texts have no tokens has no pairs, and so no row with their counts.
        count = first = count_of = first_of = np.empty(0, dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                own = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                if own["kind"] == _COUNTED:
                    count, first = np.frombuffer(own["pair_counts"], dtype="<i8"), np.frombuffer(own["pair_best"], dtype="u1").astype(np.int64)
                elif own["kind"] == _DICTIONARY:
                    links, pairs = (np.frombuffer(own[name], dtype="<u4").astype(np.int64) for name in ("group_links", "link_pairs"))
                    count_of, first_of = sums(count[pairs], links), sums(first[pairs], links)
                else:
                    groups, n_groups = np.frombuffer(own["groups"], dtype="<u4").astype(np.int64), np.frombuffer(own["n_groups"], dtype="<i8")
                    columns = {name: np.frombuffer(own[name], dtype="<i8") for name in ("n_a", "n_b", "n_links")}
                    columns |= {"doc_id": own["doc_ids"], "n_groups": n_groups, "groups_sha256": own["digests"]}
                    columns |= {"n_best": sums(first_of[groups], n_groups), "count_sum": sums(count_of[groups], n_groups)}
                    yield record_batch(columns, layout)

    return every.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(add_up, _FIGURES)


def alignment(docs: DataFrame, path_a: str, path_b: str, space: Workspace, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """(figures of each document, corpus-wide pairs).

    Figures: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Pairs: id_a, id_b, n, best. A text that is
    NULL or empty, or whose tokens of either side do not spell the space and the text byte by byte, has no tokens: zeros
    and an empty digest. Every row is a document, also if its doc_id is NULL or repeated; equal texts count each time.
    An empty table gives no rows; other columns are ignored. Strings of special tokens are plain text.
    """
    blocks = space.table("blocks", aligned_blocks(docs, path_a, path_b, block_tokens), BATCH_BYTES, **_FEW_ROWS)
    counts = space.table("pairs", with_best(pair_counts(pair_rows(blocks))))
    pairs = counts.select(F.expr(f"pair div {PAIR}L").alias("id_a"), (F.col("pair") % PAIR).alias("id_b"), "n", "best")
    return space.table("figures", link_figures(blocks, counts), BATCH_BYTES), pairs
