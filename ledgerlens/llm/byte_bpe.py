"""Byte-level BPE by rank files: encoding with a segment tree of pair ranks, and decoding.

A text is cut by a pattern into pieces. A piece that is a token is encoded as such. In any other, the adjacent pair of
lowest rank is merged, the leftmost of equal ones, until no pair has a rank. A segment tree over the byte positions of a
piece holds at each node the lowest rank below it with its position, so its root is the next merge. A merge changes the
pair that starts at its position, the pair of the live neighbour before, and removes that of the neighbour that was
taken: three point updates, each along one path to the root.

Distinct pieces of a slice of texts are encoded together: those of up to `LOCKSTEP_BYTES` bytes in rows of numpy arrays, one
merge of each piece at a step, and longer ones one by one on the same tree.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import arrow_schema, byte_texts, documents, record_batch
from ledgerlens.llm.tokens import text_slices

LOCKSTEP_BYTES = 64
#: Pieces in one set of arrays, which bounds their size.
_LOCKSTEP_ROWS = 1 << 15
#: Pieces remembered by a task; a full memory starts anew, which changes no result.
REMEMBERED = 500_000

_NONE = np.iinfo(np.int64).max
_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ENCODED = "doc_id long, ids binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with lines of base64 and a number. The rank is the id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """Ranks of pairs of tokens: a pair has the rank of the token that both make together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        self.of_pair = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.values = np.array([pairs[key] for key in self.keys.tolist()], dtype=np.int64)
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"Bytes without a rank: {missing[:10]}")
        self.of_byte = np.array([ranks[bytes([byte])] for byte in range(256)], dtype=np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, `_NONE` where they make no token."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        wanted = left * self.size + right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.values[place], _NONE)

    def encode_long(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        size, of_pair = self.size, self.of_pair
        token = self.of_byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(token)
        width = 1 << max(0, n - 1).bit_length()
        none = (size + 1) * width
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = of_pair.get(token[i] * size + token[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def update(i: int, value: int) -> None:
            node = width + i
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return  # nothing above changes either
                tree[node] = value

        def pair(i: int) -> int:
            j = after[i]
            rank = of_pair.get(token[i] * size + token[j]) if j < n else None
            return none if rank is None else rank * width + i

        while width > 1 and tree[1] < none:
            rank, i = divmod(tree[1], width)
            taken = after[i]
            token[i], after[i] = rank, after[taken]
            if after[i] < n:
                before[after[i]] = i
            update(taken, none)
            update(i, pair(i))
            if before[i] >= 0:
                update(before[i], pair(before[i]))
        ids, i = [], 0
        while i < n:
            ids.append(token[i])
            i = after[i]
        return ids

    def encode_lockstep(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces of 2 to `LOCKSTEP_BYTES` bytes of about the same length."""
        rows, lengths = len(pieces), np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        width = 1 << int(lengths.max() - 1).bit_length()
        packed = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), dtype=np.uint8)
        # One place more at each end of a row than there are bytes, so that neighbours always exist.
        stride = width + 2
        token = np.zeros((rows, stride), dtype=np.int64)
        token[:, 1:-1] = self.of_byte[packed].reshape(rows, width)
        tree = np.full((rows, 2 * width), _NONE)
        place = np.arange(width)
        paired = place[None, :] < lengths[:, None] - 1
        row, i = np.nonzero(paired)
        found = self.look_up(token[row, i + 1], token[row, i + 2])
        has = found != _NONE
        tree[row[has], width + i[has]] = found[has] * width + i[has]
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        after = np.tile(np.arange(1, stride + 1), (rows, 1))
        before = np.tile(np.arange(-1, stride - 1), (rows, 1))
        live = np.zeros((rows, stride), dtype=bool)
        live[:, 1:-1] = place[None, :] < lengths[:, None]
        flat_token, flat_after, flat_before, flat_live, flat_tree = (a.reshape(-1) for a in (token, after, before, live, tree))

        def pairs(base: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
            """Tree values of the pairs that start at places `at`, counted from 1."""
            follower = flat_after[base + at]
            ranks = self.look_up(flat_token[base + at], flat_token[base + follower])
            return np.where((at < 1) | (follower > last) | (ranks == _NONE), _NONE, ranks * width + at - 1)

        def update(root: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
            inside = at >= 1
            root, node, values = root[inside], width + at[inside] - 1, values[inside]
            flat_tree[root + node] = values
            while node.size and node[0] > 1:
                values = np.minimum(values, flat_tree[root + (node ^ 1)])
                node = node >> 1
                flat_tree[root + node] = values

        active = np.flatnonzero(tree[:, 1] != _NONE)
        while len(active):
            root, base, last = active * (2 * width), active * stride, lengths[active]
            ranks, at = np.divmod(flat_tree[root + 1], width)
            at += 1
            taken = flat_after[base + at]
            further = flat_after[base + taken]
            flat_token[base + at] = ranks
            flat_after[base + at] = further
            flat_before[base + further] = at
            flat_live[base + taken] = False
            update(root, taken, np.full(len(active), _NONE))
            update(root, at, pairs(base, last, at))
            previous = flat_before[base + at]
            update(root, previous, pairs(base, last, previous))
            active = active[flat_tree[root + 1] != _NONE]
        ids = token[live].tolist()
        ends = np.cumsum(live.sum(axis=1)).tolist()
        return [ids[low:high] for low, high in zip([0, *ends[:-1]], ends, strict=True)]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of distinct pieces, none empty."""
        found: list[list[int]] = [[]] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                found[i] = [rank]
            elif len(piece) > LOCKSTEP_BYTES:
                found[i] = self.encode_long(piece)
            else:
                classes.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for own in classes.values():
            for low in range(0, len(own), _LOCKSTEP_ROWS):
                part = own[low : low + _LOCKSTEP_ROWS]
                for i, ids in zip(part, self.encode_lockstep([pieces[i] for i in part]), strict=True):
                    found[i] = ids
        return found


class Codec:
    """Encodes and decodes texts; remembers pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = REMEMBERED):
        import regex

        self.merges, self.cut, self.remembered = Merges(ranks), regex.compile(pattern).findall, remembered
        self.token_of = [b""] * self.merges.size
        for token, rank in ranks.items():
            self.token_of[rank] = token
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        if len(self.known) > self.remembered:
            self.known = {}
        cuts, known = [self.cut(text) for text in texts], self.known
        fresh = list({piece for pieces in cuts for piece in pieces if piece not in known})
        for piece, ids in zip(fresh, self.merges.encode_pieces([piece.encode() for piece in fresh]), strict=True):
            known[piece] = ids
        for pieces in cuts:
            yield [id_ for piece in pieces for id_ in known[piece]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


def _over_texts(docs: DataFrame, path: str, pattern: str, ddl: str, columns: Callable[[Codec, list[list[int]]], dict]) -> DataFrame:
    """One pass over the texts, in slices that bound what a task holds."""
    layout = arrow_schema(ddl)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(read_ranks(path), pattern)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for low, high in text_slices(texts):
                ids = list(codec.encode([text.decode("utf-8", "replace") for text in texts[low:high]]))
                yield record_batch({"doc_id": doc_ids[low:high], **columns(codec, ids)}, layout)

    return documents(docs).mapInArrow(code, ddl)


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian, unsigned, 32 bits each) of every row.

    `path` is a rank file, `pattern` what cuts texts into pieces. NULL text is empty and has no ids. NULL doc_ids and
    repeated rows are kept: each row is a document. An empty table gives no rows; other columns are ignored. One pass, no
    shuffle. Strings that look like special tokens are ordinary text.
    """
    return _over_texts(docs, path, pattern, _ENCODED, lambda _, found: {"ids": [np.array(ids, dtype="<u4").tobytes() for ids in found]})


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and bytes of ids as `encoded` gives them. NULL ids decode to NULL; an id without a token fails the job."""
    layout = arrow_schema("doc_id long, bytes binary")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_of = {rank: token for token, rank in read_ranks(path).items()}
        for batch in batches:
            rows = (None if ids is None else np.frombuffer(ids, dtype="<u4").tolist() for ids in batch.column(1).to_pylist())
            texts = [None if ids is None else b"".join([token_of[id_] for id_ in ids]) for ids in rows]
            yield record_batch({"doc_id": batch.column(0).to_pylist(), "bytes": texts}, layout)

    return tokens.select(tokens["doc_id"].cast("long"), tokens["ids"].cast("binary")).mapInArrow(decode, "doc_id long, bytes binary")


def round_trip_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 of every row, encoded and decoded again
    in one pass. Rows are treated as by `encoded`."""

    def digests(codec: Codec, found: list[list[int]]) -> dict:
        digits = [str(id_).encode() for id_ in range(codec.merges.size)]
        return {
            "n_tokens": [len(ids) for ids in found],
            "ids_sha256": [hashlib.sha256(b",".join(map(digits.__getitem__, ids))).hexdigest() for ids in found],
            "decoded_sha256": [hashlib.sha256(codec.decode(ids)).hexdigest() for ids in found],
        }

    return _over_texts(docs, path, pattern, _DIGEST, digests)
