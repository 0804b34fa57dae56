"""Token ids from the `tokenizers` library inside tasks, with a cache of words.

A text is cut into units, most of which have been seen; Arrow cuts a slice of texts and gives its distinct units. Cuts lie only where the tokenizer's pre-tokenizer begins a piece
whatever stands around, so the joined ids of the units are those of the whole text. Units that were not seen are
encoded many in one call, strung together at such places; the lengths of their tokens tell where each unit ends. The ids of
a text are then gathered by the numbers of its units. What a byte-level tokenizer does to units of Latin letters, digits and
marks is simple: runs of one kind are its pieces. Those are cut here, and each distinct piece of a task goes to the library's
model once, whatever units it is part of. For the other kind of tokenizer, so do those of units of Latin letters and marks,
in small letters.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of the cache of one task; a full cache starts anew, which changes no result.
CACHE_UNITS = 500_000
_UNITS_A_CALL = 1000
_PIECES_A_CALL = 4000

#: Marks that form one piece after a word. The apostrophe is not among them, because it begins contractions.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_SPACE_STARTS = re.compile(r"(?<=\S)(?= )|(?= \S)")
#: Byte pairs without which every space of a text begins a unit: a space before another ASCII blank, and other blanks.
_OTHER_BLANKS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_UNUSUAL_BLANKS = (b"  ", b" \t", b" \n", b" \x0b", b" \x0c", b" \r", *_OTHER_BLANKS)

#: Texts with any of these, or with a NUL, are cut by `space_units`.
UNUSUAL = " [ \t\n\x0b\x0c\r]|[\x00\x85\xa0\u1680\u2000-\u203f\u205f\u3000]"

#: What bytes are: letters, digits, marks, a line end, a space, the first byte of a Latin letter of two (U+00C0 to U+024F), or other.
_OTHER, _LETTER, _DIGIT, _MARK, _LINE, _SPACE, _LEAD = range(7)
_KINDS = np.zeros(256, dtype=np.uint8)
for _kind, _bytes in (
    (_LETTER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), (_DIGIT, b"0123456789"), (_MARK, _MARKS), (_LINE, b"\n"),
    (_SPACE, b" "), (_LEAD, b"\xc3\xc4\xc5\xc6\xc7\xc8\xc9"),
):
    _KINDS[list(_bytes)] = _kind

#: How byte-level vocabularies spell bytes. No piece holds a NUL, which parts pieces in a call.
_SPELLED = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_ALPHABET = {b: chr(b) for b in _SPELLED} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SPELLED)}
_ALPHABET = "\n" + "".join(_ALPHABET[b] for b in range(1, 256))

Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class Numbers(dict):
    """Numbers for units in the order they come up; `names` has the units in that order."""

    def __init__(self):
        self.names: list[bytes] = []

    def __missing__(self, unit: bytes) -> int:
        self[unit] = number = len(self.names)
        self.names.append(unit)
        return number

    def of(self, units: list[bytes]) -> np.ndarray:
        """The numbers of distinct units."""
        fresh = [unit for unit in units if unit not in self]
        self.update(zip(fresh, range(len(self.names), len(self.names) + len(fresh)), strict=True))
        self.names += fresh
        return np.fromiter(map(self.__getitem__, units), dtype=np.int64, count=len(units))


class Store:
    """Ids of all units one after the other; `start` and `count` by number."""

    def __init__(self):
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.used = 0
        self.start, self.count = np.empty(1 << 14, dtype=np.int64), np.empty(1 << 14, dtype=np.int64)

    def reserve(self, units: int) -> None:
        if units > len(self.start):
            grow = 2 * units - len(self.start)
            self.start, self.count = (np.concatenate([own, np.empty(grow, dtype=np.int64)]) for own in (self.start, self.count))

    def put(self, numbers: list[int], ids: np.ndarray, count: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(self.used + 2 * len(ids), dtype=np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[numbers], self.count[numbers] = self.used + np.cumsum(count) - count, count
        self.used += len(ids)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units one after the other, number of ids of each)."""
        count = self.count[numbers]
        ends = np.cumsum(count)
        shift = np.repeat(self.start[numbers] - (ends - count), count)
        return self.ids[shift + np.arange(len(shift))], count


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def space_units(text: bytes) -> list[bytes]:
    """Units for a byte-level tokenizer whose words take the one space before them. All but the first start with
    a space, which is left out, or are marked by a leading NUL if they do not. A text that holds a NUL is one unit.

    A space starts a piece unless it continues a run of blanks that goes on after it.
    """
    if b"\x00" in text:
        return [b"\x00" + text]
    if not any(pair in text for pair in _UNUSUAL_BLANKS):
        units = text.split(b" ")
        units[0] = b"\x00" + units[0]
        return units
    cut = _SPACE_STARTS.split(text.decode("utf-8", "replace"))
    return [unit[1:].encode() if unit[0] == " " else b"\x00" + unit.encode() for unit in cut if unit]


def bytes_of(column: pa.Array) -> list[bytes]:
    """Values of a large binary column without NULLs; slices of its buffer, which is faster than one by one through Arrow."""
    if not len(column):
        return []
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    held = data.to_pybytes() if data is not None else b""
    return [held[low:high] for low, high in zip(ends, ends[1:], strict=False)]


def distinct_units(texts: list[bytes], blanks_dropped: bool) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct units of texts, place of every unit among them, number of units of each text)."""
    column = pa.array(texts, pa.large_binary()).view(pa.large_string())
    usual = np.ones(len(texts), dtype=bool)
    if not blanks_dropped:
        usual = ~pc.match_substring_regex(column, UNUSUAL).to_numpy(zero_copy_only=False)
        plain = [b"\x00" + text for text, own in zip(texts, usual.tolist(), strict=True) if own]
        column = pa.array(plain, pa.large_binary()).view(pa.large_string())
    cut = pc.ascii_split_whitespace(column) if blanks_dropped else pc.split_pattern(column, " ")
    counts, flat = cut.value_lengths().to_numpy().astype(np.int64), cut.flatten()
    if blanks_dropped:  # blanks at the ends of a text leave empty units
        full = pc.not_equal(pc.binary_length(flat), 0)
        reached = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
        ends = np.cumsum(counts)
        counts, flat = reached[ends] - reached[ends - counts], flat.filter(full)
    coded = flat.dictionary_encode()
    units, places = bytes_of(coded.dictionary.view(pa.large_binary())), coded.indices.to_numpy().astype(np.int64)
    if usual.all():
        return units, places, counts
    known = Numbers()
    for unit in units:
        known[unit]
    stops, own, parts = np.cumsum(counts).tolist(), 0, []
    for text, is_usual in zip(texts, usual.tolist(), strict=True):
        if is_usual:
            parts.append(places[stops[own - 1] if own else 0 : stops[own]])
            own += 1
        else:
            parts.append(np.array([known[unit] for unit in space_units(text)], dtype=np.int64))
    return known.names, np.concatenate(parts), np.array(list(map(len, parts)), dtype=np.int64)


def plain_runs(units: list[bytes], digits: bool = True, lowers: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(which units are plain, the pieces of the plain ones one after the other, number of pieces of each of them).

    A plain unit has only Latin letters, digits (if `digits` says that a run of them is a piece), marks, and single line ends
    between those. Its first piece has the space before it. If the tokenizer `lowers`, ASCII letters come out small, and U+0130 is
    no such letter, because it becomes two characters.
    """
    sizes = np.fromiter(map(len, units), dtype=np.int64, count=len(units)) + 1
    starts = np.cumsum(sizes) - sizes
    joined = b" ".join([b"", *units, b""])
    if lowers:
        joined = joined.lower()
    data = np.frombuffer(joined, dtype=np.uint8)
    kind = _KINDS[data]
    lead = np.flatnonzero(kind == _LEAD)
    first, second = data[lead], data[lead + 1]
    letter = (second >= 0x80) & (second < 0xC0) & ~((first == 0xC3) & ((second == 0x97) | (second == 0xB7))) & ~((first == 0xC9) & (second >= 0x90))
    if lowers:
        letter &= (first != 0xC4) | (second != 0xB0)
    kind[lead] = np.where(letter, _LETTER, _OTHER)
    kind[lead[letter] + 1] = _LETTER
    odd = (kind == _OTHER) | (kind == _SPACE)
    if not digits:
        odd |= kind == _DIGIT
    lines = np.flatnonzero(kind == _LINE)
    odd[lines] = (kind[lines - 1] >= _LINE) | (kind[lines + 1] >= _LINE)
    odd[starts] = False
    plain = ~np.logical_or.reduceat(odd[:-1], starts) & (sizes > 1) if len(units) else np.zeros(0, dtype=bool)
    begin = np.ones(len(data), dtype=bool)  # the space after the last unit ends the last piece
    begin[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
    begin[starts] = begin[-1] = True
    offsets = np.flatnonzero(begin)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
    counts = np.diff(np.searchsorted(offsets, np.append(starts, len(data) - 1)))
    if not plain.all():
        pieces = pieces.filter(pa.array(np.repeat(plain, counts)))
    return plain, pieces, counts[plain]


def encoder(path: str, blanks_dropped: bool, cache_units: int = CACHE_UNITS) -> Encode:
    """A function from UTF-8 texts to (ids of all texts one after the other, the number of ids of each text).

    The strings of special tokens are ordinary text. `blanks_dropped` says that the tokenizer lower-cases, drops white
    space and never joins across it; otherwise it is byte-level, with words that take the space before them.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    lengths = np.zeros(whole.get_vocab_size(), dtype=np.int64)
    for token, id_ in whole.get_vocab().items():
        lengths[id_] = len(token.removesuffix("</w>") if blanks_dropped else token)  # a letter of a token is a byte
    model = Tokenizer(whole.model)
    model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
    digits = isinstance(whole.pre_tokenizer, pre_tokenizers.ByteLevel) and whole.pre_tokenizer.use_regex
    numbers, store = Numbers(), Store()
    piece_numbers, piece_store = Numbers(), Store()

    def add_singly(own: list[int]) -> None:
        texts = [numbers.names[n].decode("utf-8", "replace") for n in own]
        if not blanks_dropped:
            texts = [text[1:] if text[:1] == "\x00" else " " + text for text in texts]
        found = [encoding.ids for encoding in whole.encode_batch_fast(texts, add_special_tokens=False)]
        store.put(own, np.array([id_ for ids in found for id_ in ids], dtype=np.uint32), np.array([len(ids) for ids in found]))

    def add_together(own: list[int]) -> None:
        units = [numbers.names[n] for n in own]
        joined = b" ".join(units)
        text, shown, apart = joined.decode("utf-8", "replace"), units, 0
        if not blanks_dropped:
            text, apart = " " + text, 1
        elif not joined.isascii():
            shown = [part.encode() for part in whole.normalizer.normalize_str(text).split(" ")]
        put(own, whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, shown, apart)

    def put(own: list[int], found: list[int], shown: list[bytes], apart: int) -> None:
        """Keeps ids that spell out units one after the other, each with `apart` bytes more than shown."""
        ids = np.array(found, dtype=np.uint32)
        reached, wanted = np.cumsum(lengths[ids]), np.cumsum(np.fromiter(map(len, shown), dtype=np.int64, count=len(shown)) + apart)
        ends = np.searchsorted(reached, wanted) + 1
        if len(shown) != len(own) or not len(ids) or ends[-1] != len(ids) or not np.array_equal(reached[ends - 1], wanted):
            add_singly(own)  # a character was dropped or changed its length
        else:
            store.put(own, ids, np.diff(ends, prepend=0))

    def add(first: int) -> None:
        """Encodes the units numbered from `first` on."""
        store.reserve(len(numbers.names))
        together: list[list[int]] = [[], []]
        alone = []
        for n, unit in enumerate(numbers.names[first:], first):
            if blanks_dropped:
                together[not unit.isascii()].append(n)
            # What begins or ends with a blank, or is a first unit, is not strung together with others.
            elif unit and unit[0] > 32 and unit[-1] > 32:
                together[0].append(n)
            else:
                alone.append(n)
        if not blanks_dropped:
            fresh = b" ".join(numbers.names[first:])
            if any(pair in fresh for pair in _OTHER_BLANKS):
                odd = {n for n in together[0] if any(pair in numbers.names[n] for pair in _OTHER_BLANKS)}
                together[0] = [n for n in together[0] if n not in odd]
                alone += odd
        for own in together:
            for low in range(0, len(own), _UNITS_A_CALL):
                add_together(own[low : low + _UNITS_A_CALL])
        for low in range(0, len(alone), 20_000):
            add_singly(alone[low : low + 20_000])

    def add_pieces(first: int) -> None:
        """Encodes the pieces numbered from `first` on, many strung together."""
        piece_store.reserve(len(piece_numbers.names))
        for low in range(first, len(piece_numbers.names), _PIECES_A_CALL):
            pieces = piece_numbers.names[low : low + _PIECES_A_CALL]
            joined = b"\x00".join(pieces)
            if blanks_dropped:
                joined = joined.replace(b" ", b"").decode().lower().encode()
                pieces = joined.split(b"\x00")
            spelled = codecs.charmap_decode(joined, "strict", _ALPHABET)[0]
            own = range(low, low + len(pieces))
            ids = np.array(model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, dtype=np.uint32)
            reached, wanted = np.cumsum(lengths[ids]), np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)))
            ends = np.searchsorted(reached, wanted) + 1
            if not len(ids) or ends[-1] != len(ids) or not np.array_equal(reached[ends - 1], wanted):
                found = [encoding.ids for encoding in model.encode_batch_fast(spelled.split("\n"), add_special_tokens=False)]
                ids, count = np.array([id_ for one in found for id_ in one], dtype=np.uint32), np.array([len(one) for one in found])
            else:
                count = np.diff(ends, prepend=0)
            piece_store.put(list(own), ids, count)

    def cached(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the distinct units one after the other, number of ids of each), by the cache of units."""
        nonlocal numbers, store
        if len(numbers.names) > cache_units:
            numbers, store = Numbers(), Store()
        first = len(numbers.names)
        own = numbers.of(units)
        if len(numbers.names) > first:
            add(first)
        return store.gather(own)

    def cut(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same, by the cache of pieces for plain units."""
        nonlocal piece_numbers, piece_store
        if len(piece_numbers.names) > cache_units:
            piece_numbers, piece_store = Numbers(), Store()
        first = len(piece_numbers.names)
        plain, pieces, parts = plain_runs(units, digits, lowers=blanks_dropped)
        coded = pieces.dictionary_encode()
        distinct = bytes_of(coded.dictionary)
        own = piece_numbers.of(distinct)
        if len(piece_numbers.names) > first:
            add_pieces(first)
        ids, count = piece_store.gather(own[coded.indices.to_numpy()])
        count = np.diff(np.concatenate([[0], np.cumsum(count)])[np.cumsum(parts)], prepend=0)
        if plain.all():
            return ids, count
        more, counts = cached([unit for unit, is_plain in zip(units, plain.tolist(), strict=True) if not is_plain])
        every = np.empty(len(units), dtype=np.int64)
        every[plain], every[~plain] = count, counts
        merged = np.empty(len(ids) + len(more), dtype=np.uint32)
        of_plain = np.repeat(plain, every)
        merged[of_plain], merged[~of_plain] = ids, more
        return merged, every

    def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        distinct, places, units = distinct_units(texts, blanks_dropped)
        found, own = cut(distinct)
        here = Store()
        here.reserve(len(distinct))
        here.ids, here.used = found, len(found)
        here.start[: len(own)], here.count[: len(own)] = np.cumsum(own) - own, own
        ids, count = here.gather(places)
        reached = np.concatenate([[0], np.cumsum(count)])[np.cumsum(units)]
        return ids, np.diff(reached, prepend=0)

    return encode


@lru_cache(maxsize=1)
def kept_encoder(path: str, blanks_dropped: bool) -> Encode:
    """An encoder that the tasks of one Python worker share, one after the other, with its bounded caches."""
    return encoder(path, blanks_dropped)


def text_slices(texts: list[bytes], most: int = 4 << 20):
    """Index ranges of texts of about `most` bytes together, which bounds the ids held at once."""
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= most:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
