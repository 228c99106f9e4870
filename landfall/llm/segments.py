"""Token ids of whole texts by the public byte-level BPE tokenizer.

The tokenizer's own splitting never joins what a run of white space separates
from the text before it, so a text cuts into *segments* (white space, then
what follows up to the next white space) that are encoded each by itself.
Segments repeat a great deal: a worker looks them up by a 128-bit hash, the
library encodes those it has not met, and ids of whole texts are gathered from
the results by index arithmetic.
"""

from __future__ import annotations

import os

import numpy as np

from landfall.llm.common import GOLD, TextSlice, kept, span_hash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Segments kept per worker, and their numbers; beyond it the store starts anew.
STORE_SEGMENTS = 1_000_000
STORE_NUMBERS = 8_000_000

#: The library is given new segments about so many bytes at a time: what it
#: holds for a string while it encodes it is over a hundred times as large.
LEARN_BYTES = 1 << 16


def segment_starts(s: TextSlice, white: np.ndarray = _SPACE) -> np.ndarray:
    """Byte positions at which a segment begins: each text's start, and each
    run of ``white`` bytes (ASCII white space) that follows another character,
    unless that one is white space too (the non-ASCII kinds) or U+2581, which
    tokenizers take together with the run."""
    d = s.data
    if not len(d):
        return np.zeros(0, np.int64)
    space = white[d]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[0] = True
    at = np.flatnonzero(begins)
    at = at[at >= 2]
    p1, p2 = d[at - 1], d[at - 2]
    p3 = np.where(at >= 3, d[np.maximum(at - 3, 0)], 0)
    # UTF-8 ends of U+0085 U+00A0, U+1680, U+2000-200A U+2028 U+2029 U+202F, U+205F, U+3000, U+2581
    wide = ((p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))) | ((p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80)) \
        | ((p3 == 0xE2) & (p2 == 0x80) & (((p1 >= 0x80) & (p1 <= 0x8A)) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))) \
        | ((p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)) | ((p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80)) \
        | ((p3 == 0xE2) & (p2 == 0x96) & (p1 == 0x81))
    begins[at[wide]] = False
    begins[s.offsets[:-1][np.diff(s.offsets) > 0]] = True
    return np.flatnonzero(begins)


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``begin[i]``, ``begin[i] + 1``, ... up to ``length[i]`` of them, for each i."""
    ends = np.cumsum(length)
    return np.repeat(begin - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)


class HashStore:
    """An open-addressing table from 128-bit hashes to numbers, all lookups
    and insertions by whole arrays. It is never more than half full."""

    def __init__(self, bits: int = 12):
        self.count = 0
        self._empty(bits)

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.mask = np.uint64((1 << bits) - 1)
        self.key = np.zeros(1 << bits, np.uint64)
        self.check = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros(1 << bits, np.int32)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The number stored for each hash, or -1. Keys are never 0."""
        out = np.full(len(key), -1, np.int32)
        left = np.arange(len(key))
        slot = key & self.mask
        while left.size:
            there = self.key[slot]
            hit = (there == key[left]) & (self.check[slot] == check[left])
            out[left[hit]] = self.value[slot[hit]]
            go = ~hit & (there != 0)
            left, slot = left[go], (slot[go] + np.uint64(1)) & self.mask
        return out

    def add(self, key: np.ndarray, check: np.ndarray, value: np.ndarray) -> None:
        """Store hashes that are distinct and not there yet."""
        self.count += len(key)
        if 2 * self.count > len(self.key):
            there = self.key != 0
            old = self.key[there], self.check[there], self.value[there]
            self._empty(max(self.bits + 1, (2 * self.count).bit_length()))
            self._place(*old)
        self._place(key, check, value)

    def _place(self, key: np.ndarray, check: np.ndarray, value: np.ndarray) -> None:
        left = np.arange(len(key))
        slot = key & self.mask
        while left.size:
            free = self.key[slot] == 0
            at, who = slot[free], left[free]
            self.value[at] = who  # of several for one slot, the last written takes it
            won = self.value[at] == who
            at, who = at[won], who[won]
            self.key[at], self.check[at] = key[who], check[who]
            placed = np.zeros(len(key), bool)
            placed[who] = True
            go = ~placed[left]
            left, slot = left[go], slot[go]
            taken = self.key[slot] != 0
            slot = np.where(taken, (slot + np.uint64(1)) & self.mask, slot)
        where = key & self.mask
        todo = np.arange(len(key))
        while todo.size:
            mine = (self.key[where] == key[todo]) & (self.check[where] == check[todo])
            self.value[where[mine]] = value[todo[mine]]
            todo, where = todo[~mine], (where[~mine] + np.uint64(1)) & self.mask


class SegmentStore:
    """Remembers, per worker, an array of numbers for each distinct segment
    met, and looks whole slices up. ``learn`` gets bytes and the begin and
    end of each new segment in them, and returns these arrays back to back
    with the length of each."""

    def __init__(self, learn, white: np.ndarray = _SPACE, most_numbers: int | None = None):
        self.learn, self.white, self.most_numbers = learn, white, most_numbers
        self._reset()

    def _reset(self) -> None:
        self.store = HashStore()
        self.count = 0
        self.data = np.zeros(1 << 18, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # ends[i + 1]: the end of segment i's array

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.ends[self.count])
        while used + len(flat) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while self.count + len(lengths) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.data[used:used + len(flat)] = flat
        self.ends[self.count + 1:self.count + 1 + len(lengths)] = used + np.cumsum(lengths)
        self.count += len(lengths)

    def starts(self, s: TextSlice) -> np.ndarray:
        return segment_starts(s, self.white)

    def full(self) -> bool:
        """Whether the store starts anew at the next look-up."""
        return self.count > STORE_SEGMENTS * (2 if self.most_numbers else 1) or int(self.ends[self.count]) > (self.most_numbers or STORE_NUMBERS)

    def look_up(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each segment of the slice its number, the segments' byte
        positions (one more than there are), and for each text its first
        segment (one more than there are texts)."""
        if self.full():
            self._reset()
        starts = self.starts(s)
        bounds = np.append(starts, len(s.data)).astype(np.int64)
        first = np.searchsorted(starts, s.offsets)
        key = span_hash(s.data, bounds[:-1], bounds[1:]) | np.uint64(1)
        check = span_hash(s.data, bounds[:-1], bounds[1:], second=True)
        numbers = self.store.find(key, check)
        if (missing := np.flatnonzero(numbers < 0)).size:
            both = key[missing] + check[missing] * GOLD
            _, index, which = np.unique(both, return_index=True, return_inverse=True)
            at = missing[index]
            assert np.array_equal(key[at][which], key[missing]) and np.array_equal(check[at][which], check[missing])
            flat, lengths = self.learn(s.data, bounds[at], bounds[at + 1])
            base = self.count
            self._append(flat, lengths)
            fresh = np.arange(base, base + len(at), dtype=np.int32)
            self.store.add(key[at], check[at], fresh)
            numbers[missing] = fresh[which]
        return numbers, bounds, first

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of segments back to back, and their ends, from 0."""
        begin = self.ends[numbers]
        length = self.ends[numbers + 1] - begin
        return self.data[spread(begin, length)], np.concatenate([[0], np.cumsum(length)])


class SegmentEncoder:
    """Ids of texts by the library's tokenizer, remembering segments."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.id_bytes[i] = len(piece)  # the byte-level alphabet has one character a byte
        self.store = SegmentStore(self._learn)

    def _learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = np.cumsum(end - begin) // LEARN_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(begin)]
        got = [self._encoded(data, begin[a:b], end[a:b]) for a, b in zip(cuts, cuts[1:])]
        return np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])

    def _encoded(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # segments that begin with white space and end with another ASCII
        # character stay apart when they stand in one string, which the
        # library takes faster than many
        last = data[end - 1]
        joins = _SPACE[data[begin]] & (last > 0x20) & (last < 0x7F)
        size = end - begin
        ids, lengths = np.zeros(0, np.uint32), np.zeros(len(begin), np.int64)
        if joins.any():
            bytes_at = spread(begin[joins], size[joins])
            ids = np.array(self.tokenizer.encode(data[bytes_at].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            ends, want = np.cumsum(self.id_bytes[ids]), np.cumsum(size[joins])
            at = np.minimum(np.searchsorted(ends, want), len(ends) - 1)
            if np.array_equal(ends[at], want):
                lengths[joins] = np.diff(at, prepend=-1)
            else:
                joins, ids = np.zeros_like(joins), ids[:0]
        alone = np.flatnonzero(~joins)
        got = self.tokenizer.encode_batch_fast([data[begin[i]:end[i]].tobytes().decode() for i in alone], add_special_tokens=False)
        got = [np.array(e.ids, np.uint32) for e in got]
        lengths[alone] = [len(x) for x in got]
        first = np.cumsum(lengths) - lengths
        flat = np.zeros(int(lengths.sum()), np.uint32)
        flat[spread(first[joins], lengths[joins])] = ids
        flat[spread(first[alone], lengths[alone])] = np.concatenate([ids[:0], *got])
        return flat, lengths

    def encode(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's texts back to back, and where each text's
        ids begin (one more than there are texts)."""
        numbers, _, first = self.store.look_up(s)
        ids, ends = self.store.gather(numbers)
        return ids, ends[first]


def encoder(path: str) -> SegmentEncoder:
    """This worker's encoder for a tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return kept(("encoder", path), lambda: SegmentEncoder(path))
