"""Operator 12, alignment of two tokenizers by a minimal perfect hash of the
token pairs that meet.

Both tokenizers cut a text before each run of white space, so a text is
aligned segment by segment: the byte offsets where tokens of both end cut it
into groups, and every stretch between two ends of any kind is one link of an
A token and a B token. A worker looks up the segments that it has met.

A first pass over the texts gives the pairs that occur, with partial counts.
The distinct pairs get a minimal perfect hash, built shard by shard (levels of
bit arrays: a pair alone at its place sets the bit, the others go to the next
level; a pair's index is the rank of its bit), with the pairs themselves in
index order to verify a look-up. Partial counts are added into dense vectors
by index, one vector a task and shard, and these are summed as a tree. A
second pass aligns the texts again and looks the counts up.

The hash, the pairs and the counts are broadcast in blocks of shards of at most
``TABLE_BYTES``, whatever the number of pairs (less than the product of the
vocabularies, 1.6e9); with several blocks the second pass goes over the texts
once for each and adds up.

Defined results: null and empty texts, and texts that a tokenizer does not give
back byte for byte (such with a U+2581), have no tokens: zeros, and an empty
digest; their pairs count nowhere. Special strings are plain text. Repeated
rows are aligned, and counted, each; a null id stays null. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import GOLD, TextSlice, kept, mix, read, staged, text_slices
from landfall.llm.prefixes import byte_alphabet
from landfall.llm.segments import SegmentEncoder, SegmentStore, spread

#: Pairs in a shard of the hash, about, and bits to a pair at each level.
SHARD_PAIRS, BITS_PER_PAIR = 8192, 1.5
#: Bytes of hash, pairs and counts that a worker holds at a time, about.
TABLE_BYTES = 96 << 20
_PAIR_BYTES = 14
#: Vectors summed into one at a time.
FAN_IN = 16
#: Numbers that a worker keeps of the segments it has met (4 bytes each).
STORE_NUMBERS = 16_000_000
_HEAD = 5   # numbers before a segment's links
_SPREAD = 2654435761   # odd, near 2**32 by the golden ratio

NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


# ------------------------------------------------------------ aligning

def _space_before(s: TextSlice) -> TextSlice:
    """The slice with a space before each text that isn't empty."""
    some = np.diff(s.offsets) > 0
    return TextSlice(s.start, s.stop, np.insert(s.data, s.offsets[:-1][some], 32), s.offsets + np.concatenate([[0], np.cumsum(some)]))


class _Surface:
    """The bytes of each token id."""

    def __init__(self, pieces: list[bytes]):
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.ends = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def size(self, ids: np.ndarray) -> np.ndarray:
        return self.ends[ids + 1] - self.ends[ids]

    def read(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.ends[ids], self.size(ids))]


class _Store(SegmentStore):
    """Cuts where both tokenizers do: before a run of white space whose first
    character no piece of B has but at its own start (``cut``)."""

    def __init__(self, learn, cut: np.ndarray):
        super().__init__(learn, most_numbers=STORE_NUMBERS)
        self.cut = cut

    def starts(self, s: TextSlice) -> np.ndarray:
        at = super().starts(s)
        begins = np.zeros(len(s.data), bool)
        begins[s.offsets[:-1][np.diff(s.offsets) > 0]] = True
        return at[self.cut[s.data[at]] | begins[at]]


class Aligner:
    """Segments aligned between a byte-level BPE .json file (A) and a
    SentencePiece model (B), with their groups as text if ``printing``."""

    def __init__(self, path_a: str, path_b: str, printing: bool = True):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as pb

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.printing = printing
        self.a = SegmentEncoder(path_a)
        self.a.tokenizer.encode_special_tokens = True
        byte = {c: i for i, c in enumerate(byte_alphabet())}
        names = self.a.tokenizer.get_vocab(with_added_tokens=True)
        pieces = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            pieces[i] = bytes(byte[c] for c in name) if all(c in byte for c in name) else name.encode()
        self.surface_a = _Surface(pieces)
        with open(path_b, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        n = model.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or not n.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are taken")
        inner = {c for p in model.pieces if p.type == p.NORMAL for c in p.piece.lstrip("▁")[not p.piece.startswith("▁"):]}
        if "▁" in inner:
            raise ValueError("a piece goes on after a space")
        n.add_dummy_prefix = False   # the space stands in the segments
        self.b = SentencePieceProcessor(model_proto=model.SerializeToString())
        self.surface_b = _Surface([bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else b"" if p.type == p.CONTROL else p.piece.replace("▁", " ").encode() for p in model.pieces])
        self.n_b = len(model.pieces)
        self.decimal = _Surface([str(i).encode() for i in range(max(len(pieces), self.n_b))])
        if len(pieces) * self.n_b > 1 << 32:
            raise ValueError("the vocabularies' pairs don't fit 32 bits")
        self.store = _Store(self._learn, np.array([i == 32 or (9 <= i <= 13 and chr(i) not in inner) for i in range(256)]))

    def look_up(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray]:
        """The number of each segment, and for each text its first one."""
        numbers, _, first = self.store.look_up(_space_before(s))
        return numbers, first

    def heads(self, numbers: np.ndarray) -> np.ndarray:
        """Of each segment: tokens of A, of B, groups, whether a tokenizer
        changes it, and the length of its printed groups."""
        return self.store.data[self.store.ends[numbers][:, None] + np.arange(_HEAD)].astype(np.int64)

    def links(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (A's id times B's vocabulary, plus B's) of segments back
        to back, and how many each has."""
        head = self.heads(numbers)
        count = self.store.ends[numbers + 1] - self.store.ends[numbers] - _HEAD - (head[:, 4] + 3) // 4
        return self.store.data[spread(self.store.ends[numbers] + _HEAD, count)], count

    def printed(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The groups of segments as text, each after a semicolon."""
        size = self.heads(numbers)[:, 4]
        begin = (self.store.ends[numbers + 1] - (size + 3) // 4) * 4
        return self.store.data.view(np.uint8)[spread(begin, size)], np.concatenate([[0], np.cumsum(size)])

    def _learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids_a, len_a = self.a._learn(data, begin, end)
        ids_a = ids_a.astype(np.int64)
        got = self.b.encode([data[x:y].tobytes().decode() for x, y in zip(begin.tolist(), end.tolist())], num_threads=1)
        len_b = np.array([len(x) for x in got], np.int64)
        ids_b = np.fromiter(chain.from_iterable(got), np.int64, int(len_b.sum()))
        size = end - begin
        good = np.ones(len(size), bool)
        whole = data[spread(begin, size)]
        for surface, ids, length in ((self.surface_a, ids_a, len_a), (self.surface_b, ids_b, len_b)):
            seg = np.repeat(np.arange(len(size)), length)
            good &= np.bincount(seg, weights=surface.size(ids), minlength=len(size)) == size
        for surface, ids, length in ((self.surface_a, ids_a, len_a), (self.surface_b, ids_b, len_b)):
            same = surface.read(ids[np.repeat(good, length)]) == whole[np.repeat(good, size)]
            at = np.repeat(np.flatnonzero(good), size[good])
            good[at[~same]] = False
        # the good segments back to back; which bytes end a token
        size_good = size[good]
        ids_a, ids_b = ids_a[np.repeat(good, len_a)], ids_b[np.repeat(good, len_b)]
        n_bytes = int(size_good.sum())
        ends = np.zeros((2, n_bytes), bool)
        ends[0, np.cumsum(self.surface_a.size(ids_a)) - 1] = True
        ends[1, np.cumsum(self.surface_b.size(ids_b)) - 1] = True
        before = np.cumsum(ends, axis=1) - ends   # tokens that end before a byte
        cuts, common = np.flatnonzero(ends[0] | ends[1]), ends[0] & ends[1]
        link = (ids_a[before[0, cuts]] * self.n_b + ids_b[before[1, cuts]]).astype(np.uint32)
        last = np.cumsum(size_good)
        first = last - size_good
        inside = lambda flags: np.concatenate([[0], np.cumsum(flags)])[last] - np.concatenate([[0], np.cumsum(flags)])[first]
        n_groups, n_links = inside(common), inside(ends[0] | ends[1])
        text, n_text = np.zeros(0, np.uint8), np.zeros(len(last), np.int64)
        if self.printing:
            text, text_sizes = self._print(ids_a, ids_b, ends, common)
            token_bytes = np.zeros(n_bytes, np.int64)
            for k in (0, 1):
                token_bytes[ends[k]] += text_sizes[k]
            n_text = inside(token_bytes)
        lengths = np.full(len(size), _HEAD)
        lengths[good] += n_links + (n_text + 3) // 4
        start = np.cumsum(lengths) - lengths
        out = np.zeros(int(lengths.sum()), np.uint32)
        out[start[~good] + 3] = 1
        begin = start[good]
        for k, values in enumerate((len_a[good], len_b[good], n_groups, 0, n_text)):
            out[begin + k] = values
        out[spread(begin + _HEAD, n_links)] = link
        out.view(np.uint8)[spread((begin + _HEAD + n_links) * 4, n_text)] = text
        return out, lengths

    def _print(self, ids_a: np.ndarray, ids_b: np.ndarray, ends: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """All groups as text, and the bytes that each token takes: a token is
        a mark (what it stands after) and its id."""
        group = np.cumsum(common) - common   # groups that end before a byte
        of = [group[e] for e in ends]
        n = [np.bincount(g, minlength=int(common.sum())) for g in of]
        # a group's tokens of A, then those of B
        place_a = np.arange(len(ids_a)) + (np.cumsum(n[1]) - n[1])[of[0]]
        place_b = np.arange(len(ids_b)) + np.cumsum(n[0])[of[1]]
        total = len(ids_a) + len(ids_b)
        ids, marks = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        marks[place_a[np.diff(of[0], prepend=-1) != 0]] = ord(";")
        marks[place_b[np.diff(of[1], prepend=-1) != 0]] = ord("|")
        digits = self.decimal.size(ids)
        at = np.cumsum(digits + 1) - digits - 1
        text = np.empty(int(digits.sum()) + total, np.uint8)
        text[at] = marks
        text[spread(at + 1, digits)] = self.decimal.read(ids)
        return text, [digits[place_a] + 1, digits[place_b] + 1]


def aligner(path_a: str, path_b: str, printing: bool = True) -> Aligner:
    """This worker's aligner of two files."""
    return kept(("aligner", path_a, path_b, printing), lambda: Aligner(path_a, path_b, printing))


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``pair, n``: links of the texts of ``doc_id, text`` rows, added up by
    each task (a pair may come several times)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = aligner(path_a, path_b, printing=False)
        seen = np.zeros(1 << 16, np.int64)   # how often each segment of the store occurs

        def flush() -> Iterator[pa.RecordBatch]:
            numbers = np.flatnonzero(seen)
            if len(numbers):
                pair, count = held.links(numbers)
                pair, at = np.unique(pair, return_inverse=True)
                n = np.bincount(at, weights=np.repeat(seen[numbers], count)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], names=["pair", "n"])
            seen[:] = 0

        for batch in batches:
            for s in text_slices(batch.column(1)):
                if held.store.full():
                    yield from flush()
                numbers, first = held.look_up(s)
                while held.store.count > len(seen):
                    seen = np.concatenate([seen, np.zeros_like(seen)])
                bad = _per_text(held.heads(numbers)[:, 3], first) > 0
                seen += np.bincount(numbers[~np.repeat(bad, np.diff(first))], minlength=len(seen))
        yield from flush()

    return docs.mapInArrow(run, "pair long, n long")


# ------------------------------------------------------------ the hash

def shard_of(pair: Column, shards: int) -> Column:
    return F.shiftright(F.lit(_SPREAD) * pair % (1 << 32) * shards, 32).cast("int")


def _shard_of(pair: np.ndarray, shards: int) -> np.ndarray:
    return ((((pair.astype(np.uint64) * np.uint64(_SPREAD)) & np.uint64(0xFFFFFFFF)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def _place(pair: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return (mix(pair.astype(np.uint64) + np.uint64((level + 1) * int(GOLD) % (1 << 64))) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def perfect_hash(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Bits of each level, the levels' bits as words back to back, and the
    distinct ``pairs`` by their index."""
    sizes, words, order = [], [], []
    left = pairs
    while len(left):
        size = max(64, int(BITS_PER_PAIR * len(left)))
        place = _place(left, len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        bits = np.zeros(-(-size // 64) * 64, bool)
        bits[:size] = alone
        sizes.append(size)
        words.append(np.packbits(bits, bitorder="little").view("<u8"))
        set_here = alone[place]
        order.append(left[set_here][np.argsort(place[set_here])])
        left = left[~set_here]
    return sizes, np.concatenate([np.zeros(0, "<u8"), *words]), np.concatenate([np.zeros(0, pairs.dtype), *order])


class PairIndex:
    """The hashes of some shards in a row, from ``(shard, sizes, words, pairs)``."""

    def __init__(self, rows: list[tuple], shards: int):
        rows = sorted(rows)
        self.shards, self.low = shards, rows[0][0]
        count = rows[-1][0] - self.low + 1
        self.levels = max(len(r[1]) for r in rows)
        self.size = np.ones((count, self.levels), np.int64)
        self.start = np.full((count, self.levels), -1)
        self.first = np.zeros(count + 1, np.int64)
        at = 0
        for shard, sizes, _, pairs in rows:
            self.first[shard - self.low + 1] = len(pairs) // 4
            for level, size in enumerate(sizes):
                self.size[shard - self.low, level], self.start[shard - self.low, level] = size, at
                at += -(-size // 64)
        self.first = np.cumsum(self.first)
        self.words = np.frombuffer(b"".join(r[2] for r in rows), "<u8")
        self.pairs = np.frombuffer(b"".join(r[3] for r in rows), "<u4")
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def find(self, pair: np.ndarray) -> np.ndarray:
        """The index of each pair, or -1 where it is none of these shards'."""
        out = np.full(len(pair), -1)
        shard = _shard_of(pair, self.shards) - self.low
        left = np.flatnonzero((shard >= 0) & (shard < len(self.size)))
        for level in range(self.levels):
            left = left[self.start[shard[left], level] >= 0]
            if not len(left):
                break
            place = _place(pair[left], level, self.size[shard[left], level])
            word = self.start[shard[left], level] + (place >> 6)
            bit = np.uint64(1) << (place & 63).astype(np.uint64)
            held = (self.words[word] & bit) != 0
            at = left[held]
            index = self.rank[word[held]] + np.bitwise_count(self.words[word[held]] & (bit[held] - np.uint64(1))).astype(np.int64)
            same = self.pairs[index] == pair[at]   # one that isn't there may find the place of another
            out[at[same]] = index[same]
            left = left[~held]
        return out


def build(pairs: DataFrame, shards: int) -> DataFrame:
    """``shard, sizes, words, pairs`` of each shard of distinct ``pair`` rows."""
    def run(table: pa.Table) -> pa.Table:
        sizes, words, order = perfect_hash(table.column("pair").to_numpy().astype(np.uint32))
        return pa.table({"shard": table.column("shard")[:1], "sizes": pa.array([sizes], pa.list_(pa.int32())), "words": pa.array([words.tobytes()], pa.binary()), "pairs": pa.array([order.astype("<u4").tobytes()], pa.binary())})

    return pairs.select(shard_of(F.col("pair"), shards).alias("shard"), "pair").groupBy("shard").applyInArrow(run, "shard int, sizes array<int>, words binary, pairs binary")


def blocks(hashes: DataFrame, most_bytes: int) -> list[tuple[int, int]]:
    """First and last shard of each run of shards that fits ``most_bytes``: of
    each shard its number of pairs reaches the driver."""
    out: list[list[int]] = []
    held = 0
    for r in hashes.select("shard", (F.octet_length("pairs") / 4).alias("n")).orderBy("shard").collect():
        held += int(r["n"]) * _PAIR_BYTES
        if not out or held > most_bytes:
            out.append([r["shard"], r["shard"]])
            held = int(r["n"]) * _PAIR_BYTES
        out[-1][1] = r["shard"]
    return [(a, b) for a, b in out]


def _held_rows(rows: DataFrame, block: tuple[int, int], names: list[str]):
    """The rows of a block of shards, broadcast: no more than the block's bytes."""
    found = [tuple(r[n] if not isinstance(r[n], bytearray) else bytes(r[n]) for n in names) for r in rows.where(F.col("shard").between(*block)).select(*names).collect()]
    return rows.sparkSession.sparkContext.broadcast(found)


def dense_counts(partial: DataFrame, hashes: DataFrame, shards: int, parts: list[tuple[int, int]]) -> DataFrame:
    """``shard, counts`` (64-bit integers by index in the shard): the sums of
    ``pair, n`` rows, by dense vectors of tasks that are summed as a tree."""
    names = ["shard", "sizes", "words", "pairs"]
    found = None
    for block in parts:
        held = _held_rows(hashes, block, names)

        def run(batches: Iterator[pa.RecordBatch], held=held, block=block) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            index = kept(("pairs", block), lambda: PairIndex(held.value, shards))
            total = np.zeros(len(index.pairs), np.int64)
            for batch in batches:
                at = index.find(batch.column(0).to_numpy().astype(np.uint32))
                if (at < 0).any():
                    raise ValueError("a pair is not in the index")
                np.add.at(total, at, batch.column(1).to_numpy())
            task = TaskContext.get().partitionId()
            for i in range(len(index.first) - 1):
                some = total[index.first[i]:index.first[i + 1]]
                if some.any():
                    yield pa.RecordBatch.from_arrays([pa.array([index.low + i], pa.int32()), pa.array([task], pa.int32()), pa.array([some.astype("<i8").tobytes()], pa.binary())], names=["shard", "part", "counts"])

        mine = partial.where(shard_of(F.col("pair"), shards).between(*block)).mapInArrow(run, "shard int, part int, counts binary")
        found = mine if found is None else found.unionAll(mine)
    found = staged(found, "vectors")
    width = (found.agg(F.max("part")).first()[0] or 0) + 1

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), "<i8") for x in table.column("counts"))
        return pa.table({"shard": table.column("shard")[:1], "part": table.column("part")[:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    while width > 1:
        width = -(-width // FAN_IN)
        grouped = found.select("shard", (F.col("part") % width).alias("part"), "counts").groupBy("shard", "part").applyInArrow(add, "shard int, part int, counts binary")
        found = staged(grouped, "vectors")
    return found.select("shard", "counts")


def _best(table: DataFrame, n_b: int) -> np.ndarray:
    """For each B id the highest count of its pairs (no more rows than B's
    vocabulary reach the driver)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(n_b, np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column(0), batch.column(1)):
                np.maximum.at(most, np.frombuffer(pairs.as_buffer(), "<u4") % n_b, np.frombuffer(counts.as_buffer(), "<i8"))
        at = np.flatnonzero(most)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(most[at])], names=["b", "most"])

    out = np.zeros(n_b, np.int64)
    for r in table.select("pairs", "counts").mapInArrow(run, "b int, most long").groupBy("b").agg(F.max("most").alias("most")).collect():
        out[r["b"]] = r["most"]
    return out


# ------------------------------------------------------------ the operator

class _Answers:
    """For each segment of a worker's store, how many of its links are the
    best of their B id, and the sum of its links' counts."""

    def __init__(self, held: Aligner, index: PairIndex, counts: np.ndarray, best: np.ndarray):
        self.held, self.index, self.counts, self.best = held, index, counts, best
        self.sums = np.zeros((1 << 16, 2), np.int64)
        self.done = 0

    def of(self, numbers: np.ndarray) -> np.ndarray:
        count = self.held.store.count
        if count < self.done:   # the store has started anew
            self.done = 0
        while count > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        if count > self.done:
            new = np.arange(self.done, count)
            pair, size = self.held.links(new)
            at = self.index.find(pair)
            n = np.where(at >= 0, self.counts[at], 0)
            total = np.concatenate([[0], np.cumsum(n)])
            best = np.concatenate([[0], np.cumsum((at >= 0) & (n == self.best[pair % self.held.n_b]))])
            ends = np.concatenate([[0], np.cumsum(size)])
            self.sums[self.done:count] = np.stack([best[ends[1:]] - best[ends[:-1]], total[ends[1:]] - total[ends[:-1]]], axis=1)
            self.done = count
        return self.sums[numbers]


def _scored(docs: DataFrame, path_a: str, path_b: str, table: DataFrame, block: tuple[int, int], shards: int, best: np.ndarray, last: bool) -> DataFrame:
    """``doc_id, text, n_best, count_sum`` rows with a block's part added; the
    last time with all other columns, and without texts."""
    held = _held_rows(table, block, ["shard", "sizes", "words", "pairs", "counts"])
    more = [docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in NUMBERS), T.StructField("groups_sha256", T.StringType())]
    spec = T.StructType(more if last else docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def make() -> tuple[Aligner, _Answers]:
            mine = aligner(path_a, path_b)
            rows = sorted(held.value)
            return mine, _Answers(mine, PairIndex([r[:4] for r in rows], shards), np.frombuffer(b"".join(r[4] for r in rows), "<i8"), best)

        mine, answers = kept(("answers", block), make)
        for batch in batches:
            for s in text_slices(batch.column(1)):
                numbers, first = mine.look_up(s)
                if mine.store.count < answers.done:
                    answers.done = 0
                sums = answers.of(numbers)
                head = mine.heads(numbers)
                bad = _per_text(head[:, 3], first) > 0
                here = slice(s.start, s.stop)
                part = [np.where(bad, 0, _per_text(sums[:, k], first)) + batch.column(2 + k).to_numpy()[here] for k in (0, 1)]
                rows = batch.slice(s.start, len(s))
                if not last:
                    yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array(p) for p in part)], names=spec.names)
                    continue
                n_a, n_b, n_groups = (np.where(bad, 0, _per_text(head[:, k], first)) for k in range(3))
                text, ends = mine.printed(numbers)
                raw, ends = text.tobytes(), ends[first]
                digest = ["" if b or x == y else hashlib.sha256(raw[x + 1:y]).hexdigest() for b, x, y in zip(bad.tolist(), ends.tolist(), ends[1:].tolist())]
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(x) for x in (n_a, n_b, n_groups, n_a + n_b - n_groups, *part)), pa.array(digest, pa.string())], names=spec.names)

    return docs.mapInArrow(run, spec)


def align(docs: DataFrame, path_a: str, path_b: str, *, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of every row. A pair's count is how many links of the whole
    table hold it."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    partial = staged(pair_counts(docs, path_a, path_b), "partial")
    pairs = staged(partial.select("pair").distinct(), "pairs")
    shards = max(1, -(-pairs.count() // SHARD_PAIRS))
    hashes = staged(build(pairs, shards), "hashes")
    parts = blocks(hashes, table_bytes)
    rows = docs.select("doc_id", "text", *(F.lit(0).cast("long").alias(n) for n in NUMBERS[4:]))
    if not parts:   # no links: every text is empty or changed
        return docs.select("doc_id", *(F.lit(0).cast("long").alias(n) for n in NUMBERS), F.lit("").alias("groups_sha256"))
    table = staged(hashes.join(dense_counts(partial, hashes, shards, parts), "shard"), "table")
    best = _best(table, aligner(path_a, path_b).n_b)
    for k, block in enumerate(parts):
        last = k == len(parts) - 1
        rows = _scored(rows, path_a, path_b, table, block, shards, best, last)
        if not last:
            rows = staged(rows, "scored")
    return rows


def op12(spark, sf_dir: str) -> DataFrame:
    """``documents`` aligned between two public tokenizers."""
    import public_tokenizers

    return align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
