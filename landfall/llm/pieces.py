"""Operator 6, SentencePiece encoding and decoding by an Aho-Corasick
automaton and a single-pass Viterbi. Best scores are relaxed for unigram models;
for BPE models, such as the public one, the same pass keeps the one way that the
merge rules allow, and these are run where it finds none.

The automaton of all pieces reads a text once; at each position its output
links give every piece that ends there, and each relaxes the position's best
way. In a unigram model the best way has the greatest sum of scores. In a BPE
model sums of scores don't give the model's own result, so there a way is
good if each two pieces side by side stay apart when merged by the model's
rules; exactly one way to each position is, and pairs are asked about once.
Where equal scores (runs of spaces) leave no such way, the merge rules
themselves are run.

Texts cut into segments before spaces, as no piece crosses such a place
(checked when a model is read); segments that a worker has met are looked up.

Defined results: null counts as empty, which has no pieces. Characters without
a piece become byte pieces where the model has these, else the unknown piece.
Only models that leave text as it is but for spaces (identity normaliser) are
taken. U+2581 in a text is decoded as a space, as the library does. Repeated
rows are encoded each. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import TextSlice, kept, read, text_slices
from landfall.llm.segments import SegmentStore, spread

SPACE = "▁"
#: Fixed values of the SentencePiece format: model types, piece types, and by
#: how much an unknown character scores below the least piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0


class PieceModel:
    """Pieces ``(text, score, type)`` by id, and how to encode with them."""

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = UNIGRAM, dummy_prefix: bool = True, unknown_surface: str = " ⁇ "):
        import ahocorasick

        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are taken")
        self.kind, self.dummy_prefix = kind, dummy_prefix
        self.pieces = pieces
        self.scores = {p: s for p, s, t in pieces if t in (NORMAL, USER_DEFINED)}
        self.ids = {p: i for i, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER_DEFINED)}
        if any(t == USER_DEFINED for _, _, t in pieces):
            raise ValueError("user-defined pieces are not taken")
        self.unknown = next((i for i, x in enumerate(pieces) if x[2] == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.worst = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        for p in self.ids:
            if SPACE in p.lstrip(SPACE):
                raise ValueError(f"piece {p!r} goes on after a space")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i, p))
        if self.ids:
            self.automaton.make_automaton()
        self.apart: dict[tuple[str, str], bool] = {}
        surface = [b"" if t == CONTROL else unknown_surface.encode() if t == UNKNOWN else bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(SPACE, " ").encode() for p, _, t in pieces]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_ends = np.concatenate([[0], np.cumsum([len(x) for x in surface])])
        self.is_byte = np.array([t == BYTE for _, _, t in pieces])
        self.store = SegmentStore(self._learn, np.arange(256) == 32)

    @classmethod
    def read(cls, path: str) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            m = pb.ModelProto.FromString(f.read())
        n = m.normalizer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with the identity normaliser are taken")
        return cls([(p.piece, p.score, p.type) for p in m.pieces], m.trainer_spec.model_type, n.add_dummy_prefix, m.trainer_spec.unk_surface)

    # -------------------------------------------------------- one segment

    def merged(self, text: str) -> list[str]:
        """The BPE rules themselves: of all neighbours that make a piece, those
        of the best score merge first, of equal ones the leftmost."""
        parts: list[str | None] = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (both := parts[i] + parts[after[i]]) in self.scores:
                heapq.heappush(heap, (-self.scores[both], i, after[i], both))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _stays(self, left: str, right: str) -> bool:
        found = self.apart.get((left, right))
        if found is None:
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            found = self.apart[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def segment(self, text: str) -> list[str]:
        """The pieces of a text, escaped; characters without one by themselves."""
        way = self._best_sum(text) if self.kind == UNIGRAM else self._only_way(text)
        if way is None:
            return self.merged(text)
        out, at = [], len(text)
        while at:
            out.append(way[at])
            at -= len(way[at])
        return out[::-1]

    def _arrivals(self, text: str) -> Iterator[tuple[int, tuple[int, int, str]]]:
        """Every piece in the text, by the position that it ends at (the
        automaton's transitions), longest first (its output links)."""
        return self.automaton.iter(text) if self.ids else iter(())

    def _best_sum(self, text: str) -> list[str]:
        best = [0.0] + [-np.inf] * len(text)
        way = [""] * (len(text) + 1)
        done = 0   # positions whose best is known

        def close(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                c = text[done - 1]
                if c not in self.scores and best[done - 1] + self.worst > best[done]:
                    best[done], way[done] = best[done - 1] + self.worst, c

        for end, (n, _, piece) in self._arrivals(text):
            close(end)
            total = best[end + 1 - n] + self.scores[piece]
            if total > best[end + 1]:
                best[end + 1], way[end + 1] = total, piece
        close(len(text))
        return way

    def _only_way(self, text: str) -> list[str] | None:
        if text.startswith(SPACE * 2):   # such pieces have equal scores
            return None
        way, apart, stays, known = [""], self.apart, self._stays, self.scores

        def unknown(upto: int) -> bool:
            """Positions that no piece is good for: a character without one stands by itself."""
            while len(way) <= upto:
                c = text[len(way) - 1]
                if c in known or not stays(way[-1], c):
                    return False
                way.append(c)
            return True

        for end, (n, _, piece) in self._arrivals(text):
            at = len(way)
            if at > end + 1:
                continue   # the way to this position is found
            if at <= end and not unknown(end):
                return None
            left = way[end + 1 - n]
            ok = apart.get((left, piece))
            if ok or (ok is None and stays(left, piece)):
                way.append(piece)
        return way if unknown(len(text)) else None

    def encode_piece(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def _learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat: list[int] = []
        lengths = []
        for a, b in zip(begin.tolist(), end.tolist()):
            at = len(flat)
            for piece in self.segment(data[a:b].tobytes().decode().replace(" ", SPACE)):
                flat += self.encode_piece(piece)
            lengths.append(len(flat) - at)
        return np.array(flat, np.uint32), np.array(lengths, np.int64)

    # -------------------------------------------------------- slices

    def prefixed(self, s: TextSlice) -> TextSlice:
        """The slice with a space before each text that isn't empty."""
        if not self.dummy_prefix:
            return s
        some = np.diff(s.offsets) > 0
        data = np.insert(s.data, s.offsets[:-1][some], 32)
        return TextSlice(s.start, s.stop, data, s.offsets + np.concatenate([[0], np.cumsum(some)]))

    def encode(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts back to back, and where each text's begin."""
        numbers, _, first = self.store.look_up(self.prefixed(s))
        ids, ends = self.store.gather(numbers)
        return ids, ends[first]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the texts back to back, and where each begins."""
        size = self.surface_ends[ids + 1] - self.surface_ends[ids]
        data = self.surface[spread(self.surface_ends[ids], size)]
        offsets = np.concatenate([[0], np.cumsum(size)])[first]
        if self.dummy_prefix:
            some = offsets[:-1][np.diff(offsets) > 0]
            drop = some[data[some] == 32]
            gone = np.zeros(len(data), bool)
            gone[drop] = True
            offsets = offsets - np.concatenate([[0], np.cumsum(gone)])[offsets]
            data = data[~gone]
        return data, offsets


def model(path: str) -> PieceModel:
    """This worker's model of a file."""
    return kept(("model", path), lambda: PieceModel.read(path))


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(1), 1 << 20):
                ids, first = model(path).encode(s)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, len(s)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of every row; null ids give the empty text, bytes that
    are no UTF-8 the replacement character."""
    rows = rows.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            first = lists.offsets.to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = model(path).decode(flat, first - first[0])
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType())]))


def round_trips(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text encoded and decoded again: ``doc_id, n_bytes, n_pieces,
    n_byte_pieces, ids_crc32`` (of little-endian unsigned 32-bit ids),
    whether the text came back whole, and its ``ids``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(1)):
                held = model(path)
                ids, first = held.encode(s)
                data, offsets = held.decode(ids.astype(np.int64), first)
                if np.array_equal(offsets, s.offsets) and np.array_equal(data, s.data):
                    same = np.ones(len(s), bool)
                else:
                    same = np.array([np.array_equal(data[a:b], s.data[x:y]) for a, b, x, y in zip(offsets, offsets[1:], s.offsets, s.offsets[1:])], bool)
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(first.tolist(), first[1:].tolist())]
                as_bytes = np.concatenate([[0], np.cumsum(held.is_byte[ids])])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, len(s)), pa.array(np.diff(s.offsets)), pa.array(np.diff(first)), pa.array(as_bytes[first[1:]] - as_bytes[first[:-1]]),
                                                  pa.array(crc, pa.int64()), pa.array(same), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32)))],
                                                 names=["doc_id", "n_bytes", "n_pieces", "n_byte_pieces", "ids_crc32", "round_trip", "ids"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_pieces", "n_byte_pieces", "ids_crc32")), T.StructField("round_trip", T.BooleanType()),
                                           T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def op6(spark, sf_dir: str) -> DataFrame:
    """``documents`` encoded and decoded with a public SentencePiece model."""
    import public_tokenizers

    return round_trips(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
