"""Operator 5, token counts of every prefix of a text.

Byte-pair encodings have a last token that can be found from those of shorter
prefixes: of the tokens that end a prefix, the one that stays apart from the
last token before it (the two side by side are encoded as themselves). So one
pass over a piece, from its left end to its right, gives the exact count of
each of its prefixes. A text's count at any place is that of the whole
segments before it plus the one inside its segment, and questions of
truncation and budget are answered from these without encoding again.

The tokens that end at each byte come from an Aho-Corasick automaton of the
vocabulary, which reads a piece once. Whether two tokens stay apart is asked of
the library's own model once for each pair. Splitting into pieces is the
library's too.

Defined results: null counts as empty, with no tokens; the special string in a
text is its one token, as the library takes it; a prefix that ends inside it is
ordinary text. Repeated rows are counted each. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import TextSlice, kept, read, text_slices
from landfall.llm.segments import SegmentStore

LIMIT = 1024
#: Pieces, and pairs of tokens, whose answers a worker keeps.
MOST_PIECES, MOST_PAIRS = 300_000, 1_000_000


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printing Latin-1 characters for themselves, others from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printing)]
    return [chr(b) if b in set(printing) else chr(256 + others.index(b)) for b in range(256)]


#: A word of Latin letters and at most a run of marks after it: the library
#: always splits it just so. Most segments are.
_PLAIN_WORD = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?&#$%*]*)")


class PrefixCounter:
    """Counts of tokens at every prefix, for a byte-level BPE .json file."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokens = ["", *self.tokenizer.get_vocab(with_added_tokens=False)]   # the first: no token
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(self.tokens[1:], 1):
            self.automaton.add_word(token, (len(token), i, i * len(self.tokens)))
        self.automaton.make_automaton()
        self.names = byte_alphabet()
        self.table = {i: c for i, c in enumerate(self.names)}
        self.spaces = {self._mapped(c.encode()) for c in "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))}
        self.apart: dict[int, bool] = {}   # by the left token's number times that of all tokens, plus the right one's
        self.pieces: dict[str, list[int]] = {}
        self.store = SegmentStore(self._learn)

    def _mapped(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.table)

    def _stays(self, pair: int) -> bool:
        found = self.apart.get(pair)
        if found is None:
            if len(self.apart) > MOST_PAIRS:
                self.apart.clear()
            left, right = (self.tokens[i] for i in divmod(pair, len(self.tokens)))
            got = [t.value for t in self.model.tokenize(left + right)]
            found = self.apart[pair] = got == ([left, right] if left else [right])
        return found

    def piece(self, mapped: str) -> list[int]:
        """The number of tokens of each prefix of a piece (one that the
        library doesn't split), from one byte on."""
        found = self.pieces.get(mapped)
        if found is not None:
            return found
        stays, apart = self._stays, self.apart
        last, counts, done = [0], [0], 0   # by prefix: its last token as the left of a pair, its tokens; the bytes they reach
        for end, (size, token, as_left) in self.automaton.iter(mapped):
            if end != done:
                if end < done:
                    continue   # only one way is good, and it is found
                break
            begin = end + 1 - size
            pair = last[begin] + token
            ok = apart.get(pair)
            if ok or (ok is None and stays(pair)):
                last.append(as_left)
                counts.append(counts[begin] + 1)
                done += 1
        if done < len(mapped):
            raise ValueError("a byte has no token")
        if len(mapped) <= 64:
            if len(self.pieces) > MOST_PIECES:
                self.pieces.clear()
            self.pieces[mapped] = counts[1:]
        return counts[1:]

    def text(self, text: str) -> list[int]:
        """The number of tokens of each prefix of a text, by bytes; places
        inside a character have no meaning."""
        at = [(i, x) for x in self.special if (i := text.find(x)) >= 0]
        if at:
            i, x = min(at)
            ordinary = self._plain(text[:i] + x[:-1])
            before = ordinary[len(text[:i].encode()) - 1] if i else 0
            return [*ordinary, before + 1, *(before + 1 + c for c in self.text(text[i + len(x):]))]
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        if m := _PLAIN_WORD.fullmatch(text):
            word, mark = m.groups()
            counts = self.piece(word.replace(" ", self.names[32]) if word.isascii() else self._mapped(word.encode()))
            return counts + [counts[-1] + c for c in self.piece(mark)] if mark else counts
        out: list[int] = []
        total, before = 0, None   # tokens of the pieces so far; the last piece and the tokens before it
        for mapped, _ in self.split.pre_tokenize_str(text):
            counts = self.piece(mapped)
            here = [total + c for c in counts]
            if mapped in ("'ll", "'re", "'ve"):
                here[1] = total + 2   # without its end, the mark and a letter
            if before is not None:
                white, base = before
                lead = next((n for n in (1, 2, 3) if mapped[:n] in self.spaces), 0)
                if lead and self._white(white):   # text that ends here ends in one run of white space
                    here[lead - 1] = base + self.piece(white + mapped[:lead])[-1]
            out += here
            before, total = (mapped, total), total + counts[-1]
        return out

    def _white(self, mapped: str) -> bool:
        while mapped:
            n = next((n for n in (1, 2, 3) if mapped[:n] in self.spaces), 0)
            if not n:
                return False
            mapped = mapped[n:]
        return True

    def _learn(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.text(data[a:b].tobytes().decode()) for a, b in zip(begin.tolist(), end.tolist())]
        return np.fromiter(chain.from_iterable(found), np.uint32, int((end - begin).sum())), end - begin

    # -------------------------------------------------------- slices

    def totals(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of tokens of each text; and of its segments the numbers
        in the store, the byte positions, and the tokens before each (one more
        than there are, over the whole slice)."""
        numbers, bounds, first = self.store.look_up(s)
        ends = self.store.ends[numbers + 1]
        before = np.concatenate([[0], np.cumsum(self.store.data[ends - 1].astype(np.int64))])
        return before[first[1:]] - before[first[:-1]], numbers, bounds, before

    def longest_prefix(self, s: TextSlice, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of each text, and the bytes of its longest prefix, in
        whole characters, of at most ``limit`` tokens."""
        total, numbers, bounds, before = self.totals(s)
        size = np.diff(s.offsets)
        first = np.searchsorted(bounds[:-1], s.offsets)
        for i in np.flatnonzero(total > limit):
            base = before[first[i]]
            at = int(np.searchsorted(before[first[i]:first[i + 1] + 1] - base, limit, side="right")) - 1 + first[i]   # the segment that goes over
            inside = self.store.data[self.store.ends[numbers[at]]:self.store.ends[numbers[at] + 1]]
            a, b = bounds[at], bounds[at + 1]
            whole = np.append((s.data[a + 1:b] & 0xC0) != 0x80, True)   # a character ends at this byte
            fit = np.flatnonzero(whole & (before[at] - base + inside <= limit))
            size[i] = a - s.offsets[i] + (fit[-1] + 1 if len(fit) else 0)
        return total, size

    def every_prefix(self, s: TextSlice) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of every prefix that ends with a character, back to
        back, and where each text's begin."""
        _, numbers, bounds, before = self.totals(s)
        inside, _ = self.store.gather(numbers)
        first = np.searchsorted(bounds[:-1], s.offsets)
        base = np.repeat(before[first[:-1]], np.diff(s.offsets))
        counts = inside.astype(np.int64) + np.repeat(before[:-1], np.diff(bounds)) - base
        ends = np.append((s.data[1:] & 0xC0) != 0x80, True) if len(s.data) else np.zeros(0, bool)
        return counts[ends], np.concatenate([[0], np.cumsum(ends)])[s.offsets]


def counter(path: str) -> PrefixCounter:
    """This worker's counter for a tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept(("counter", path), lambda: PrefixCounter(path))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, and
    ``limit_bytes``: how much of the text fits the limit, in whole
    characters."""
    docs = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            for s in text_slices(batch.column(1)):
                total, fits = count.longest_prefix(s, limit)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, len(s)), pa.array(np.diff(s.offsets)), pa.array(total), pa.array(total > limit), pa.array(fits)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit", "limit_bytes"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                                              T.StructField("over_limit", T.BooleanType()), T.StructField("limit_bytes", T.LongType())]))


def prefix_counts(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, counts``: the tokens of the first character, the first two,
    and so on. Store it to answer any such question later."""
    docs = _rows(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer)
        for batch in batches:
            for s in text_slices(batch.column(1), 1 << 18):
                flat, first = count.every_prefix(s)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, len(s)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat, pa.int32()))],
                                                 names=["doc_id", "counts"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("counts", T.ArrayType(T.IntegerType()))]))


def tokens_of(counts: Column, chars: Column | int) -> Column:
    """The tokens of the first ``chars`` characters (all if there are fewer)."""
    n = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts))
    return F.when(n <= 0, 0).otherwise(F.get(counts, n - 1))


def chars_within(counts: Column, budget: Column | int) -> Column:
    """The most characters from the start that have at most ``budget`` tokens."""
    b = F.lit(budget) if isinstance(budget, int) else budget
    fits = F.transform(counts, lambda c, i: F.when(c <= b, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0))


def op5(spark, sf_dir: str) -> DataFrame:
    """Token counts of ``documents``, and which go over 1024."""
    import public_tokenizers

    return count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
