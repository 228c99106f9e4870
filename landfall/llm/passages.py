"""Operator 9, repeated passages by a sparse suffix array.

Of a text's suffixes only those are retained that begin at content-selected
positions: in every window of 50 words the run of ten words with the least
hash (its minimiser, the *anchor*), so equal windows retain equal positions
whatever stands around them. The retained suffixes are sorted, by their
anchors' words and then by what the anchor extends to on its left and right:
its *block*, which is all the windows that it was chosen for, so a match that
holds an anchor lies in its blocks. Neighbours are compared in one streaming
pass: a suffix whose anchor no neighbour shares is dropped; those of equal
blocks match whole. Where blocks at one anchor differ, their matches are
shorter than the blocks: the suffixes at every window of one block of each kind
are sorted and compared with their neighbours in the same way. Windows that
overlap join into the longest passages.

Words are compared by hashes: two different blocks, or windows, are taken for
equal with a probability of 2**-128 (two independent sums of independent word
hashes). Of a passage's occurrences the first stays (least id, then position);
the others are its repeats. Sorts are by ranges, and a run of equal rows is
dealt over tasks, so a hot passage is gathered nowhere. Texts are not moved,
but for those that windows are asked of and those that are cut.

Defined results: words are separated by ASCII white space and compared as they
stand; texts under 50 words, null among them, have no passages. Rows of one id
and text count as one document, other texts of the id as others; rows with null
id are left out. Within one document an occurrence that overlaps the first is none. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from landfall.llm.common import GOLD, SLICE_BYTES, Runs, TextSlice, Words, _powers, discard, fresh, mix, own, read, scope, span_hash, split_asked, staged, text_slices, words
from landfall.llm.runs import sorted_runs
from landfall.llm.segments import spread

LEAST_WORDS = 50
GRAM = 10
_PLACE_BITS = 24


def minimisers(w: Words, least: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each block (the windows in a row that choose one anchor): text,
    anchor, first window and last window, as word numbers in the slice; and
    the anchor's hash."""
    n = len(w.hash)
    text = w.text_of()
    if n < least:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    runs = Runs(w.hash)
    at = np.arange(n - gram + 1)
    hashes = runs.of(at, at + gram)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    place = (at - w.first[:-1][text[at]]).astype(np.uint64) & low
    value = (hashes & ~low) | place   # of equal hashes the leftmost
    wide = least - gram + 1
    span, best = 1, value
    while span * 2 <= wide:
        best = np.minimum(best[:len(best) - span], best[span:])
        span *= 2
    if wide > span:
        best = np.minimum(best[:len(best) - (wide - span)], best[wide - span:])
    window = np.arange(len(best))
    window = window[window + least <= w.first[1:][text[window]]]
    base = w.first[:-1][text[window]]
    here = (window - base).astype(np.uint64)
    anchor = window + ((best[window] - here) & low).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])) if len(window) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(window)) - 1
    anchor = anchor[begins]
    return text[anchor], anchor, window[begins], window[ends], hashes[anchor]


_SPANS = "lo int, hi int, begin int, end int"   # words lo to hi, bytes begin to end, of the text


def _spans(s: TextSlice, w: Words, text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[pa.Array]:
    base, start = w.first[:-1][text], s.offsets[:-1][text]
    return [pa.array(x.astype(np.int32)) for x in (lo - base, hi - base, w.start[lo] - start, w.end[hi - 1] - start)]


class _Other:
    """Hashes of runs of words that are independent of those of ``Runs``."""

    def __init__(self, s: TextSlice, w: Words):
        up, self.down = _powers(1, len(w.hash) + 1)
        self.total = np.zeros(len(w.hash) + 1, np.uint64)
        np.cumsum(span_hash(s.data, w.start, w.end, second=True) * up[:len(w.hash)], out=self.total[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * GOLD)


def anchors(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """``doc_id, doc_text, key, block, other`` and span of each block: ``key``
    is the hash of the anchor's words, ``block`` and ``other`` are those of all
    its windows' words, and where in them the anchor stands."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(2)):
                w = words(s)
                text, anchor, first, last, key = minimisers(w, least, gram)
                if len(text):
                    where = (anchor - first).astype(np.uint64) * GOLD
                    block, other = Runs(w.hash).of(first, last + least) + where, _Other(s, w).of(first, last + least) + where
                    docs_of = [batch.column(k).slice(s.start, len(s)).take(pa.array(text)) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*docs_of, *(pa.array(x.view(np.int64)) for x in (key, block, other)), *_spans(s, w, text, first, last + least)],
                                                     names=["doc_id", "doc_text", "key", "block", "other", "lo", "hi", "begin", "end"])

    return docs.mapInArrow(run, f"doc_id {kind}, doc_text long, key long, block long, other long, {_SPANS}")


def _windows(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id, doc_text, window, other, copied`` and span of each window of
    the blocks that the rows of ``doc_id, doc_text, text, blocks`` list."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column(3)
            for s in text_slices(batch.column(2), SLICE_BYTES // 4):
                w = words(s)
                runs, other = Runs(w.hash), _Other(s, w)
                mine = asked.slice(s.start, len(s))
                flat = mine.flatten()
                text = np.repeat(np.arange(len(s)), np.diff(mine.offsets.to_numpy()))
                lo, hi, copied = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("lo", "hi", "several"))
                count = hi - lo - least + 1
                start = spread(w.first[text] + lo, count)
                text, copied = np.repeat(text, count), np.repeat(copied, count)
                docs_of = [batch.column(k).slice(s.start, len(s)).take(pa.array(text)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*docs_of, *(pa.array(x.of(start, start + least).view(np.int64)) for x in (runs, other)), pa.array(copied.astype(bool)), *_spans(s, w, text, start, start + least)],
                                                 names=["doc_id", "doc_text", "window", "other", "copied", "lo", "hi", "begin", "end"])

    return docs.mapInArrow(run, f"doc_id {kind}, doc_text long, window long, other long, copied boolean, {_SPANS}")


_DOC = ["doc_id", "doc_text"]
_PLACE = [*_DOC, "lo"]


def occurrences(docs: DataFrame, least: int = LEAST_WORDS, gram: int = GRAM) -> DataFrame:
    """Spans of documents (rows of ``doc_id, doc_text, text``), one window or
    more each, whose words occur elsewhere: ``doc_id, doc_text``, span,
    ``repeat`` (whether an earlier occurrence stays) and ``of_doc`` (the id of
    the document of the first occurrence)."""
    docs = docs.where("doc_id IS NOT NULL")
    every = staged(anchors(docs, least, gram), "anchors")
    suffixes = sorted_runs(every, ["key"], ["block", "other"], _PLACE)
    discard(every)
    is_first = (F.col("doc_id") == F.col("first_doc_id")) & (F.col("doc_text") == F.col("first_doc_text"))
    apart = ~is_first | (F.col("lo") - F.col("first_lo") >= least)
    is_first = is_first & (F.col("lo") == F.col("first_lo"))
    spans = [*_DOC, "lo", "hi", "begin", "end"]
    whole = suffixes.where(~is_first & apart).select(*spans, F.lit(True).alias("repeat"), F.col("first_doc_id").alias("of_doc"))
    # one block of each kind stands for its copies, but for those that overlap it; where it is the only kind at its
    # anchor, nothing else is to be compared
    heads = suffixes.where(is_first | ~apart)
    mixed = staged(suffixes.where("turn").select("key").distinct(), "mixed")
    alone = heads.where(is_first & F.col("several")).join(mixed, "key", "left_anti").select(*spans, F.lit(False).alias("repeat"), F.col("doc_id").alias("of_doc"))
    asked = heads.join(mixed, "key", "left_semi").groupBy(*_DOC).agg(F.collect_list(F.struct("lo", "hi", "several")).alias("blocks"))
    asked = staged(asked, "asked")
    texts, _ = split_asked(docs.select(*_DOC, "text"), asked, _DOC)
    windows = staged(_windows(texts.join(asked, _DOC).select(*_DOC, "text", "blocks"), least), "windows")
    met = sorted_runs(windows, ["window", "other"], [], _PLACE, keep="copied")
    discard(windows, asked)
    single = met.where(is_first | apart).select(*spans, (~is_first).alias("repeat"), F.col("first_doc_id").alias("of_doc"))
    return whole.unionByName(alone).unionByName(single)


def _text_hash(text: Column) -> Column:
    """What tells texts of one id apart."""
    return F.coalesce(F.xxhash64(text), F.lit(0).cast("long"))


def _found(docs: DataFrame, least: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    """``passages`` with what tells the document from others of its id."""
    if not 0 < gram <= least:
        raise ValueError("gram must be between 1 and least")
    text = F.col(text_col).cast("string")
    docs = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), _text_hash(text).alias("doc_text"), text.alias("text"))
    found = occurrences(docs, least, gram)
    order = Window.partitionBy(*_DOC, "repeat").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = found.withColumn("new", F.when(reach >= F.col("lo"), 0).otherwise(1)).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*_DOC, "repeat", "island").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), (F.max("hi") - F.min("lo")).alias("n_words"), F.min("of_doc").alias("of_doc"))


def passages(docs: DataFrame, *, least: int = LEAST_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The longest repeated passages: ``doc_id, begin, end`` (bytes of the
    UTF-8 text), ``n_words``, ``repeat`` (false: an occurrence that stays) and
    ``of_doc`` (the least document that it or a part of it stands in first)."""
    found = _found(docs, least, gram, id_col, text_col)
    return found.select("doc_id", "begin", "end", "n_words", "repeat", "of_doc")


def cut_repeats(docs: DataFrame, *, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated passage cut out of its text but for the
    first occurrence; all other columns as they were, except that a column
    ``n_chars`` is counted again where text was cut."""
    doc, of_text, cut, left = (fresh(docs, n) for n in ("_id", "_text", "_cuts", "_kept"))
    with scope():
        found = _found(docs, least, GRAM, id_col, text_col).where("repeat")
        cuts = found.groupBy(F.col("doc_id").alias(doc), F.col("doc_text").alias(of_text)).agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias(cut))
        cuts = staged(cuts, "cuts", outlives=True)
    raw = F.col(text_col).cast("string").cast("binary")
    # the bytes before each cut from the end of the one before it, and those after the last
    starts = F.concat(F.array(F.lit(0)), F.col(f"{cut}.end"))
    stops = F.concat(F.col(f"{cut}.begin"), F.array(F.octet_length(raw)))
    kept = F.concat_ws("", F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda x: F.substring(raw, x["a"] + 1, x["b"] - x["a"]).cast("string")))
    named = docs.withColumns({doc: F.col(id_col), of_text: _text_hash(F.col(text_col).cast("string"))})
    some, others = split_asked(named, cuts, [doc, of_text])
    joined = some.join(cuts, [doc, of_text], "left").withColumn(left, F.when(F.col(cut).isNotNull(), kept))
    out = joined.withColumn(text_col, F.coalesce(left, text_col))
    if "n_chars" in docs.columns and text_col != "n_chars":
        out = out.withColumn("n_chars", F.when(F.col(left).isNotNull(), F.length(left)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    out = out.select(*own(docs))
    return out if others is None else out.unionAll(others.select(*own(docs)))


def op9(spark, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that ``documents`` repeat."""
    return passages(read(spark, sf_dir, "documents"))
