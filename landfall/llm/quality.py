"""Operator 3, a quality classifier as a sparse rule ensemble.

A pass over whole texts takes statistics of each (character classes, words,
lines, repetition). Small trees are grown on labelled rows; each path from a
root to a node is a rule, a conjunction of comparisons of statistics. A
logistic regression with an L1 penalty weighs the rules, most of them to zero,
and the rest are compiled into one Spark column expression that scores rows.

Only ``labels.quality`` of rows whose crc32(doc_id) mod 3 isn't 1 is learned
from, at most about ``max_rows`` of them (by a hash of the id); every text is
scored.

Defined results: null text counts as empty, and empty texts are scored like
others; a null id is not held out and not learned from; rows repeated are
scored each; an id labelled several times is learned from each time. Labels of
one class give that class's share as everyone's score, no labels 0.5. An empty
table gives no rows. ``lang``, ``source``, ids and labels are never inputs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import TextSlice, fresh, own, read, span_hash, staged, text_slices, words

MAX_ROWS = 50_000
TREES, DEPTH = 20, 3
#: Learning goes over these few rows again and again: in few tasks.
TASKS = 2
PENALTY = 5e-4
SEED = 7

STATISTICS = ("chars", "words", "word_bytes", "upper", "digits", "marks", "symbols", "beyond_ascii", "space", "exclaimed",
              "symbol_ended", "bare_marks", "short_words", "long_words", "distinct_words", "top_word", "repeated_next",
              "lines", "distinct_lines", "line_words", "upper_words")


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_LETTER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
_MARK = _class(".,;:!?'\"()-")
_SYMBOL = _class("#$%&*+/<=>@[\\]^_`{|}~")
_LEAD = (np.arange(256) & 0xC0) != 0x80   # a byte that begins a code point


def statistics(s: TextSlice) -> np.ndarray:
    """A row for each text of the slice, a column for each of STATISTICS."""
    d, n = s.data, len(s)

    def within(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[at[1:]] - total[at[:-1]]).astype(float)

    share = lambda a, b: a / np.maximum(b, 1)
    w = words(s)
    text, size = w.text_of(), w.end - w.start
    chars, count = within(_LEAD[d], s.offsets), np.diff(w.first).astype(float)
    letters = within(_LETTER[d], s.offsets)
    last = d[w.end - 1] if len(size) else d[:0]
    letter_total = np.concatenate([[0], np.cumsum(_LETTER[d] | _DIGIT[d])])
    bare = (letter_total[w.end] - letter_total[w.start]) == 0
    upper_total = np.concatenate([[0], np.cumsum(_UPPER[d])])
    same = np.zeros(len(size), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])
    distinct, top = _distinct(w.hash, text, n)
    # lines with something in them
    broken = np.flatnonzero(d == 10)
    begin = np.unique(np.concatenate([s.offsets[:-1], broken + 1]))
    begin = begin[begin < len(d)]
    end = np.append(begin[1:], len(d))
    line_text = np.searchsorted(s.offsets, begin, side="right") - 1
    line_end = end - (d[end - 1] == 10) if len(begin) else end
    kept = line_end > begin
    begin, line_end, line_text = begin[kept], line_end[kept], line_text[kept]
    lines = np.bincount(line_text, minlength=n).astype(float)
    distinct_lines, _ = _distinct(span_hash(d, begin, line_end), line_text, n)
    return np.stack([
        np.log1p(chars), np.log1p(count), share(within(_LEAD[d] & ~_CLASS_SPACE[d], s.offsets), count), share(within(_UPPER[d], s.offsets), letters),
        share(within(_DIGIT[d], s.offsets), chars), share(within(_MARK[d], s.offsets), chars), share(within(_SYMBOL[d], s.offsets), chars),
        share(within(d >= 128, s.offsets), np.diff(s.offsets)), share(within(_CLASS_SPACE[d], s.offsets), chars),
        share(within(last == ord("!"), w.first), count), share(within(_SYMBOL[last], w.first), count), share(within(bare, w.first), count),
        share(within(size <= 3, w.first), count), share(within(size >= 15, w.first), count), share(distinct, count), share(top, count),
        share(within(same, w.first), count), np.log1p(lines), share(distinct_lines, lines), share(count, lines),
        share(within((upper_total[w.end] - upper_total[w.start]) * 2 > size, w.first), count)], axis=1)


_CLASS_SPACE = _class("\t\n\x0b\x0c\r ")


def _distinct(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text its number of distinct hashes, and how often its most
    frequent one occurs."""
    key = np.sort((text.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    if not len(key):
        return np.zeros(n), np.zeros(n)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    of = (key[first] >> np.uint64(44)).astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, of, np.diff(np.append(first, len(key))).astype(float))
    return np.bincount(of, minlength=n).astype(float), top


def with_statistics(df: DataFrame, text_col: str = "text", name: str = "_statistics") -> DataFrame:
    """``df`` with an array of the text's statistics, in their order."""
    at = df.columns.index(text_col)   # of a string column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(s) for s in text_slices(batch.column(at))]
            if found:
                flat = np.concatenate(found)
                array = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, flat.shape[1]), pa.int32()), pa.array(flat.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, array], names=[*batch.schema.names, "statistics"])

    plain = [f"c{i}" for i in range(len(df.columns))]   # mapInArrow looks columns up by name, which dots would break
    spec = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(plain, df.schema.fields)), T.StructField("statistics", T.ArrayType(T.DoubleType()))])
    return df.toDF(*plain).mapInArrow(run, spec).toDF(*df.columns, name)


# ------------------------------------------------------------ rules

@dataclass(frozen=True, order=True)
class Condition:
    feature: int
    above: bool
    value: float

    def column(self, array: str) -> Column:
        x = F.col(array)[self.feature]
        return x > self.value if self.above else x <= self.value

    def __str__(self) -> str:
        return f"{STATISTICS[self.feature]} {'>' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Condition, ...]


def tree_paths(description: str) -> list[Rule]:
    """Every path from a tree's root to another node, as the conditions on
    the way, from Spark's printed form of a forest."""
    found: set[Rule] = set()
    way: list[tuple[int, Condition]] = []
    for line in description.splitlines():
        if m := re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            depth = len(m[1])
            while way and way[-1][0] >= depth:
                way.pop()
            way.append((depth, Condition(int(m[3]), m[4] == ">", float(m[5]))))
            found.add(tuple(sorted(c for _, c in way)))
        elif line.lstrip().startswith("Tree "):
            way = []
    return sorted(found)


@dataclass
class RuleModel:
    """Weighted rules; ``score`` is the probability of label 1."""

    intercept: float
    rules: list[tuple[float, Rule]]

    def score(self, array: str = "_statistics") -> Column:
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.when(_holds(rule, array), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _holds(rule: Rule, array: str) -> Column:
    out = rule[0].column(array)
    for c in rule[1:]:
        out = out & c.column(array)
    return out


def fit(rows: DataFrame, *, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> RuleModel:
    """The model of ``label`` (0 or 1) by ``_statistics``."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = next((float(k) for k in counts), 0.5)
        return RuleModel(float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))), [])
    rows = rows.select(F.col("label").cast("double").alias("label"), "_statistics")
    forest = RandomForestClassifier(featuresCol="vector", numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=5)
    grown = forest.fit(rows.withColumn("vector", array_to_vector("_statistics")))
    rules = tree_paths(grown.toDebugString)
    if not rules:
        return RuleModel(float(np.log(counts[1] / counts[0])), [])
    held = F.array(*(_holds(r, "_statistics").cast("double") for r in rules))
    table = staged(rows.select("label", array_to_vector(held).alias("vector")).coalesce(TASKS), "rules")
    found = LogisticRegression(featuresCol="vector", elasticNetParam=1.0, regParam=penalty, maxIter=40, tol=1e-4).fit(table)
    return RuleModel(float(found.intercept), [(float(c), r) for c, r in zip(found.coefficients, rules) if c])


# ------------------------------------------------------------ the operator

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def known_labels(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, label`` of what is learned from: labels (``doc_id, quality``)
    that aren't held out, about ``max_rows`` of them if there are more."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label IN (0, 1)").where(~held_out(F.col("doc_id")))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return staged(known, "labels")


def train(labelled: DataFrame) -> RuleModel:
    """The model of ``label, _statistics`` rows."""
    return fit(staged(labelled.select("label", "_statistics"), "learned").coalesce(TASKS))


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stats = staged(with_statistics(rows).drop("text"), "statistics")
    model = train(stats.join(known_labels(labels, max_rows), "doc_id"))
    scored = stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those scored under 0.5, all columns as they were. No
    text moves: the labels that are learned from, bounded by ``MAX_ROWS``, are
    broadcast, statistics of their texts taken to learn, and of all to filter."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = known_labels(labels)
    if known.count() <= 2 * MAX_ROWS:   # more only if one id has a great many labels
        known = F.broadcast(known)
    model = train(with_statistics(rows.join(known, "doc_id")))
    name = fresh(docs, "_statistics")
    return with_statistics(docs, text_col, name).where(model.score(name) >= 0.5).select(*own(docs))


def op3(spark, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
