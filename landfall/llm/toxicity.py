"""Operator 11, a toxicity classifier on character n-grams scaled by naive
Bayes log-count ratios.

A text's features are the character n-grams (three to five code points, lower
case, with a space before and after the text) that occur in it, hashed to a
fixed number of buckets. Over the labelled texts each bucket gets the log of
the ratio of its smoothed shares in toxic and in other texts. The buckets that
tell the classes apart best are kept, their presence is scaled by that ratio,
and a logistic regression with an elastic-net penalty weighs them. A score is
then a sum over the kept n-grams that a text holds, each once: one pass over
whole texts, with one table of weights of a fixed size.

Only ``labels.toxic`` of rows whose crc32(doc_id) mod 5 isn't 0 is learned
from, at most about ``max_rows`` of them (by a hash of the id); every text is
scored.

Defined results: null text counts as empty, and empty texts are scored like
others; a null id is not held out and not learned from; rows repeated are
scored each; an id labelled several times is learned from each time. Labels of
one class give that class's share as everyone's score, no labels 0.5. An empty
table gives no rows. ``lang``, ``source``, ids and labels are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import GOLD, TextSlice, mix, read, staged, text_slices

#: Labelled rows that are learned from, about, if there are more.
MAX_ROWS = 20_000
SIZES = (3, 4, 5)
BITS = 21
#: Buckets that are weighed, and documents that must hold one of them.
FEATURES, LEAST_DOCS = 20_000, 3
SMOOTHING = 1.0
PENALTY, ELASTIC = 1e-4, 0.5
#: Learning goes over these few rows again and again: in few tasks.
TASKS = 8
SEED = 11
#: Bytes of text whose n-grams are held at a time.
AT_ONCE = 1 << 18

_PLACE = mix(np.arange(301, 301 + max(SIZES), dtype=np.uint64) * GOLD) | np.uint64(1)
#: What tells the sizes apart.
_SIZE = mix(np.arange(401, 401 + max(SIZES), dtype=np.uint64) * GOLD)
_WHITE = np.array([9, 10, 11, 12, 13], np.uint32)


class Grams:
    """The n-grams of a slice's texts: for each size a bucket for each
    position, and whether the n-gram lies within one text."""

    def __init__(self, s: TextSlice, sizes: tuple[int, ...] = SIZES, bits: int = BITS):
        raw = s.data.tobytes()
        texts = [f" {raw[a:b].decode().lower()} " for a, b in zip(s.offsets.tolist(), s.offsets[1:].tolist())]
        self.n, self.sizes, self.bits = len(texts), sizes, bits
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).copy()
        self.codes[np.isin(self.codes, _WHITE)] = 32

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        total = np.zeros(len(self.codes), np.uint64)
        for j in range(max(self.sizes)):
            there = len(self.codes) - j
            if there <= 0:
                return
            total = total[:there] + self.codes[j:] * _PLACE[j]
            if j + 1 in self.sizes:
                within = np.ones(there, bool)
                for k in range(1, j + 1):   # the last places of a text begin no n-gram
                    at = self.ends - k
                    at = at[(at >= self.starts) & (at < there)]
                    within[at] = False
                yield (mix(total + _SIZE[j]) >> np.uint64(64 - self.bits)).astype(np.int64), within

    def held(self, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (text, bucket) pairs, by text; only buckets for which
        ``wanted`` is true, if given."""
        found = []
        for bucket, within in self:
            at = np.flatnonzero(within if wanted is None else within & wanted[bucket])
            text = np.searchsorted(self.ends, at, side="right")
            found.append((text.astype(np.int64) << self.bits) | bucket[at])
        key = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return key >> self.bits, key & ((1 << self.bits) - 1)


@dataclass
class NgramModel:
    """``weight`` of each kept bucket; ``score`` of an empty text is the
    intercept's."""

    intercept: float
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    sizes: tuple[int, ...] = SIZES
    bits: int = BITS

    def totals(self, s: TextSlice) -> np.ndarray:
        table = np.zeros(1 << self.bits)
        table[self.buckets] = self.weights
        return self._totals(s, table)

    def _totals(self, s: TextSlice, table: np.ndarray) -> np.ndarray:
        text, bucket = Grams(s, self.sizes, self.bits).held(table != 0)
        return self.intercept + np.bincount(text, weights=table[bucket], minlength=len(s))

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with a column ``score``, the probability of label 1."""
        plain = [f"c{i}" for i in range(len(docs.columns))]
        at = docs.columns.index(text_col)
        spec = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(plain, docs.schema.fields)), T.StructField("score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = np.zeros(1 << self.bits)
            table[self.buckets] = self.weights
            for batch in batches:
                total = [self._totals(s, table) for s in text_slices(batch.column(at), AT_ONCE)]
                if total:
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1.0 / (1.0 + np.exp(-np.concatenate(total).clip(-500, 500))))], names=spec.names)

        return docs.toDF(*plain).mapInArrow(run, spec).toDF(*docs.columns, "score")


# ------------------------------------------------------------ learning

def _presence(rows: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """``label, buckets`` of ``label, text`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = None
        if wanted is not None:
            mask = np.zeros(1 << BITS, bool)
            mask[wanted] = True
        for batch in batches:
            for s in text_slices(batch.column(1), AT_ONCE):
                text, bucket = Grams(s).held(mask)
                first = np.searchsorted(text, np.arange(len(s) + 1))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.start, len(s)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bucket.astype(np.int32)))], names=["label", "buckets"])

    return rows.mapInArrow(run, "label int, buckets array<int>")


def bucket_counts(rows: DataFrame) -> DataFrame:
    """``bucket, toxic, other``: of ``label, text`` rows, how many of each
    class hold the bucket. Each task adds its texts up first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for s in text_slices(batch.column(1), AT_ONCE):
                text, bucket = Grams(s).held()
                toxic = label[s.start:s.stop][text] == 1
                np.add.at(counts[1], bucket[toxic], 1)
                np.add.at(counts[0], bucket[~toxic], 1)
        at = np.flatnonzero(counts.sum(axis=0))
        for a in range(0, len(at), 1 << 16):
            some = at[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(counts[k][some].astype(np.int64)) for k in (1, 0))], names=["bucket", "toxic", "other"])

    found = rows.mapInArrow(run, "bucket int, toxic long, other long")
    return found.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_ratio(toxic: int, other: int) -> Column:
    """A bucket's naive Bayes log-count ratio, from the classes' sizes."""
    share = lambda c, n: (F.col(c) + SMOOTHING) / (n + 2 * SMOOTHING)
    return F.log(share("toxic", toxic) / share("other", other))


def fit(rows: DataFrame, *, features: int = FEATURES, penalty: float = PENALTY) -> NgramModel:
    """The model of ``label`` (0 or 1) by ``text``; ``rows`` are read twice."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        share = next((float(k) for k in sizes), 0.5)
        return NgramModel(float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    counts = bucket_counts(rows).where(F.col("toxic") + F.col("other") >= LEAST_DOCS).withColumn("ratio", log_ratio(sizes[1], sizes[0]))
    # how surely the classes differ: the ratio by its standard error
    apart = F.abs("ratio") / F.sqrt(1 / (F.col("toxic") + SMOOTHING) + 1 / (F.col("other") + SMOOTHING))
    chosen = counts.orderBy(apart.desc(), "bucket").limit(features).select("bucket", "ratio").orderBy("bucket").collect()
    if not chosen:
        return NgramModel(float(np.log(sizes[1] / sizes[0])))
    buckets, ratio = np.array([r["bucket"] for r in chosen]), np.array([r["ratio"] for r in chosen])
    held = _presence(rows, buckets).select("label", F.col("buckets").cast("array<string>").alias("held"))
    counted = CountVectorizerModel.from_vocabulary([str(b) for b in buckets.tolist()], inputCol="held", outputCol="present", minTF=1.0)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratio), inputCol="present", outputCol="features")
    table = staged(scaled.transform(counted.transform(held)).select(F.col("label").cast("double").alias("label"), "features"), "scaled")
    found = LogisticRegression(elasticNetParam=ELASTIC, regParam=penalty, maxIter=100, tol=1e-6, standardization=False).fit(table)
    weights = found.coefficients.toArray() * ratio
    return NgramModel(float(found.intercept), buckets[weights != 0], weights[weights != 0])


# ------------------------------------------------------------ the operator

def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def known_labels(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``_id, label`` of what is learned from: labels (``doc_id, toxic``) that
    aren't held out, about ``max_rows`` of them if there are more."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("label")).where("label IN (0, 1) AND _id IS NOT NULL").where(~held_out(F.col("_id")))
    n = known.count()
    if n > max_rows:
        known = known.where(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return staged(known, "labels")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> NgramModel:
    """The model of labels by the texts of ``doc_id, text`` rows. Texts don't
    move to find the labelled ones: the labels, bounded by ``max_rows``, do."""
    known = known_labels(labels, max_rows)
    if known.count() <= 2 * max_rows:   # more only if one id has a great many labels
        known = F.broadcast(known)
    rows = docs.join(known, F.col("doc_id") == F.col("_id")).select("label", "text")
    return fit(staged(rows.coalesce(TASKS), "learned"))


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = train(rows, labels, max_rows).score(rows)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those scored at ``threshold`` or over, all columns as
    they were."""
    model = train(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), labels)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("t", F.col(names[docs.columns.index(text_col)]).cast("string"))
    return model.score(rows, "t").where(F.col("score") < threshold).select(*names).toDF(*docs.columns)


def op11(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of ``documents``."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
