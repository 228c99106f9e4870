"""Operator 8, exact dedup by content-defined chunk recipes.

A text is cut into chunks where its own bytes say so, so equal texts have equal
chunks. Each chunk gets a hash as its identifier, and the identifiers are
verified: every distinct (hash, bytes) pair of the corpus is gathered once, with
copies dropped before the shuffle, and a hash that stands for more than one
content is replaced by the content itself. A document is then its *recipe*,
the ordered list of verified identifiers, and equal recipes are equal texts.
Long texts move at most once, in pieces, for the verification; all grouping
and joining is on recipes.

Defined results: a null text counts as empty; the empty text has the empty
recipe. Of equal texts the largest id stays; null is less than any id. Rows
repeated with id and text alike each return a row, of which one is kept. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import TextSlice, fresh, own, read, scope, staged, text_slices

#: Chunks are 256 bytes to 16 KB, 2 KB on average beyond the least.
LEAST, MOST, BITS = 256, 16384, 11
_WINDOW = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)

#: Hash bytes, tried in turn: the next is taken when so many hashes collide
#: that their list would not stay small in every task.
DIGESTS = (8, 32)
MAX_COLLIDED = 100_000


def cut_points(s: TextSlice) -> Iterator[list[int]]:
    """For each text the ends of its chunks, from the text's start."""
    n = len(s.data)
    padded = s.data.tobytes() + bytes(_WINDOW)
    window = np.ndarray((n,), "<u8", padded, strides=(1,)) * _ODD  # the eight bytes from each position on
    marks = np.flatnonzero(window >> np.uint64(64 - BITS) == 0) + _WINDOW
    for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist()):
        ends, last = [], a
        for m in [*marks[np.searchsorted(marks, a + _WINDOW):np.searchsorted(marks, b, side="right")].tolist(), b]:
            if m - last < LEAST and m != b:
                continue
            while m - last > MOST:
                last += MOST
                ends.append(last - a)
            if m > last:
                ends.append(m - a)
                last = m
        yield ends


def _digest(chunk: bytes, size: int, bits: int | None) -> bytes:
    out = hashlib.blake2b(chunk, digest_size=size).digest()
    return out if bits is None else (int.from_bytes(out, "big") % (1 << bits)).to_bytes(size, "big")


def _recipes(docs: DataFrame, size: int, bits: int | None, by_content: frozenset = frozenset()) -> DataFrame:
    """``doc_id, n_bytes, text_sha256, recipe``; a chunk whose hash is in
    ``by_content`` is identified by its bytes."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        for batch in batches:
            for s in text_slices(batch.column(1)):
                raw, sizes, shas, recipes = s.data.tobytes(), np.diff(s.offsets), [], []
                for a, b, ends in zip(s.offsets.tolist(), s.offsets[1:].tolist(), cut_points(s)):
                    shas.append(hashlib.sha256(raw[a:b]).hexdigest())
                    chunks = [raw[a + x:a + y] for x, y in zip([0, *ends], ends)]
                    ids = [_digest(c, size, bits) for c in chunks]
                    recipes.append([b"=" + c if i in by_content else i for i, c in zip(ids, chunks)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s.start, len(s)), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), pa.array(recipes, pa.list_(pa.binary()))],
                    names=["doc_id", "n_bytes", "text_sha256", "recipe"])

    return docs.mapInArrow(run, T.StructType([T.StructField("doc_id", id_type), T.StructField("n_bytes", T.LongType()),
                                              T.StructField("text_sha256", T.StringType()), T.StructField("recipe", T.ArrayType(T.BinaryType()))]))


def _chunks(docs: DataFrame, size: int, bits: int | None) -> DataFrame:
    """``id, chunk`` of every chunk."""

    def run(batches):
        for batch in batches:
            for s in text_slices(batch.column(0)):
                raw, seen = s.data.tobytes(), {}
                for a, ends in zip(s.offsets.tolist(), cut_points(s)):
                    for x, y in zip([0, *ends], ends):
                        seen.setdefault(raw[a + x:a + y], None)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(c, size, bits) for c in seen], pa.binary()), pa.array(seen, pa.binary())], names=["id", "chunk"])

    return docs.select("text").mapInArrow(run, "id binary, chunk binary")


def recipes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hash_bits: int | None = None) -> DataFrame:
    """``doc_id, n_bytes, text_sha256, recipe`` of every row, the recipe made
    of verified identifiers. ``hash_bits`` weakens the hash, for tests."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    for size in DIGESTS:
        distinct = _chunks(docs, size, hash_bits).groupBy("id", "chunk").agg(F.count(F.lit(1)).alias("n"))
        collided = staged(distinct.groupBy("id").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("id"), "collided")
        found = [r[0] for r in collided.limit(MAX_COLLIDED + 1).collect()]
        if len(found) <= MAX_COLLIDED:
            return staged(_recipes(docs, size, hash_bits, frozenset(map(bytes, found))), "recipes")
    raise RuntimeError("the hash collides too often")


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hash_bits: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept,
    text_sha256, n_bytes``."""
    rows = recipes(docs, id_col=id_col, text_col=text_col, hash_bits=hash_bits)
    alike = rows.groupBy("recipe", "doc_id", "text_sha256", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
    alike = staged(alike, "alike")
    # written before rows are joined to it: a join of plain tables is one whose hot keys Spark can split
    groups = staged(alike.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")), "groups")
    joined = alike.join(groups, "recipe")
    return joined.select("doc_id", "keep_id", "group_size", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"), "text_sha256", "n_bytes") \
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256", "n_bytes")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies, all columns as they were. Rows of one id
    and text alike become one, any of them."""
    sha = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)
    gone_id, gone_sha = fresh(docs, "_gone_id"), fresh(docs, "_gone_sha")
    with scope():
        found = staged(exact_dedup(docs, id_col=id_col, text_col=text_col), "exact")
        pairs = found.groupBy(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha)).agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
        pairs = staged(pairs, "pairs", outlives=True)
    if not pairs.where("kept AND n > 1").isEmpty():   # an id that repeats with its text: one of its rows stays
        columns = own(docs)
        docs = docs.withColumn(gone_sha, sha).dropDuplicates([id_col, gone_sha]).select(*columns)
    gone = pairs.where("NOT kept").select(gone_id, gone_sha)
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col(gone_id)) & (sha == F.col(gone_sha)), "left_anti")


def op8(spark, sf_dir: str) -> DataFrame:
    """Which documents are exact copies, and which of each group stays."""
    return exact_dedup(read(spark, sf_dir, "documents")).drop("n_bytes")


OP8_SQL = """WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)"""
