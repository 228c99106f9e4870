"""Operator 4, document fingerprints by bottom-k sketches [native].

A text's sketch is the ``k`` smallest distinct hashes of its shingles (runs of
five words; a shorter text has the one run of all its words). The sketch of two
parts together is the ``k`` smallest of both sketches, so sketches merge;
what two sketches share among the ``k`` smallest of both estimates
resemblance, and the k-th smallest hash the number of distinct shingles. With
fewer than ``k`` shingles all of this is exact. Everything is SQL functions
over arrays: no Python runs on the executors.

Defined results: null counts as the empty text; texts without words have the
empty sketch and resemble each other fully, others not at all. Rows of one id
are put in order by their text, in one task, as are all rows with a null id
(ranges divide ids, not the rows of one); null is the least id. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from landfall.llm.common import read

K = 128
WORDS = 5

#: For putting documents next to their neighbours by id: documents to a range
#: of ids, and most ranges (their bounds are all that the driver sees). The
#: bounds, which only deal rows out, come from about SAMPLED ids a range.
ROWS_PER_RANGE = 1000
MOST_RANGES = 1 << 16
SAMPLED = 20


# ------------------------------------------------------------ sketches

def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with column ``name``: the sketch of column ``text``, ascending
    64-bit hashes. In steps, so that no step is computed once per use."""
    words, hashes = f"{name}_words", f"{name}_hashes"
    at = lambda i, j: F.get(F.col(hashes), i + j)
    df = df.withColumn(words, F.split(F.col(text), r"[\t-\r ]+"))
    df = df.withColumn(hashes, F.transform(F.filter(F.col(words), lambda w: w != ""), lambda w: F.xxhash64(w)))
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size(hashes) - WORDS, F.lit(0))),
                       lambda i: F.xxhash64(*(at(i, j) for j in range(WORDS))))
    df = df.withColumn(name, F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(bottom(runs, k)))
    return df.drop(words, hashes)


def bottom(hashes: Column, k: int = K) -> Column:
    """The ``k`` smallest distinct hashes of an array."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both sketched parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of either part that both have."""
    both = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    union = F.size(merge(a, b, k))
    return F.when(union == 0, 1.0).otherwise(both / union)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles, exact below ``k``."""
    share = (F.element_at(a, -1).cast("double") + 2.0 ** 63) / 2.0 ** 64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def merge_all(df: DataFrame, sketch: str, by: list[str], k: int = K, fan_in: int = 64) -> DataFrame:
    """One merged sketch for each value of ``by``. Hashes beyond the ``k``
    smallest of a random share of a group's rows are dropped first, so that a
    group of any size meets in one task only as ``fan_in`` short arrays."""
    shares = df.select(*by, F.pmod(F.xxhash64(sketch), F.lit(fan_in)).alias("_share"), F.explode(sketch).alias("_hash")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by, "_share").orderBy("_hash"))
    some = shares.withColumn("_rank", rank).where(F.col("_rank") <= k)
    merged = some.groupBy(*by).agg(F.slice(F.array_sort(F.collect_set("_hash")), 1, k).alias(sketch))
    return df.select(*by).distinct().join(merged, by, "left").withColumn(sketch, F.coalesce(sketch, F.array().cast("array<bigint>")))


def as_string(a: Column) -> Column:
    """A sketch as base64 of its big-endian hashes."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")))


# ------------------------------------------------------------ neighbours by id

def _ranged(df: DataFrame, bounds: list[int]) -> DataFrame:
    """``df`` with the number of its id's range: how many bounds are at most
    the id, found by halving (each step a column, or the next would repeat it)."""
    if not bounds:
        return df.withColumn("range", F.lit(0))
    steps = max(1, len(bounds).bit_length())
    table = F.lit(bounds + [None] * ((1 << steps) - 1 - len(bounds)))
    df = df.withColumn("_r0", F.lit(0))
    for i in range(steps):
        step = 1 << (steps - 1 - i)
        up = F.get(table, F.col(f"_r{i}") + (step - 1)) <= F.col("doc_id")
        df = df.withColumn(f"_r{i + 1}", F.col(f"_r{i}") + F.when(up, step).otherwise(0))
    return df.withColumnRenamed(f"_r{steps}", "range").drop(*(f"_r{i}" for i in range(steps)))


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """Documents (``doc_id, text``) with their sketch, and the text and sketch
    of the next one by descending id (after the last, the first). Rows move
    once, to ranges of ids; each range also gets a copy of the first document
    of the range that follows it."""
    count = docs.count()
    if not count:
        bounds: list[int] = []
    else:
        n = min(MOST_RANGES, -(-count // ROWS_PER_RANGE))
        some = docs.select("doc_id").where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, count // (SAMPLED * n)))) == 0)
        found = some.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], SAMPLED * n)).first()[0] or []
        bounds = sorted(set(found)) if n > 1 else []
    firsts = sorted((r[0], r[1]) for r in _ranged(docs.select("doc_id"), bounds).groupBy("range").agg(F.max("doc_id")).collect())
    # a range's documents are followed by the first of the next lower range, the lowest range's by the first of all
    copies = [(r, firsts[i - 1][1]) for i, (r, _) in enumerate(firsts)]
    spark = docs.sparkSession
    wanted = spark.createDataFrame(copies, T.StructType([T.StructField("range", T.IntegerType()), T.StructField("_first", docs.schema["doc_id"].dataType)]))
    copied = docs.join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("_first"))).select("doc_id", "text", "range", F.lit(True).alias("copy"))
    rows = _ranged(docs, bounds).select("doc_id", "text", "range", F.lit(False).alias("copy")).unionByName(copied)
    rows = with_sketch(rows.repartition("range"), "text", "sketch", k)
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
    return rows.where("not copy").drop("range", "copy")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Every document's fingerprint and that of its edited text (its last
    third replaced by as many code points from the start of the next), with
    the estimated resemblances."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = with_next(docs, k).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring("next_text", F.lit(1), cut)))
    rows = with_sketch(rows.drop("text", "next_text"), "edited", "edited_sketch", k)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"), as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))


def op4(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text and its neighbour."""
    return fingerprints(read(spark, sf_dir, "documents"))
