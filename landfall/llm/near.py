"""Operator 7, near-duplicate groups by DartMinHash.

A text is the set of its shingles (runs of five words), each with a weight.
Darts are thrown by hashing: every unit-area cell of an element's weight axis
and the rank axis holds a Poisson number of darts, the same for whoever holds
the element, and a text takes those under its weight and under a rank that
lets through enough of them for all coordinates. Each dart belongs to one
coordinate by its hash; the earliest of each coordinate is kept. Two texts
agree on a coordinate with the probability of their weighted Jaccard
similarity, at a cost that hardly grows with the number of coordinates.

Signatures are cut into bands. Copies (equal shingle sets) are one node.
Candidates are then compared by their whole sets, without all pairs of a
bucket: first each text with the two leaders (least ids of buckets) that it
shares most bands with. Of what no leader has brought together, a text is left
only if it can have a partner: two sets alike enough share one of their first
shingles in any one order, the rarest first here, so that texts which share no
more than what all have (a site's boilerplate) are alone. The rest are
compared in blocks of their buckets, where sizes and a bound on what they share
allow. Links are pairs at or over the threshold; groups are their connected
components.

A set is compared by 32 bits of each shingle's hash: a pair of sets of a
thousand shingles has one shared too many with a probability of 2**-12, which
moves its similarity by 0.0005. Equal sets are one node by two independent
64-bit sums and their size; different ones are taken for equal with a
probability of 2**-128.

Defined results: words are separated by ASCII white space and compared as they
stand; a text of one to four words has one shingle. Null counts as empty; texts
without words are alike only if equal. Rows of one id count as one document; a
null id has no group and is kept. An empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.llm.common import GOLD, TextSlice, discard, fresh, kept, mix, own, read, scope, shingles, span_hash, split_asked, staged, text_slices, words
from landfall.llm.components import components
from landfall.llm.segments import spread

THRESHOLD = 0.8
#: A pair of similarity 0.8 shares a band with probability 0.9995.
BANDS, ROWS = 32, 7
#: Leaders that a text is compared with at first.
LEADERS = 2
#: Members of a bucket to a block when it is compared in blocks.
BLOCK = 512
#: Shingles compared at a time in a block, and flags to mark a text's shingles.
MARKED = 1 << 20
#: Counters that tell rare shingles from common ones.
SLOTS = 1 << 18
#: Texts whose darts are held at a time.
AT_ONCE = 256

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B, _C = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


# ------------------------------------------------------------ darts

def _unit(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _throw(out: np.ndarray, element: np.ndarray, weight: np.ndarray, text: np.ndarray, reach: np.ndarray) -> None:
    """Lower ``out`` (texts by coordinates) to the earliest darts of rank up
    to ``reach`` of the text."""
    k = out.shape[1]
    flat = out.reshape(-1)
    part, low, width = 0, 0.0, 1.0
    while (held := np.flatnonzero(weight > low)).size:
        # a column of cells of unit area: ``width`` of weight by 1 / width of rank
        cells = np.ceil(reach[text[held]] * width).astype(np.int64)
        item, cell = np.repeat(held, cells), spread(np.zeros(len(held), np.int64), cells)
        key = mix(element[item] * _A + (cell.astype(np.uint64) + np.uint64(1)) * _B + np.uint64(part * int(_C) % (1 << 64)))
        at, count = np.zeros(len(item)), 0
        while len(item):
            count += 1
            h = mix(key + np.uint64(count * int(GOLD) % (1 << 64)))
            at = at - np.log(_unit(h))   # arrivals of a Poisson process of rate 1
            on = at < 1.0
            item, cell, key, at, h = item[on], cell[on], key[on], at[on], h[on]
            dart = mix(h ^ _A)
            rank = (cell + at) / width
            hit = (rank <= reach[text[item]]) & (low + width * _unit(mix(h ^ _B)) <= weight[item])
            where, dart, rank = text[item[hit]], dart[hit], rank[hit]
            coordinate = ((dart >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
            value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF))
            np.minimum.at(flat, where * k + coordinate.astype(np.int64), value)
        low, width, part = (1.0, 1.0, 1) if part == 0 else (low * 2, width * 2, part + 1)


def signatures(element: np.ndarray, weight: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """For each text, whose elements stand from ``first[i]`` to ``first[i + 1]``,
    its ``k`` earliest darts; all ones for a text without elements."""
    n = len(first) - 1
    out = np.full((n, k), _EMPTY)
    size = np.diff(first)
    todo, scale = np.flatnonzero(size), k * (np.log(k) + 2.0)
    while todo.size:
        for some in np.array_split(todo, -(-len(todo) // AT_ONCE)):
            at = spread(first[some], size[some])
            text = np.repeat(np.arange(len(some)), size[some])
            total = np.bincount(text, weights=weight[at])
            part = np.full((len(some), k), _EMPTY)
            _throw(part, element[at], weight[at], text, scale / total)
            out[some] = part
        todo = todo[(out[todo] == _EMPTY).any(axis=1)]
        scale *= 2   # a coordinate without a dart: throw further
    return out


# ------------------------------------------------------------ texts

def shingle_sets(s: TextSlice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles (44-bit hashes) of each text, how often each
    occurs, and where each text's begin (one more than there are texts)."""
    h, text = shingles(words(s))
    key = np.sort((text.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(begins, len(key)))
    key = key[begins]
    first = np.searchsorted(key >> np.uint64(44), np.arange(len(s) + 1, dtype=np.uint64))
    return key & np.uint64((1 << 44) - 1), count, first


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[first[1:]] - total[first[:-1]]


def signed(docs: DataFrame, *, bands: int = BANDS, rows: int = ROWS, counted: bool = False) -> DataFrame:
    """``doc_id``, two sums that equal sets share, the number of shingles,
    band hashes, a byte of each coordinate, and the set itself."""
    k = bands * rows
    odd = mix(np.arange(1, rows + 1, dtype=np.uint64) * GOLD) | np.uint64(1)
    spec = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(n, T.LongType()) for n in ("sum_a", "sum_b", "size")),
                         T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType()), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in text_slices(batch.column(1), max_rows=4096):
                element, count, first = shingle_sets(s)
                if counted:   # the i-th occurrence of a shingle is an element of the set compared
                    weight = count.astype(float)
                    copy = spread(np.zeros(len(count), np.int64), count)
                    whole = mix(np.repeat(element, count) + copy.astype(np.uint64) * GOLD)
                    bounds = np.concatenate([[0], np.cumsum(count)])[first]
                else:
                    weight, whole, bounds = np.ones(len(element)), mix(element), first
                found = signatures(element, weight, first, k)
                none = np.diff(first) == 0
                banded = mix((found.reshape(len(s), bands, rows) * odd).sum(axis=2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _C).view(np.int64)
                sum_a = np.where(none, span_hash(s.data, s.offsets[:-1], s.offsets[1:]), _sums(mix(whole ^ _B), bounds))
                sum_b = np.where(none, span_hash(s.data, s.offsets[:-1], s.offsets[1:], second=True), _sums(mix(whole ^ _C), bounds))
                short = (whole & np.uint64(0xFFFFFFFF)).astype("<u4")
                sets = [np.unique(short[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                byte = (mix(found) & np.uint64(0xFF)).astype(np.uint8)
                for a in range(0, len(s), 4096):
                    b = min(a + 4096, len(s))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(s.start + a, b - a), pa.array(sum_a[a:b].view(np.int64)), pa.array(sum_b[a:b].view(np.int64)), pa.array(np.diff(bounds)[a:b]),
                        pa.array([[] if e else x for e, x in zip(none[a:b], banded[a:b])], pa.list_(pa.int64())),
                        pa.array([b"" if e else x.tobytes() for e, x in zip(none[a:b], byte[a:b])], pa.binary()),
                        pa.array([sets[i].tobytes() for i in range(a, b)], pa.binary())], names=spec.names)

    return docs.mapInArrow(run, spec)


# ------------------------------------------------------------ links

def _jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 1.0


def _may_be_near(mine: np.ndarray, others: list[np.ndarray], threshold: float, flags: np.ndarray) -> np.ndarray:
    """Which of the sets can reach the threshold with ``mine``: an upper bound
    on what they share, as shingles with equal low bits count as shared. No
    pair at or over the threshold is left out. ``flags`` are false."""
    size = np.array([len(x) for x in others])
    out = np.minimum(size, len(mine)) >= threshold * np.maximum(size, len(mine)) - 1e-6
    low = np.uint32(len(flags) - 1)
    flags[mine & low] = True
    held = np.flatnonzero(out)
    at = 0
    while at < len(held):
        to = max(at + 1, at + int(np.searchsorted(np.cumsum(size[held[at:]]), MARKED, side="right")))
        some = held[at:to]
        hit = flags[np.concatenate([others[x] for x in some]) & low]
        shared = np.minimum(np.add.reduceat(hit, np.concatenate([[0], np.cumsum(size[some])[:-1]]), dtype=np.int64), len(mine))
        out[some] = shared >= threshold * (size[some] + len(mine) - shared) - 1e-6
        at = to
    flags[mine & low] = False
    return out


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """``a, b, similarity`` of the pairs (``a, b, set_a``) whose sets are alike
    enough."""
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.array([_jaccard(x.as_py(), y.as_py()) for x, y in zip(batch.column("set_a"), batch.column("set_b"))], dtype=float)
            keep = pa.array(near >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep), pa.array(near).filter(keep)], names=["a", "b", "similarity"])

    return pairs.join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint, similarity double")


def first_shingles(shingles: np.ndarray, commonness: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """The set's shingles in the order of ``commonness`` (by their low bits),
    as far as a partner of any size must share one; and how many of them a
    partner must share one of that is at least as large."""
    n = len(shingles)
    order = np.lexsort((shingles, commonness[shingles & np.uint32(len(commonness) - 1)]))
    least = lambda share: max(1, n - int(np.ceil(share * n - 1e-6)) + 1)
    return shingles[order[:least(threshold)]], min(n, least(2 * threshold / (1 + threshold)))


def with_partners(sets: DataFrame, threshold: float) -> DataFrame:
    """Ids of the ``doc_id, component, shingles`` rows that can have a partner
    of another component: it is near only if one of the smaller set's first
    shingles is among the larger one's."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                np.add.at(total, np.frombuffer(x.as_buffer(), "<u4") & np.uint32(SLOTS - 1), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    commonness = np.zeros(SLOTS, np.int64)   # at most SLOTS rows come to the driver
    for r in sets.select("shingles").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        commonness[r["slot"]] = r["n"]

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [first_shingles(np.frombuffer(x.as_buffer(), "<u4"), commonness, threshold) for x in batch.column("shingles")]
            size = [len(x) for x, _ in found]
            at = pa.array(np.repeat(np.arange(len(size)), size))
            leads = np.concatenate([np.arange(len(x)) < k for x, k in found]) if found else np.zeros(0, bool)
            tokens = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("component").take(at), pa.array(tokens.astype(np.int64)), pa.array(leads)], names=["doc_id", "component", "token", "leads"])

    tokens = staged(sets.select("doc_id", "component", "shingles").mapInArrow(firsts, "doc_id long, component long, token long, leads boolean"), "tokens")
    met = tokens.groupBy("token").agg(F.max("leads").alias("leads"), F.min("component").alias("least"), F.max("component").alias("most"))
    out = staged(tokens.join(met.where("leads AND least < most").select("token"), "token", "left_semi").select("doc_id").distinct(), "partners")
    discard(tokens)
    return out


def _linked(rows: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` that join different groups within each (``bucket, i,
    j``): pairs are compared by their sets, those first whose signatures agree
    most, each pair in the first band that the two share, until a link joins
    their groups. There are fewer links than rows."""

    def block(t: pa.Table) -> tuple[list, list]:
        n = t.num_rows
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(n, -1)
        bands = np.array(t.column("bands").to_pylist(), dtype=np.int64)
        doc, sets = t.column("doc_id").to_pylist(), t.column("shingles")
        views = [np.frombuffer(x.as_buffer(), "<u4") for x in sets]
        flags = kept("flags", lambda: np.zeros(MARKED, bool))
        group = np.unique(np.array(t.column("component").to_pylist()), return_inverse=True)[1]
        part, key = t.column("part").to_numpy(), t.column("bucket")[0].as_py()
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        mine = int(np.flatnonzero(bands[0] == key)[0])
        xs, ys = [], []
        for r in range(n):
            if i != j and part[r] != i:
                continue
            other = np.flatnonzero((group != group[r]) & ((part == j) if i != j else (np.arange(n) > r)))
            if not len(other):
                continue
            if mine:
                other = other[~(bands[other, :mine] == bands[r, :mine]).any(axis=1)]
            other = other[_may_be_near(views[r], [views[x] for x in other], threshold, flags)] if len(other) else other
            agree = (sketch[other] == sketch[r]).mean(axis=1)
            for x in other[np.argsort(-agree, kind="stable")].tolist():
                if group[x] != group[r] and _jaccard(sets[r].as_py(), sets[x].as_py()) >= threshold:
                    xs.append(doc[r])
                    ys.append(doc[x])
                    group[group == group[x]] = group[r]
        return xs, ys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        out: tuple[list, list] = ([], [])

        def close() -> None:
            if held:
                xs, ys = block(pa.Table.from_batches(held))
                out[0].extend(xs)
                out[1].extend(ys)
                held.clear()

        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in ("bucket", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if (key := tuple(keys[a])) != last:
                    close()
                    last = key
                held.append(batch.slice(a, b - a))
            if len(out[0]) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])
                out = ([], [])
        close()
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])

    return rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a bigint, b bigint")


def groups(docs: DataFrame, *, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, counted: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, kept, n_shingles`` of every row: the least id of
    the row's group, and whether it is the row's own. ``counted`` weighs a
    shingle by its occurrences."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    every = staged(signed(docs, bands=bands, rows=rows, counted=counted), "signed")
    alike = ["sum_a", "sum_b", "size"]
    # one node for equal sets. Groups are written before rows are joined to them: a join of plain tables is one whose
    # hot keys Spark can split
    nodes = staged(every.groupBy(*alike).agg(F.min("doc_id").alias("first"), F.min_by("bands", "doc_id").alias("bands")), "nodes")
    members = every.select("doc_id", *alike).join(nodes.select(*alike, "first"), alike).select("doc_id", "first", "size")
    held = nodes.where("first IS NOT NULL").select(F.col("first").alias("doc_id"), F.explode("bands").alias("bucket"))
    # buckets of several texts; the least id leads
    sizes = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("leader"), F.max("doc_id").alias("most"))
    shared = staged(held.join(staged(sizes.where("leader < most").drop("most"), "sizes"), "bucket"), "buckets")
    # each text with the leaders that it shares most buckets with
    met = shared.groupBy("doc_id").agg(F.array_sort(F.collect_list("leader")).alias("leaders"))
    runs = F.transform(F.array_distinct("leaders"), lambda x: F.struct((-F.size(F.filter("leaders", lambda y: y == x))).alias("n"), x.alias("leader")))
    best = F.slice(F.array_sort(F.filter(runs, lambda x: x["leader"] != F.col("doc_id"))), 1, LEADERS)
    # a text without words has no bands, and is near none
    sets = staged(every.where(F.size("bands") > 0).select("doc_id", "bands", "sketch", "shingles").join(met.select("doc_id", best["leader"].alias("leaders")), "doc_id"), "sets")
    stars = sets.select(F.col("doc_id").alias("a"), F.explode("leaders").alias("b"), F.col("shingles").alias("set_a"))
    links = staged(verified(stars, sets, threshold).select("a", "b"), "links")
    # what is left: texts of a bucket that don't share a leader, nor a leader's leader
    label = links.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("label"))
    label = label_at = staged(label, "labels")
    above = label.select(F.col("a").alias("label"), F.col("label").alias("above"))
    label = label.join(above, "label", "left").select(F.col("a").alias("doc_id"), F.coalesce("above", "label").alias("label"))
    placed = staged(shared.join(label, "doc_id", "left").select("bucket", "n", "doc_id", F.coalesce("label", "doc_id").alias("component")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = staged(mixed.where("least < most").select("bucket"), "mixed")
    left = staged(placed.join(mixed, "bucket").drop("n"), "left")
    # rows of one id may hold different texts: each by itself
    alone = left.select("doc_id", "component").distinct().join(sets.select("doc_id", "shingles"), "doc_id")
    left = staged(left.join(with_partners(staged(alone, "residue"), threshold), "doc_id", "left_semi"), "partnered")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    rest = left.join(left.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket").withColumn("part", F.pmod(F.xxhash64("doc_id"), parts).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rest = rest.select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "doc_id", "component")
    # rows of one id may hold different texts: those that are in the bucket, and each pair of rows once
    rest = rest.distinct().join(sets.drop("leaders"), "doc_id").where(F.array_contains("bands", F.col("bucket")))
    more = _linked(rest, threshold)
    final = components(links.unionAll(more))
    discard(sets, shared, links, label_at, placed, mixed)
    joined = members.join(final, F.col("first") == F.col("node"), "left")
    return joined.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "first")).alias("class_id"), F.col("size").alias("n_shingles")) \
        .select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"), "n_shingles")


def drop_near(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group, all columns as they were."""
    name = fresh(docs, "_gone")
    with scope():
        gone = staged(groups(docs, id_col=id_col, text_col=text_col, **options).where("not kept").select(F.col("doc_id").alias(name)).distinct(), "near", outlives=True)
    some, others = split_asked(docs.withColumn(name, F.col(id_col).cast("long")), gone, [name])
    left = some.join(gone, name, "left_anti").select(*own(docs))
    return left if others is None else left.unionAll(others.select(*own(docs)))


def op7(spark, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate ``documents``: five words, 0.8."""
    return groups(read(spark, sf_dir, "documents"))
