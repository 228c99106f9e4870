"""Operator 13, the prefix trie of conversations, with subtree totals by
parallel tree contraction.

A turn is its hash; a prefix is the polynomial sum of its turns' hashes, so
the state of every prefix follows from running sums over rows sorted by
conversation and turn. The sort is by ranges, so a long conversation is dealt
over tasks, and each range's sum is carried into the next: one row of each
range reaches the driver. Prefixes group into nodes, named by their least
member and their depth.

Totals of subtrees come from *contraction*. Each round rakes the leaves (their
totals go to their parents, added up before they are shuffled) and compresses
unary chains (of neighbours in a chain, chosen by a bit of the depth or of a
hash, one is spliced out, and its weight goes onto the edge below). A round is
one grouping and two joins by node, and leaves a fraction of the tree, so
rounds grow with the logarithm of the depth, not with the depth. Then the
rounds are played back: a spliced node's total is that of its only child plus
what was on the way.

The members that end at a node are sorted by ranges too, written out in chunks
and hashed chunk after chunk, so that a node where a great many end is one
task's stream of few rows.

Defined results: rows with null conv_id are left out; null role and text are
empty; null turns come first, and of equal turns the one with the least hash.
Repeated rows are repeated turns. ``conv_id % 100`` has the sign of the id, as
in SQL. An empty table gives no rows, not even a root; other columns are
ignored. Two different prefixes of one depth are taken for one with a
probability of 2**-128 (two independent sums of 64-bit halves of an MD5), and
aren't compared by their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import read, staged

#: Fixed values of the task: whose turns come first, and at most how many.
BLOCK, MOST_SHARED = 100, 6
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)   # odd
CHUNK_BYTES = 1 << 20
MOST_ROUNDS = 200


def shared(conv: Column) -> Column:
    """How many turns a conversation takes from another."""
    return (F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def _half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def _power(which: int, exponent: np.ndarray) -> np.ndarray:
    """Powers of an odd base modulo 2**64, of negative exponents too."""
    out = np.ones(len(exponent), np.uint64)
    for sign in (1, -1):
        left = np.maximum(exponent * sign, 0).astype(np.uint64)
        base = np.uint64(pow(_BASE[which], sign, 1 << 64))
        with np.errstate(over="ignore"):
            while left.any():
                odd = (left & np.uint64(1)).astype(bool)
                out[odd] *= base
                base, left = base * base, left >> np.uint64(1)
    return out


# ------------------------------------------------------------ positions

def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


_STATE = "pos long, chars long, a long, b long, pa long, pb long"


def _running(sorted_rows: DataFrame) -> DataFrame:
    """Position and running sums of each row within its conversation's rows of
    the same task, which task, and whether the task may have begun within it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        first = last = None
        count, sums = 0, [np.uint64(0), np.uint64(0)]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column("conv_id").to_numpy()
            first = conv[0] if first is None else first
            if conv[0] != last:
                count, sums = 0, [np.uint64(0), np.uint64(0)]
            begins = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            size = np.diff(np.append(begins, n))
            start = np.repeat(begins, size)
            pos = np.arange(n) - start + np.where(start == 0, count, 0)
            out = []
            for which, name in enumerate(("a", "b")):
                term = _unsigned(batch, name) * _power(which, pos)
                total = np.cumsum(term, dtype=np.uint64)
                before = np.concatenate([[np.uint64(0)], total])[start]
                now = total - before + np.where(start == 0, sums[which], np.uint64(0))
                out.append((now, now - term))
                sums[which] = now[-1]
            count, last = int(pos[-1]) + 1, conv[-1]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(pos), batch.column("chars"), *(pa.array(x[k].view(np.int64)) for k in (0, 1) for x in out),
                                              pa.array(conv == first), pa.array(np.full(n, task, np.int32))], names=["conv_id", "pos", "chars", "a", "b", "pa", "pb", "opening", "task"])

    return sorted_rows.mapInArrow(run, f"conv_id long, {_STATE}, opening boolean, task int")


def positions(turns: DataFrame) -> DataFrame:
    """Each turn's position in its conversation, and the states of the prefix
    that ends with it (``a``, ``b``) and of the one before (``pa``, ``pb``)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    rows = rows.select("conv_id", "turn", _half(F.col("digest"), 1).alias("a"), _half(F.col("digest"), 17).alias("b"), "chars")
    # equal rows can't be told apart, but can be dealt to different ranges
    rows = staged(rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id())), "turns")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("tie")]
    found = staged(_running(rows.repartitionByRange(*order).sortWithinPartitions(*order)), "running")
    # the last row of each task's last conversation, and whether the task holds no other: a row for each task
    ends = found.groupBy("task").agg(F.max_by(F.struct("conv_id", "pos", "a", "b", "opening"), F.struct("conv_id", "pos")).alias("last"), F.min("conv_id").alias("first")).orderBy("task").collect()
    carried: dict[int, tuple[int, int, int]] = {}
    conv, count, sums = None, 0, [0, 0]
    for r in ends:
        if r["first"] == conv:
            carried[r["task"]] = (count, *sums)
        else:
            count, sums = 0, [0, 0]
        last = r["last"]
        if not last["opening"]:
            count, sums = 0, [0, 0]
        conv = last["conv_id"]
        sums = [(s + pow(_BASE[i], count, 1 << 64) * last[n]) % (1 << 64) for i, (s, n) in enumerate(zip(sums, ("a", "b")))]
        count += last["pos"] + 1

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            task, opening = batch.column("task").to_numpy(), batch.column("opening").to_numpy(zero_copy_only=False)
            extra = np.zeros(batch.num_rows, np.int64)
            add = np.zeros((2, batch.num_rows), np.uint64)
            for t in np.unique(task).tolist():
                if t in carried:
                    mine = opening & (task == t)
                    extra[mine] = carried[t][0]
                    add[0][mine], add[1][mine] = carried[t][1:]
            state = [pa.array((_unsigned(batch, n) * _power(i, extra) + add[i]).view(np.int64)) for n, i in (("a", 0), ("b", 1), ("pa", 0), ("pb", 1))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(batch.column("pos").to_numpy() + extra), batch.column("chars"), *state], names=["conv_id", "pos", "chars", "a", "b", "pa", "pb"])

    return staged(found.mapInArrow(carry, f"conv_id long, {_STATE}"), "positions") if carried else found.drop("opening", "task")


# ------------------------------------------------------------ rebuilt conversations

def _moved(rows: DataFrame) -> DataFrame:
    """States of a conversation's own turns behind the turns that it takes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, own = (batch.column(n).to_numpy() for n in ("taken", "own"))
            out = []
            for n in ("a", "b", "pa", "pb"):
                which = 1 if n.endswith("b") else 0
                side = "ab"[which]
                scale = _power(which, (taken - own).astype(np.int64))
                out.append(pa.array((_unsigned(batch, f"head_{side}") + scale * (_unsigned(batch, n) - _unsigned(batch, f"cut_{side}"))).view(np.int64)))
            depth = batch.column("pos").to_numpy() - own + taken + 1
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(depth), batch.column("chars"), *out, pa.array(depth == batch.column("turns").to_numpy())],
                                             names=["conv_id", "depth", "chars", "a", "b", "pa", "pb", "ends"])

    return rows.mapInArrow(run, _PREFIX)


_PREFIX = "conv_id long, depth long, chars long, a long, b long, pa long, pb long, ends boolean"


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation: its depth, its last turn's
    code points, its state and its parent's, and whether it is all of it."""
    rows = positions(turns)
    own = shared(F.col("conv_id"))
    cut = F.max(F.when(F.col("pos") == own - 1, F.struct("a", "b")))
    convs = staged(rows.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"), cut.alias("cut")).withColumn("own", shared(F.col("conv_id"))), "conversations")
    state = F.struct("pos", "chars", "a", "b", "pa", "pb")
    heads = rows.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < MOST_SHARED - 1)).groupBy(F.col("conv_id").alias("source")).agg(F.array_sort(F.collect_list(state)).alias("heads"))
    info = convs.withColumn("source", F.col("conv_id") - F.col("conv_id") % BLOCK).join(heads, "source", "left")
    head = F.slice(F.coalesce("heads", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), F.col("own"))
    info = info.withColumn("head", head).withColumn("taken", F.size("head")).withColumn("turns", F.col("taken") + F.greatest(F.col("n") - F.col("own"), F.lit(0)))
    info = staged(info.select("conv_id", "own", "cut", "head", "taken", "turns"), "rebuilt")
    none = F.lit(0).cast("long")
    root = info.select("conv_id", none.alias("depth"), none.alias("chars"), *(none.alias(n) for n in ("a", "b", "pa", "pb")), (F.col("turns") == 0).alias("ends"))
    taken = info.select("conv_id", "turns", F.explode("head").alias("x")).select(
        "conv_id", (F.col("x.pos") + 1).alias("depth"), "x.chars", "x.a", "x.b", "x.pa", "x.pb", (F.col("x.pos") + 1 == F.col("turns")).alias("ends"))
    last = F.try_element_at("head", F.lit(-1))
    sums = [F.coalesce(x[n], none).alias(f"{k}_{n}") for k, x in (("head", last), ("cut", F.col("cut"))) for n in ("a", "b")]
    mine = rows.where(F.col("pos") >= own).join(info.select("conv_id", F.col("own").cast("long").alias("own"), F.col("taken").cast("long").alias("taken"), "turns", *sums), "conv_id")
    return root.unionByName(taken).unionByName(_moved(mine))


# ------------------------------------------------------------ contraction

_NODE, _PARENT = ["conv_id", "depth"], ["up_conv", "up_depth"]


def _coin(conv: Column, depth: Column, number: int) -> Column:
    """A bit of each node: of its depth, by which neighbours in a chain differ
    at first, or of a hash, by which some always do."""
    if number % 2:
        return F.shiftright(depth, number // 2) % 2 == 1
    return F.xxhash64(conv, depth, F.lit(number)) % 2 == 0


def subtree_totals(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """``conv_id, depth`` and, for each of ``weights``, its sum over the node's
    subtree, of ``nodes``: ``conv_id, depth``, the parent's ``up_conv,
    up_depth`` (null for the root of a tree) and weights."""
    edge = [f"{w}_edge" for w in weights]
    kids = nodes.where("up_conv IS NOT NULL").groupBy(*_PARENT).agg(F.count(F.lit(1)).alias("kids")).withColumnsRenamed(dict(zip(_PARENT, _NODE)))
    live = nodes.select(*_NODE, *_PARENT, *weights, *(F.lit(0).cast("long").alias(e) for e in edge)).join(kids, _NODE, "left").fillna(0, ["kids"])
    live = staged(live, "tree")
    raked, spliced = [], []
    for number in range(1, MOST_ROUNDS + 1):
        raked.append(live.where("kids = 0").select(*_NODE, *weights))
        leaf = F.col("kids") == 0
        below = live.where("up_conv IS NOT NULL").groupBy(*_PARENT).agg(
            *(F.sum(F.when(leaf, F.col(w) + F.col(e)).otherwise(0)).alias(f"{w}_in") for w, e in zip(weights, edge)),
            F.count_if(~leaf).alias("left"), F.min(F.when(~leaf, F.struct(*_NODE))).alias("kid")).withColumnsRenamed(dict(zip(_PARENT, _NODE)))
        grown = [(F.col(w) + F.col(f"{w}_in")).alias(w) for w in weights]
        rest = staged(live.where("kids > 0").join(below, _NODE).select(*_NODE, *_PARENT, *grown, *edge, F.col("left").alias("kids"), "kid"), "raked")
        if rest.isEmpty():
            break
        # a chain's node goes if its bit is set and its only child's isn't: no two neighbours do
        goes = F.col("up_conv").isNotNull() & (F.col("kids") == 1) & _coin(F.col("conv_id"), F.col("depth"), number) & ~_coin(F.col("kid.conv_id"), F.col("kid.depth"), number)
        goes = F.coalesce(goes, F.lit(False))
        gone = rest.where(goes).select(F.col("kid.conv_id").alias("conv_id"), F.col("kid.depth").alias("depth"), F.col("conv_id").alias("gone_conv"), F.col("depth").alias("gone_depth"),
                                       *(F.col(c).alias(f"new_{c}") for c in _PARENT), *((F.col(w) + F.col(e)).alias(f"{w}_gone") for w, e in zip(weights, edge)), *(F.col(w).alias(f"{w}_node") for w in weights))
        met = staged(rest.where(~goes).drop("kid").join(gone, _NODE, "left"), "compressed")
        was = F.col("gone_conv").isNotNull()
        spliced.append(met.where(was).select(F.col("gone_conv"), F.col("gone_depth"), *_NODE, *((F.col(f"{w}_node") + F.col(e)).alias(f"{w}_add") for w, e in zip(weights, edge))))
        live = met.select(*_NODE, *(F.when(was, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in _PARENT), *weights,
                          *((F.col(e) + F.coalesce(F.col(f"{w}_gone"), F.lit(0))).alias(e) for w, e in zip(weights, edge)), "kids")
    else:
        raise RuntimeError("the tree didn't contract: parents that are no nodes, or a cycle")
    # played back: a node spliced out in a round hangs above one that left in a later round
    known = raked[-1]
    for leaves, records in zip(reversed(raked[:-1]), reversed(spliced)):
        back = records.join(known, _NODE).select(F.col("gone_conv").alias("conv_id"), F.col("gone_depth").alias("depth"), *((F.col(w) + F.col(f"{w}_add")).alias(w) for w in weights))
        known = staged(known.unionByName(leaves).unionByName(back), "known")
    return known


# ------------------------------------------------------------ members that end

def end_digests(ends: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``conv_id, depth, digest`` of ``conv_id, depth, member`` rows: the
    SHA-256 of a node's members in ascending order, joined by commas."""
    order = ["conv_id", "depth", "member"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, least, parts, size = None, None, [], 0
        out: list[tuple] = []

        def close() -> None:
            nonlocal parts, size
            if parts:
                out.append((*node, least, ",".join(parts)))
            parts, size = [], 0

        for batch in batches:
            for conv, depth, member in zip(*(batch.column(n).to_pylist() for n in order)):
                if (conv, depth) != node or size >= chunk:
                    close()
                    node, least = (conv, depth), member
                parts.append(str(member))
                size += len(parts[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "least", "members"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "least", "members"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        out: list[tuple] = []
        for batch in batches:
            for conv, depth, members in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "depth", "members"))):
                if (conv, depth) != node:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256(members.encode())
                else:
                    state.update(b"," + members.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "depth", "digest"])
            out.clear()
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], names=["conv_id", "depth", "digest"])

    parts = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, "conv_id long, depth long, least long, members string")
    return parts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "least").mapInArrow(hashed, "conv_id long, depth long, digest string")


# ------------------------------------------------------------ the operator

def trie(turns: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations (rows of ``conv_id,
    turn, role, text``): ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``."""
    rows = staged(prefixes(turns.select("conv_id", "turn", "role", "text")), "prefixes")
    state = ["depth", "a", "b"]
    grouped = rows.groupBy(*state).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *(F.first(n).alias(n) for n in ("chars", "pa", "pb")))
    grouped = staged(grouped, "nodes")
    names = grouped.select(*state, "conv_id")
    ups = names.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("up_conv"))
    nodes = grouped.join(ups, ["depth", "pa", "pb"], "left").select("conv_id", "depth", "up_conv", F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"), "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    kids = nodes.where("up_conv IS NOT NULL").groupBy(*_PARENT).agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed(dict(zip(_PARENT, _NODE)))
    nodes = staged(nodes.join(kids, _NODE, "left").fillna(0, ["n_children"]), "trie")
    ends = rows.where("ends").select(*state, F.col("conv_id").alias("member")).join(names, state).select("conv_id", "depth", "member")
    totals = subtree_totals(nodes.select(*_NODE, *_PARENT, (F.col("n_children") == 0).cast("long").alias("leaves"), "saved"), ["leaves", "saved"])
    digests = staged(end_digests(staged(ends, "ends")), "digests")
    out = nodes.drop("saved").join(totals, _NODE).join(digests, _NODE, "left")
    return out.select("conv_id", "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13(spark, sf_dir: str) -> DataFrame:
    """The prefix trie of ``conversations``."""
    return trie(read(spark, sf_dir, "conversations"))


#: The same by SQL. CRC-32 is worked out bit by bit, and a prefix is the digests of its turns in a row.
OP13_SQL = """WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce("text", '') AS txt,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, "text") - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (SELECT conv_id, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda s, b: list_reduce(list_prepend(xor(s, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda u, z: xor(u >> 1, (u & 1) * 3988292384))), 4294967295) % 6 AS h FROM n),
k AS (SELECT c.conv_id, c.h, least(c.h, coalesce(s.n, 0)) AS taken FROM c LEFT JOIN n s ON s.conv_id = c.conv_id - c.conv_id % 100),
r AS (SELECT k.conv_id, s.pos + 1 AS d, s.role, s.txt FROM k JOIN t s ON s.conv_id = k.conv_id - k.conv_id % 100 AND s.pos < k.h
      UNION ALL SELECT k.conv_id, t.pos - k.h + k.taken + 1, t.role, t.txt FROM k JOIN t ON t.conv_id = k.conv_id AND t.pos >= k.h),
p AS (SELECT conv_id, d, txt, string_agg(sha256(length(role) || ':' || role || txt), '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM r
      UNION ALL SELECT conv_id, 0, '', '' FROM c),
m AS (SELECT conv_id, max(d) AS n FROM p GROUP BY conv_id),
nodes AS MATERIALIZED (SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * (CASE WHEN d = 0 THEN 0 ELSE any_value(length(txt)) END) AS saved,
      coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends FROM p JOIN m USING (conv_id) GROUP BY d, path),
kids AS (SELECT d - 1 AS d, left(path, CAST(d - 1 AS BIGINT) * 64) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
above AS (SELECT unnest(range(0, d + 1)) AS g, path, saved, kids.path IS NULL AS leaf FROM nodes LEFT JOIN kids USING (d, path)),
totals AS (SELECT g AS d, left(path, CAST(g AS BIGINT) * 64) AS path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1, 2)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, x.n_convs, coalesce(kids.n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN totals USING (d, path) LEFT JOIN kids USING (d, path) LEFT JOIN nodes up ON up.d = x.d - 1 AND up.path = left(x.path, CAST(x.d - 1 AS BIGINT) * 64)"""
