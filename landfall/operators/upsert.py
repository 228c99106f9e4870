"""Upsert by primary key, as a pure ``DataFrame x DataFrame -> DataFrame`` operator.

Semantics (the two clauses of a key merge): a source row whose key matches a
target row replaces it (update all columns); a source row with no match is
inserted; target rows with no match stay; nothing is deleted. Keys compare
with ``=``, so a NULL in any key column never matches: such a source row is
inserted on every run and such a target row always stays.

Plan shape, chosen for a large target and a comparatively small batch:

* ``kept = target[keys not null] LEFT ANTI JOIN batch_keys`` — the target is
  streamed once. When the batch's row count is known and its key set fits the
  broadcast budget, the batch keys are broadcast, so the target is **never
  shuffled**. When only a bitmap of their hashes fits (16 bits a batch row, so
  some twenty times as many rows), that is broadcast instead: target rows that
  miss it can match nothing and pass **unshuffled**, and the few others are
  joined exactly. Beyond that, Spark plans a sort-merge anti join (AQE may
  still switch strategy from runtime sizes, and splits skewed partitions).
* target rows with a NULL key cannot match anything; on the shuffle path
  they bypass the join instead of all hashing to one reducer (a skew trap
  when many keys are NULL). The broadcast path has no reducers, so it reads
  the target once and lets the anti join keep them.
* ``result = kept UNION ALL null_key_rows UNION ALL batch`` — no second join,
  no scan of the target's keys to find inserts.

Two source rows for one target row make a merge ambiguous: ``check_unique``
rejects them (loads always check their staged batch unless told not to).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .validate import any_null, assert_unique, col

CONF_BROADCAST_BYTES = "landfall.upsert.broadcastMaxBytes"
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
CONF_BITMAP = "landfall.upsert.bitmap"
#: Bits of the bitmap to a batch row (one in so many target rows that match
#: nothing is joined all the same), and bits of each of its pieces.
BITMAP_BITS, BITMAP_PIECE = 16, 32768
#: A target at least so many times the batch's size is worth reading twice.
BITMAP_RATIO = 4
# Per-row overhead of a hashed key row beyond the raw field sizes, and the
# extra bytes a variable-width field takes in a row (offset/length + padding).
_ROW_OVERHEAD = 16
_VAR_FIELD_OVERHEAD = 16

Keys = Sequence[str] | Mapping[str, str] | str


_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
                "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def _width(dtype) -> int | None:
    name = dtype.simpleString()
    if name in _FIXED_WIDTH:
        return _FIXED_WIDTH[name]
    if name.startswith("decimal"):
        return 16
    return None  # variable width (string, binary, nested)


def variable_key_bytes(keys_df: DataFrame) -> dict[str, Column]:
    """Aggregates summing the byte length of each variable-width key column
    (to observe while the batch is written, see :func:`key_bytes`)."""
    return {f"bytes_{f.name}": F.sum(F.octet_length(col(f.name).cast("string")))
            for f in keys_df.schema.fields if _width(f.dataType) is None}


def key_bytes(keys_df: DataFrame, n_rows: int, measured: dict | None = None) -> int:
    """Size estimate of a key set: exact field widths for fixed-width types;
    for variable-width keys the actual byte lengths are summed over the set
    (``measured``, from :func:`variable_key_bytes` observed earlier, or one
    aggregate over the key columns only)."""
    fixed, variable = 0, []
    for f in keys_df.schema.fields:
        w = _width(f.dataType)
        if w is None:
            variable.append(f.name)
        else:
            fixed += w
    # a variable-width field also takes an offset/length word and padding
    total = n_rows * (_ROW_OVERHEAD + fixed + _VAR_FIELD_OVERHEAD * len(variable))
    if variable and n_rows:
        if measured is not None and all(f"bytes_{c}" in measured for c in variable):
            total += sum(int(measured[f"bytes_{c}"] or 0) for c in variable)
        else:
            agg = keys_df.agg(*[F.sum(F.octet_length(col(c).cast("string"))).alias(f"b{i}")
                                for i, c in enumerate(variable)]).first()
            total += sum(int(agg[f"b{i}"] or 0) for i in range(len(variable)))
    return total


def broadcast_budget(spark) -> int:
    return int(spark.conf.get(CONF_BROADCAST_BYTES, str(DEFAULT_BROADCAST_BYTES)))


def fits_broadcast(df: DataFrame, n_rows: int | None, measured: dict | None = None,
                   budget: int | None = None) -> bool:
    """True when ``df`` (``n_rows`` rows, exact) is within the broadcast budget
    (by default the session's)."""
    if n_rows is None:
        return False
    budget = broadcast_budget(df.sparkSession) if budget is None else budget
    if n_rows * _ROW_OVERHEAD > budget:  # too big before looking at the fields
        return False
    return key_bytes(df, n_rows, measured) <= budget


def small_side(df: DataFrame, n_rows: int | None) -> DataFrame:
    """Broadcast ``df`` only when its exact row count is known and its
    measured size is within the budget; otherwise leave the choice to the
    planner (sort-merge, or AQE's runtime conversion from measured sizes)."""
    return F.broadcast(df) if fits_broadcast(df, n_rows) else df


def normalize_keys(source: DataFrame, keys: Keys) -> tuple[DataFrame, list[str]]:
    """A ``{source_col: target_col}`` map renames the source key columns to the
    target's names, so that update-all / insert-all line up by name."""
    if isinstance(keys, str):
        return source, [keys]
    if isinstance(keys, Mapping):
        return source.withColumnsRenamed(dict(keys)), list(keys.values())
    keys = list(keys)
    if not keys:
        raise ValueError("an upsert needs at least one key column")
    return source, keys


def strict_cast(c: Column, dtype) -> Column:
    """Cast that raises on a value it cannot convert (as a table insert does),
    instead of turning it into NULL when the session is not in ANSI mode."""
    converted = c.try_cast(dtype)
    return F.when(c.isNotNull() & converted.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot store as {dtype.simpleString()}: "),
                                         c.cast("string")))).otherwise(converted).cast(dtype)


def extra_columns(target: DataFrame, source: DataFrame) -> list[str]:
    """Columns that only the source has, compared case-insensitively."""
    held = {c.lower() for c in target.columns}
    return [c for c in source.columns if c.lower() not in held]


def align_to_target(target: DataFrame, source: DataFrame) -> DataFrame:
    """Source columns in the target's order and types (a merge writes target
    types), names compared case-insensitively. Columns that the target lacks
    are left out, so a source that grows a column keeps loading; a column that
    the source lacks raises."""
    s_names = {c.lower(): c for c in source.columns}
    missing = [c for c in target.columns if c.lower() not in s_names]
    if missing:
        raise ValueError(f"the source lacks columns of the target: {missing}")
    s_types = {f.name.lower(): f.dataType for f in source.schema.fields}
    cols = []
    for f in target.schema.fields:
        c = col(s_names[f.name.lower()])
        if s_types[f.name.lower()] != f.dataType:
            c = strict_cast(c, f.dataType)
        cols.append(c.alias(f.name))
    return source.select(*cols)


def _plan_bytes(df: DataFrame) -> int:
    """Spark's estimate of a frame's size (file sizes, for a scan of files)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _bit_of(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(bits))


def key_bitmap(batch_keys: DataFrame, keys: Sequence[str], n_rows: int) -> tuple[DataFrame, int]:
    """The bitmap of the hashes of ``n_rows`` keys, in pieces ``(piece, words)``
    of 64-bit words, and its number of bits."""
    bits = -(-max(1, n_rows) * BITMAP_BITS // BITMAP_PIECE) * BITMAP_PIECE
    at = batch_keys.select(_bit_of(keys, bits).alias("at"))
    pieces = (at.groupBy(F.expr(f"at DIV {BITMAP_PIECE}").alias("piece"))
                .agg(F.bitmap_construct_agg(F.col("at") % BITMAP_PIECE).alias("bitmap")))
    # eight bytes, the first one first, as a word
    word = lambda i: F.conv(F.hex(F.substring("bitmap", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    places = F.sequence(F.lit(0), F.lit(BITMAP_PIECE // 64 - 1))
    return pieces.select("piece", F.transform(places, word).alias("words")), bits


def split_by_bitmap(target: DataFrame, batch_keys: DataFrame, keys: Sequence[str],
                    n_rows: int) -> tuple[DataFrame, DataFrame]:
    """``target`` rows that may match a batch key, and those that cannot (NULL
    keys among them). Both read the target; neither shuffles it. The bitmap is
    broadcast: see that it fits first."""
    pieces, bits = key_bitmap(batch_keys, keys, n_rows)
    at, piece, words = (f"_{n}_{uuid.uuid4().hex[:8]}" for n in ("at", "piece", "words"))
    pieces = pieces.select(F.col("piece").alias(piece), F.col("words").alias(words))
    seen = (target.withColumn(at, _bit_of(keys, bits))
                  .join(F.broadcast(pieces), F.expr(f"`{at}` DIV {BITMAP_PIECE}") == F.col(piece), "left"))
    word = F.get(F.col(words), F.expr(f"CAST((`{at}` % {BITMAP_PIECE}) DIV 64 AS INT)"))
    shift = F.expr(f"CAST((7 - (`{at}` % 64) DIV 8) * 8 + `{at}` % 8 AS INT)")
    is_set = F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1).cast("bigint")) == 1
    hit = F.coalesce(~any_null(keys) & is_set, F.lit(False))
    columns = [col(c) for c in target.columns]
    return seen.where(hit).select(*columns), seen.where(~hit).select(*columns)


def kept_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
              source_rows: int | None = None, measured: dict | None = None,
              broadcast_bytes: int | None = None) -> DataFrame:
    """The target rows an upsert keeps: those whose key is not in ``source``
    (target NULL keys included: they match nothing). ``measured``: key byte
    sums observed when the batch was written (saves a pass for string keys).
    ``broadcast_bytes``: the budget, if not the session's."""
    nulls = any_null(keys)
    batch_keys = source.select(*[col(k) for k in keys]).where(~nulls)
    target_cols = [col(c) for c in target.columns]
    if fits_broadcast(batch_keys, source_rows, measured, broadcast_bytes):
        # no shuffle, so NULL keys cannot pile up anywhere: one pass over the
        # target (an anti join keeps NULL-key rows, they match nothing)
        return target.join(F.broadcast(batch_keys), keys, "left_anti").select(*target_cols)
    spark = target.sparkSession
    budget = broadcast_budget(spark) if broadcast_bytes is None else broadcast_bytes
    wanted = spark.conf.get(CONF_BITMAP, "true").lower() == "true"
    fits = source_rows is not None and (source_rows * BITMAP_BITS + BITMAP_PIECE) // 8 <= budget
    if wanted and fits and _plan_bytes(target) >= BITMAP_RATIO * _plan_bytes(source):
        maybe, kept = split_by_bitmap(target, batch_keys, keys, source_rows)
        return kept.unionByName(maybe.join(batch_keys, keys, "left_anti").select(*target_cols))
    # shuffle join: NULL-key rows bypass it instead of all hashing to one reducer
    kept = target.where(~nulls).join(batch_keys, keys, "left_anti").select(*target_cols)
    return kept.unionByName(target.where(nulls))


def upsert(target: DataFrame, source: DataFrame, keys: Keys, *,
           source_rows: int | None = None, check_unique: bool = False,
           broadcast_bytes: int | None = None) -> DataFrame:
    """The target's rows after merging ``source`` into it by ``keys``.

    ``source_rows``: exact row count of ``source`` if known (e.g. from a staged
    batch); enables the size-checked broadcast of the batch keys, or of a
    bitmap of them (``broadcast_bytes``: the budget, if not the session's).
    ``check_unique`` runs ``source`` once to reject repeated keys before the
    lazy result is built, so it is for a source that is staged.
    """
    source, keys = normalize_keys(source, keys)
    source = align_to_target(target, source)
    if check_unique:
        assert_unique(source, keys)
    kept = kept_rows(target, source, keys, source_rows=source_rows, broadcast_bytes=broadcast_bytes)
    return kept.unionByName(source)


def merge_actions(target: DataFrame, source: DataFrame, keys: Keys, *,
                  source_rows: int | None = None) -> DataFrame:
    """Each source row's key with the clause it falls under: ``update`` when
    the key is present in the target, else ``insert``.

    The target contributes only its key columns, probed against the
    (size-checked, broadcast) batch keys, so it is not shuffled; the matched
    set is bounded by the batch size."""
    source, keys = normalize_keys(source, keys)
    t_types = {f.name.lower(): f.dataType for f in target.schema.fields}
    src = source.select(*[strict_cast(col(k), t_types[k.lower()]).alias(k) for k in keys])
    nulls = any_null(keys)
    probe = src.where(~nulls)
    # matched keys are a subset of the batch keys: the batch's measured size
    # bounds both broadcasts
    small = fits_broadcast(probe, source_rows)
    matched = (target.select(*[col(k) for k in keys])
                     .join(F.broadcast(probe) if small else probe, keys, "left_semi")
                     .distinct()
                     .withColumn("_hit", F.lit(True)))
    keyed = (probe.join(F.broadcast(matched) if small else matched, keys, "left")
                  .select(*[col(k) for k in keys], F.when(F.col("_hit"), F.lit("update"))
                                  .otherwise(F.lit("insert")).alias("action")))
    null_keyed = src.where(nulls).select(*[col(k) for k in keys],
                                         F.lit("insert").alias("action"))
    return keyed.unionByName(null_keyed)


def merge_action_counts(target: DataFrame, source: DataFrame, keys: Keys, *,
                        source_rows: int | None = None) -> DataFrame:
    """``(action, n)``: how many source rows update and how many insert."""
    return (merge_actions(target, source, keys, source_rows=source_rows)
            .groupBy("action").agg(F.count(F.lit(1)).alias("n")))
