"""Continuous form of the incremental load: each micro-batch of a change
stream is loaded with the same dispatcher as a scheduled run (create on the
first batch, upsert by key afterwards).

A micro-batch may hold several changes of one key: the one with the greatest
value of the ``version`` column is loaded (of equal versions any one). Rows
with a null key match nothing and are all loaded.

``foreachBatch`` may replay an epoch after a failure; the upsert is
idempotent (the same batch applied twice gives the result of applying it
once), which is the property the scheduled run's one-day overlap relies on.
The stream's checkpoint goes under the session's shared checkpoint folder
unless a location is given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.validate import any_null, col
from ..plans.load import load_into
from ..session import scratch_path


def latest(changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The latest change of each key, by partial aggregation: a hot key is one
    row per task before it is shuffled."""
    row = F.struct(*[col(c) for c in changes.columns])
    keyed = changes.where(~any_null(keys)).groupBy(*[col(k) for k in keys]).agg(F.max_by(row, col(version)).alias("_row"))
    return keyed.select("_row.*").unionByName(changes.where(any_null(keys)))


def upsert_stream(changes: DataFrame, target: str, keys: Sequence[str] | Mapping[str, str], *,
                  version: str, checkpoint_location: str | None = None, root: str | None = None,
                  trigger: dict | None = None, **load_options) -> StreamingQuery:
    """``load_options`` go to :func:`load_into` for every micro-batch
    (``partition_by``, ``cluster_by``, ``check_unique``, ``retain_snapshots``…)."""
    spark = changes.sparkSession
    location = checkpoint_location or scratch_path(spark, "streams", target.replace(".", "_"))

    def each(batch: DataFrame, epoch_id: int) -> None:
        names = list(keys) if not isinstance(keys, str) else [keys]
        load_into(batch.sparkSession, latest(batch, names, version), target, keys, root=root, **load_options)

    writer = changes.writeStream.foreachBatch(each).option("checkpointLocation", location)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def upsert_available(changes: DataFrame, target: str, keys: Sequence[str] | Mapping[str, str], *,
                     version: str, checkpoint_location: str | None = None, root: str | None = None,
                     **load_options) -> None:
    """Upsert everything the change stream has now, then stop. Micro-batches
    run in a cloned session, so the caller's cached view of ``target`` is
    refreshed afterwards."""
    query = upsert_stream(changes, target, keys, version=version, checkpoint_location=checkpoint_location,
                          root=root, trigger={"availableNow": True}, **load_options)
    query.awaitTermination()
    changes.sparkSession.catalog.refreshTable(target)
