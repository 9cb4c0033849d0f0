"""The monitoring run as an incremental stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docmonitor.params import RunParams
from docmonitor.plans.monitor import run_monitor
from docmonitor.sources import state as store


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def stream_monitor(
    files: DataFrame,
    members: DataFrame | Callable[[DataFrame], DataFrame],
    params: RunParams,
    root: str,
    clock: Callable[[], dt.datetime] = _now,
    **trigger,
) -> StreamingQuery:
    """Every micro-batch of ``files`` is one run against the state under ``root``.

    ``files`` is a streaming table of file rows; ``members`` the archive listing,
    or a function of the micro-batch that gives it.  By default takes all there
    is and stops, which is what an hourly or daily schedule calls; pass
    ``processingTime="1 minute"`` to keep going.  A micro-batch replayed after a
    failure has the same id, so its run is skipped or repeated as a whole, with the time
    it was first begun.  Ids count within the checkpoint: a new one (or none, for runs
    outside the stream) is another source, so nothing is taken for done that isn't.
    ``clock`` gives the time of a micro-batch (UTC, without zone).
    """
    checkpoint = f"{root}/stream"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        source = spark.read.json(f"{checkpoint}/metadata").first()["id"]  # the checkpoint's own id
        begun = store.started_at(spark, root, batch_id, source, clock())
        listing = members(batch) if callable(members) else members
        run_monitor(batch, listing, replace(params, run_ts=begun), root, batch_id, source)

    return (
        files.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
