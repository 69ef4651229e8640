"""Request validation on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.forecast import DEFAULT_HORIZON, MAX_HORIZON, check_requests, split_checked
from .tables import batch_folder, checkpoint_beside


def validate_stream(
    stream: DataFrame,
    ok_path: str,
    bad_path: str,
    checkpoint: str | None = None,
    default_horizon: int = DEFAULT_HORIZON,
    base_date: str | None = None,
    once: bool = False,
    every: str = "1 minute",
    max_horizon: int = MAX_HORIZON,
) -> StreamingQuery:
    """Write good requests and quarantined ones to their tables, one folder per batch.

    Unless a checkpoint is named, it stands beside the table of good requests; a restart goes on from it.
    """
    checked = check_requests(stream, default_horizon, base_date, max_horizon)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_checked(batch)
            good.write.mode("overwrite").parquet(batch_folder(ok_path, batch_id))
            bad.write.mode("overwrite").parquet(batch_folder(bad_path, batch_id))
        finally:
            batch.unpersist()

    writer = checked.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or checkpoint_beside(ok_path)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
