"""Stream ends: a folder of Parquet files read as it grows, and an append-only table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType



def read_log_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    files_per_trigger: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """Rows of the Parquet files below ``path``, present and future."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def append_table(
    stream: DataFrame, path: str, checkpoint: str | None = None, once: bool = False, every: str = "1 minute"
) -> StreamingQuery:
    """Append finished rows to a Parquet table; ``once`` drains what is there and stops.

    Unless one is named, the checkpoint stands beside the table, so that a restart goes on
    where the last run ended: the sink skips batches that it has already written.

    The file sink lists its files per batch, so a batch that is run again after a lost
    executor adds nothing twice.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or checkpoint_beside(path))
        .option("path", path)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def checkpoint_beside(path: str) -> str:
    """Where a stream into ``path`` keeps its progress when no place is named."""
    return f"{path.rstrip('/')}_checkpoint"


def batch_folder(path: str, batch_id: int) -> str:
    """One folder per batch, overwritten when the batch is run again."""
    return f"{path.rstrip('/')}/batch={batch_id}"
