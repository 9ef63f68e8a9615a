"""Continuous arrival of files into Bronze, one idempotent merge per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetlens.functions.shaping import stamp_ingestion
from fleetlens.operators.ingest import upsert_new_only


def ingest_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    time: str | None = None,
    as_of: datetime | None = None,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Takes in all parquet files that `source` has gained, then stops.

    A micro-batch repeated after a failure carries the same id and meets its own rows in the
    target, so it adds nothing twice. `checkpoint` must be on storage all executors share.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stamped = stamp_ingestion(batch, f"stream-{batch_id}", source, as_of)
        upsert_new_only(target, stamped, keys, time)

    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    return arriving.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
