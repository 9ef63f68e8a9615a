"""Named tables and parquet paths behind one interface."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet path when the name contains a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether there is anything to read under `name`; an empty folder is nothing."""
    if "/" not in name:
        return spark.catalog.tableExists(name)
    try:
        spark.read.parquet(name)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def create_partitioned_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = ("ingestion_date",),
    comment: str = "",
    provider: str = "parquet",
) -> None:
    """Idempotent DDL. A transactional provider can be named where its jars are installed."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    note = comment.replace("'", "''")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider} "
        f"PARTITIONED BY ({parts}) COMMENT '{note}'"
    )


def write_overwrite(df: DataFrame, name: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Full refresh; the stored schema becomes that of `df`.

    `cluster_by` range-partitions before the write: files then cover narrow key ranges, which
    lets later readers skip row groups, and a crowded key spreads over several files.
    """
    out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(name) if "/" in name else writer.format("parquet").saveAsTable(name)


def append_history(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Adds rows; the table is created by the first call."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(name) if "/" in name else writer.format("parquet").saveAsTable(name)


def changes_since(df: DataFrame, batch_ids: Sequence[str] | str) -> DataFrame:
    """Rows that the given batches added."""
    wanted = [batch_ids] if isinstance(batch_ids, str) else list(batch_ids)
    return df.where(F.col("batch_id").isin(wanted))
