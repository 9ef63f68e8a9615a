"""Idempotent, incremental ingestion: insert the rows whose key is not there yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.config import EVENT_DATE, INGESTION_SCHEMA
from fleetlens.operators.dedup import dedup_latest
from fleetlens.sources.tables import append_history, read_table, table_exists


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of `batch` that an insert-only merge on `keys` would add to `target`.

    A null key equals nothing, so such rows are always new. They bypass the join: an equi-join
    would send them all to one task.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    present = target.where(complete).select(*keys)
    return batch.where(complete).join(present, list(keys), "left_anti").unionByName(batch.where(~complete))


def within_batch_dates(target: DataFrame, batch: DataFrame, date: str = EVENT_DATE) -> DataFrame:
    """The part of `target`, which is partitioned by `date`, that `batch` can collide with.

    The dates of the batch (a number of days, whatever its rows) become a condition on the
    partition column, so other partitions are not even listed.
    """
    dates = [r[0] for r in batch.select(date).distinct().collect()]
    known = F.col(date).isin([d for d in dates if d is not None])
    return target.where(known | F.col(date).isNull() if None in dates else known)


def merge_new_only(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`target` as it stands after the insert-only merge of `batch`."""
    return target.unionByName(new_rows(target, batch, keys))


def replayed(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of `batch` without a whole key that `target` does not hold already, column by column.

    A null key equals nothing, so a merge on keys would add such a row again whenever its batch is
    repeated. Rows are compared as a whole, without what ingestion stamped on them; that also
    spreads them, as no two different rows share a key. They meet by a number, the hash of the row, and
    are then compared column by column: structs as join keys are built anew for each of their fields.
    """
    stamps = {*INGESTION_SCHEMA.fieldNames(), EVENT_DATE}
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    columns = [c for c in batch.columns if c not in stamps]
    present = target.where(~complete).select(*columns).distinct().alias("__present")
    ours, theirs = [F.col(f"__batch.{c}") for c in columns], [F.col(f"__present.{c}") for c in columns]
    numbers = F.xxhash64(*[c.cast(target.schema[n].dataType) for n, c in zip(columns, ours)]) == F.xxhash64(*theirs)
    # a number of equal columns, not a conjunction, which would make a join key of each column
    equal = reduce(add, [c.eqNullSafe(other).cast("int") for c, other in zip(ours, theirs)]) == len(columns)
    return batch.where(~complete).alias("__batch").join(present, numbers & equal, "left_anti")


def upsert_new_only(
    name: str, batch: DataFrame, keys: Sequence[str], time: str | None = None, partition_by: Sequence[str] = ("ingestion_date",)
) -> None:
    """Appends the new rows of `batch`, de-duplicated, to the stored table `name`, or creates it.

    With `time` the table is partitioned by the day of that column, and only the days of the
    batch are compared. Running the same batch again adds nothing, rows with a null key included. Each
    append commits as a whole; two writers that run at the same time could both see a key as absent,
    so one writer per table is assumed. Rows are written in ranges of day and key: a task meets few days,
    so files grow with days plus tasks, not with their product, and a crowded day is several tasks' work.
    """
    spark = batch.sparkSession
    if time is not None:
        batch, partition_by = batch.withColumn(EVENT_DATE, F.to_date(time)), (EVENT_DATE,)

    def append(rows: DataFrame) -> None:
        append_history(rows if time is None else rows.repartitionByRange(EVENT_DATE, *keys), name, partition_by)

    candidates = dedup_latest(batch, keys)
    if not table_exists(spark, name):
        append(candidates)
        return
    # the comparison is with the table's current files, so they must be listed afresh
    if "/" not in name:
        spark.catalog.refreshTable(name)
    stored = read_table(spark, name)
    target = stored if time is None else within_batch_dates(stored, batch)
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    added = new_rows(target, candidates.where(complete), keys).unionByName(replayed(target, candidates, keys))
    append(added.select(*stored.columns))
