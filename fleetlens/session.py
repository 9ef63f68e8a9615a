"""Session settings that suit these plans on any cluster size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Wide projections compile to methods beyond 8000 bytes, which the JVM never JIT-compiles.
    # Above this limit Spark splits them into small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}


_DEFAULT_METHOD_LIMIT = "65535"


def tune(spark: SparkSession) -> SparkSession:
    """Applies the method limit to a session somebody else built, unless it was set there."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == _DEFAULT_METHOD_LIMIT:
        spark.conf.set(limit, SETTINGS[limit])
    return spark


_LOCAL_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver see: `spark.checkpoint.dir` of the session.

    Only a session on one machine may do without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="checkpoint-"))
    return _LOCAL_FOLDER[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Stores an intermediate result that several branches of a plan read, in the shared folder.

    A table of Parquet files: what reads it prunes columns and never depends on an executor that is gone.
    """
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(
    cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g", name: str = "fleetlens", **settings: str
) -> SparkSession:
    """A session on this machine, `settings` being further options with `__` for dots."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory).getOrCreate()
    )
