"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Settings the results or the skew handling depend on. All can be changed on a running session.
RUNTIME = {
    # ReviewTime becomes a day string, which depends on the zone.
    "spark.sql.session.timeZone": "UTC",
    # The fact spells its key MealID, the meal list mealID.
    "spark.sql.caseSensitive": "false",
    "spark.sql.ansi.enabled": "true",
    # The driver keeps the text of every plan that ran: long plans by the hundred fill it.
    "spark.sql.maxPlanStringLength": "50000",
    # 10,000 long texts make a batch of tens of MB, of which the JVM and every Python worker hold copies.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A third of all rows may share one key: split such partitions, even where the
    # split costs one more shuffle for the operator above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(
    app: str, master: str | None = None, shuffle_partitions: int | None = None, hive: bool = False
) -> SparkSession:
    """Create a session. Cluster, memory and shuffle size come from spark-submit unless given here.

    ``hive`` keeps the catalog in the cluster's metastore, so that one job finds another's tables.
    """
    builder = SparkSession.builder.appName(app)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def staging_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, reachable by every executor.

    Only a local session without that setting gets a temporary folder of its own; on a cluster a
    folder of one machine would lose data with the machine, so the setting is required there.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = context.getCheckpointDir() or tempfile.mkdtemp(prefix="platewise-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


_scopes: list[str] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside the block is deleted at its end; read results before that."""
    _scopes.append(f"scope-{uuid.uuid4().hex}")
    path = _folder(spark)
    try:
        yield
    finally:
        _scopes.pop()
        _delete(spark, path)


def _folder(spark: SparkSession) -> str:
    return "/".join([staging_root(spark).rstrip("/"), spark.sparkContext.applicationId, *_scopes])


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the staging root."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors, fixes values that a recomputation could
    change (row numbers of a range partitioning), and gives later joins real file sizes, so that
    a side is broadcast only when it is known to be small. ``schema`` reads it under other types of
    the same stored form.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def stage_by(df: DataFrame, column: str, label: str) -> DataFrame:
    """Stage in one folder per value of ``column``, so that a filter on it reads its folder only."""
    path = staged_path(df.sparkSession, label)
    df.write.partitionBy(column).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counting(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with its rows, and further sums by name, observed when it is written.

    ``Observation.get`` has them after the write, which saves a scan of what was written.
    """
    seen = Observation()
    return df.observe(seen, F.count("*").alias("rows"), *(value.alias(name) for name, value in counts.items())), seen


def in_fixed_order(df: DataFrame, partitions: int, key: str, *more: str) -> DataFrame:
    """Rows dealt by ``key`` to a number of partitions that is the caller's choice, and sorted there.

    For work whose result depends on partitions or order, as sampling does: it is then the same on
    every cluster and however the rows were read. Together the columns should be unique.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key, *more)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged."""
    _delete(spark, f"{staging_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
