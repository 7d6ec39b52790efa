"""Session defaults and the place where long lineages are cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this library wants; none is size-specific.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Narrow rows take some ten times their shuffled bytes when they are sorted or hashed, several times in a task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # A hot join key is split over tasks even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM interprets methods beyond 8000 bytes of code: long projections are split instead of fused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", app: str = "cleanroom", **conf) -> SparkSession:
    """A session for tests and single-node benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Paths of the intermediate tables of the scratch blocks that are open.
_open_scratch: list[list[str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it.

    Only a local session without the setting gets one: in its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/intermediate"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back.

    The returned frame has a one-step lineage, so a lost executor costs a
    re-read and not a recomputation, and its true size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _open_scratch:
        _open_scratch[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the intermediate tables that were settled inside it.

    What is lazy must be written by then.
    """
    paths: list[str] = []
    _open_scratch.append(paths)
    try:
        yield
    finally:
        _open_scratch.pop()
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
