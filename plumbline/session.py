"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should have too; all are runtime or builder settings of Spark itself.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "8", name: str = "plumbline", memory: str = "12g", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name).config("spark.driver.memory", memory)
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": cores, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is written inside the block."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# A task that sorts or holds whole documents reads so much of its compressed input that this stays in memory.
SMALL_TASKS = {"spark.sql.files.maxPartitionBytes": "4m"}

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, below ``spark.checkpoint.dir``.

    The cluster names a shared folder in that setting. Only a local master, where driver and executors are one
    process, may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/plumbline/{sc.applicationId}"
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="plumbline-")
    return _local_roots[sc.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch folder that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def mounted_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that any process opens at this path, or none if Hadoop does not take it for a mounted file system."""
    sc = spark.sparkContext
    of = sc._jvm.org.apache.hadoop.fs.Path(path)
    uri = of.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(of).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back, so that later steps do not go back to what made the rows."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
