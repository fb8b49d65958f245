"""Session settings the operators rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even if a later step then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # stream state beyond executor memory
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# shuffle files go when the step that made them ends, not when the driver collects its garbage
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPLIT = "spark.sql.files.maxPartitionBytes"
# a byte of compressed lines gives about ten of text, so a task takes an eighth of the default
COMPRESSED_SPLIT = 16 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing stays with the caller."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def draining(spark: SparkSession) -> Iterator[None]:
    """Settings under which compressed raw files are landed and drained; the caller's are back afterwards."""
    before = {key: spark.conf.get(key, None) for key in (TIDY, SPLIT)}
    split = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SPLIT))
    spark.conf.set(TIDY, "true")
    spark.conf.set(SPLIT, str(min(split, COMPRESSED_SPLIT)))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables: the one ``spark.checkpoint.dir`` names.

    All executors must share it, so a cluster has to name one. A session on one
    machine that names none gets a folder that is removed when the process ends.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows as a table in the shared folder: lineage is cut and lost executors cost nothing."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tidemark-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
