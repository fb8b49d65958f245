"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpoint_dir, configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Zoned times as plain UTC times and decimals as doubles."""
    cols = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def scratch(spark: SparkSession) -> str:
    """A fresh folder for one run under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def generation(df: DataFrame) -> DataFrame:
    """A target generation: written once, then read like any table."""
    path = f"{scratch(df.sparkSession)}/gen"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return plain(fn(Tables(spark, folder)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register
