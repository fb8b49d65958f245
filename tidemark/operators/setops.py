"""Unions and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all_entities(frames: dict[str, DataFrame], quarantine: DataFrame | None = None, name: str = "entity") -> DataFrame:
    """Reads of several entities in one frame; entities listed in ``quarantine`` are left out.

    Only names that are among ``frames`` are read back, so a failed entity is
    not even scanned.
    """
    failed: set[str] = set()
    if quarantine is not None:
        listed = quarantine.where(F.col(name).isin(*frames)).select(name).distinct()
        failed = {r[name] for r in listed.limit(len(frames)).collect()}
    tagged = [df.withColumn(name, F.lit(k)) for k, df in frames.items() if k not in failed]
    if not tagged:
        raise ValueError("every entity is in quarantine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_changes(main: DataFrame, deletes: DataFrame, flag: str = "_deleted") -> DataFrame:
    """Changed rows and tombstones in one frame, told apart by ``flag``."""
    return main.withColumn(flag, F.lit(False)).unionByName(
        deletes.withColumn(flag, F.lit(True)), allowMissingColumns=True
    )


def field_difference(declared: DataFrame, actual: DataFrame, path: str = "path") -> DataFrame:
    """Each field path and where it is: ``both``, ``declared_only`` or ``actual_only``."""
    left = declared.select(path).distinct().withColumn("_d", F.lit(True))
    right = actual.select(path).distinct().withColumn("_a", F.lit(True))
    return left.join(right, path, "full_outer").select(
        path,
        F.when(F.col("_d") & F.col("_a"), "both").when(F.col("_d"), "declared_only").otherwise("actual_only").alias("status"),
    )
