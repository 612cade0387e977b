"""Global numbering and per-key ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.session import cut_lineage


def dense_index(
    df: DataFrame, order: str, name: str, first: int = 0, tie: str | None = None
) -> DataFrame:
    """Number all rows 0..n-1 (plus ``first``) in ``order`` without a single-task sort.

    Rows are range partitioned, numbered inside each partition, and shifted by
    the sizes of the partitions before theirs: one small row per partition.
    """
    keys = [order] + ([tie] if tie else [])
    placed = cut_lineage(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    )
    sizes = placed.groupBy("_part").count()
    offsets = sizes.select(
        "_part",
        (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"),
    )
    position = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return (
        placed.withColumn("_pos", position)
        .join(offsets, "_part")
        .withColumn(name, (F.col("_before") + F.col("_pos") - 1 + first).cast("bigint"))
        .drop("_part", "_pos", "_before")
    )


def best_per(df: DataFrame, keys: list[str], *order: Column, keep: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order`` (ascending columns; negate to flip).

    ``min_by`` combines map-side, so a key with a third of all rows ships one
    row per task instead of being sorted in one.
    """
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("_best"))
        .select(*keys, "_best.*")
    )


def top_per(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key with their ``rank``; Spark limits each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)
