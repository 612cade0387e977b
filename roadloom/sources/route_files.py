"""JSON route files: arrays of records in, JSON lines out."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIP = T.StructType(
    [
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("merchandise", T.MapType(T.StringType(), T.LongType())),
    ]
)
STANDARD = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("route", T.ArrayType(TRIP))]
)
ACTUAL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("driver", T.StringType()),
        T.StructField("sroute", T.StringType()),
        T.StructField("route", T.ArrayType(TRIP)),
    ]
)
PERFECT = T.StructType(
    [T.StructField("driver", T.StringType()), T.StructField("route", T.ArrayType(TRIP))]
)


def file_suffix(path: str, kind: str) -> str:
    """Check the naming contract (``standard*`` / ``actual*``) and return what follows the kind."""
    match = re.fullmatch(rf"{kind}(.*?)(\.[^.]*)?", os.path.basename(path))
    if match is None:
        raise ValueError(f"the file name must start with '{kind}': {path}")
    return match.group(1)


def number_of(id_column: str | Column) -> Column:
    """Numeric part of ``s12`` / ``a12``."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.substring(column, 2, 19).cast("bigint")


def _read(spark: SparkSession, path: str, schema: T.StructType, multiline: bool) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=multiline, encoding="UTF-8")


def read_standard(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``std_no, sroute, route``; pass ``multiline=False`` for splittable JSON lines."""
    file_suffix(path, "standard")
    return _read(spark, path, STANDARD, multiline).select(
        number_of("id").alias("std_no"), F.col("id").alias("sroute"), "route"
    )


def read_actual(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """``rid, driver, sroute, route``."""
    file_suffix(path, "actual")
    return _read(spark, path, ACTUAL, multiline).select(
        number_of("id").alias("rid"), "driver", "sroute", "route"
    )


def read_perfect(spark: SparkSession, path: str) -> DataFrame:
    """Ideal routes written by :func:`write_perfect`, ready to be vectorised again."""
    return spark.read.schema(PERFECT).json(path)


def write_standard(recommended: DataFrame, path: str) -> None:
    """``new_no, route`` as records ``{id: "s<n>", route}``."""
    recommended.select(
        F.concat(F.lit("s"), F.col("new_no").cast("string")).alias("id"), "route"
    ).write.mode("errorifexists").json(path)


def write_actual(actual: DataFrame, path: str) -> None:
    """``rid, driver, sroute, route`` as records ``{id: "a<n>", driver, sroute, route}``."""
    named = F.concat(F.lit("a"), F.col("rid").cast("string")).alias("id")
    actual.select(named, "driver", "sroute", "route").write.mode("errorifexists").json(path)


def write_driver_top(top: DataFrame, path: str) -> None:
    """``driver, rank, std_no`` as ``{driver, routes: ["s<n>", ...]}``; at most five per driver."""
    named = F.concat(F.lit("s"), F.col("std_no").cast("string"))
    top.groupBy("driver").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", named.alias("id")))), lambda x: x["id"]
        ).alias("routes")
    ).write.mode("errorifexists").json(path)


def write_perfect(ideal: DataFrame, path: str) -> None:
    """``driver, route`` records."""
    ideal.select("driver", "route").write.mode("errorifexists").json(path)
