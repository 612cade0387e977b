"""Exact deduplication: sorted digest runs merged along a tree.

Every input partition makes a run of digests. Runs merge in rounds of
``FAN_IN``: in round t a run's number gives up its t-th digit for the t-th
digit of the digest, so a node receives what up to 16 runs hold of its part of
the digests. After the last round each digest lives in one node. A copy group
thus shrinks to one row per run before anything moves, and no node ever
receives more than 16 rows of it. The decisions go down the same tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.llm.common import only_rows, whole_text, with_fixed_id, with_row_id
from roadloom.session import cut_lineage

BITS, ROUNDS = 4, 3
FAN_IN = 1 << BITS
KEY = ["sha", "size", "check"]


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space (single spaces are left as they are)."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _digests(docs: DataFrame) -> DataFrame:
    text = normalised(whole_text())
    return with_row_id(docs).select(
        "rid__",
        "doc_id",
        (F.spark_partition_id() % (FAN_IN**ROUNDS)).alias("node"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.length(text).alias("size"),
        F.xxhash64(text).alias("check"),
    )


def _up(turn: int) -> Column:
    """The node one round up: digit ``turn`` of the run's number becomes the digest's."""
    low = BITS * turn
    digit = F.shiftright("check", low).bitwiseAND(FAN_IN - 1)
    return (F.col("node") - F.shiftright("node", low).bitwiseAND(FAN_IN - 1) * (1 << low) + digit * (1 << low)).cast("int")


def exact_groups(docs: DataFrame) -> DataFrame:
    """``rid__, doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Texts are equal when SHA-256, length and an independent 64-bit hash of the
    normalised text all agree; the last two verify the first at every level.
    A null text counts as empty. The smallest doc_id stays; a null id counts as
    larger than any, and of repeated rows with that id only the first stays.
    """
    rows = cut_lineage(_digests(docs).sortWithinPartitions("sha"))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid__")
    level = rows.groupBy("node", *KEY).agg(F.min(name).alias("best"), F.count("*").alias("copies"))
    levels = []
    for turn in range(ROUNDS):
        levels.append(level)
        level = (
            level.withColumn("node", _up(turn))
            .groupBy("node", *KEY)
            .agg(F.min("best").alias("best"), F.sum("copies").alias("copies"))
        )
    decided = level
    for turn in reversed(range(ROUNDS)):
        own = levels[turn].select("node", *KEY, _up(turn).alias("up"))
        decided = own.join(decided.withColumnRenamed("node", "up"), ["up", *KEY]).drop("up")
    return rows.join(decided, ["node", *KEY]).select(
        "rid__",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("rid__") == F.col("best.rid__")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, columns: list[str]) -> DataFrame:
    """One row of each group of equal texts, with the named columns."""
    docs = with_fixed_id(docs)
    return only_rows(docs, exact_groups(docs).filter("kept"), columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs).drop("rid__")


SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t
"""
