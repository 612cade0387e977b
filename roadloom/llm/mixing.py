"""Mixing sources to target weights by a Pfair schedule.

A source's documents, in a fixed pseudo-random order, are one stream of
characters cut into blocks of ``block_chars``. Time is slots, one block each.
A frame gives source s ``quota`` slots, its weight times ``frame_slots``
rounded; block j of a frame with q of Q slots is released at floor(j Q / q) and
due at ceil((j + 1) Q / q). The earliest deadline goes first among the released
blocks, so every block lies in its window and at any slot a source is less than
one block away from its share. All lags are zero at a frame's end, hence frames
are independent: equal frames share one schedule and the rest is arithmetic.
A source that ends leaves its slots out, and the others go on in proportion.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.common import whole_text, with_fixed_id, with_row_id
from roadloom.session import cut_lineage

BLOCK_CHARS, FRAME_SLOTS, TEMPERATURE = 65_536, 1_000, 0.7


def _quotas(totals: DataFrame, weights: Mapping[str, float] | None, frame_slots: int, temperature: float) -> DataFrame:
    if weights is None:
        weight = F.pow(F.greatest("total", F.lit(1)).cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for source, w in weights.items():
            weight = F.when(F.col("source") == source, F.lit(float(w))).otherwise(weight)
    weighed = totals.withColumn("weight", weight)
    whole = weighed.agg(F.sum("weight")).first()[0] or 1.0
    share = F.col("weight") / F.lit(float(whole)) * F.lit(float(frame_slots))
    return weighed.withColumn("quota", F.greatest(F.lit(1), F.round(share)).cast("long"))


def _earliest_deadline_first(takes: Column, slots: Column) -> Column:
    """The source's index in ``takes`` that runs in each slot of a frame."""
    def step(state: Column, t: Column) -> Column:
        waiting = F.transform(
            takes,
            lambda q, s: F.when(
                (state["given"][s] < q) & (F.floor(state["given"][s] * slots / q) <= t),
                F.struct(F.ceil((state["given"][s] + 1) * slots / q).alias("due"), s.alias("s")),
            ),
        )
        first = F.array_min(F.filter(waiting, lambda w: w.isNotNull()))["s"]
        return F.struct(
            F.transform(state["given"], lambda n, s: F.when(s == first, n + 1).otherwise(n)).alias("given"),
            F.concat(state["run"], F.array(first)).alias("run"),
        )

    start = F.struct(
        F.transform(takes, lambda q: F.lit(0).cast("long")).alias("given"), F.expr("cast(array() as array<int>)").alias("run")
    )
    return F.aggregate(F.sequence(F.lit(0).cast("long"), slots - 1), start, step, lambda state: state["run"])


def _schedule(sources: DataFrame) -> DataFrame:
    """``source, block, release, due, slot`` of every block. sources: source, blocks, quota."""
    n_frames = sources.agg(F.max(F.ceil(F.col("blocks") / F.col("quota")))).first()[0]
    if not n_frames:
        n_frames = 1
    given = sources.select(
        "source", "quota", "blocks", F.explode(F.sequence(F.lit(0), F.lit(n_frames) - 1)).alias("frame")
    )
    take = F.least("quota", F.col("blocks") - F.col("quota") * F.col("frame"))
    frames = (
        given.withColumn("take", take)
        .groupBy("frame")
        .agg(
            F.sum(F.least("blocks", F.col("quota") * F.col("frame"))).alias("base"),
            F.array_sort(F.collect_list(F.when(F.col("take") > 0, F.struct("source", "take", "quota")))).alias("mix"),
        )
        .withColumn("kind", F.md5(F.to_json("mix")))
    )
    slots = F.aggregate("mix", F.lit(0).cast("long"), lambda n, m: n + m["take"])
    kinds = (
        frames.groupBy("kind")
        .agg(F.first("mix").alias("mix"))
        .withColumn("slots", slots)
        .withColumn("run", _earliest_deadline_first(F.transform("mix", lambda m: m["take"]), F.col("slots")))
        .select("kind", "slots", "mix", F.posexplode("run").alias("at", "s"))
        .withColumn("nth", F.row_number().over(Window.partitionBy("kind", "s").orderBy("at")) - 1)
        .select("kind", "slots", "at", "nth", F.col("mix")[F.col("s")].alias("m"))
    )
    turn = (F.col("nth") * F.col("slots") / F.col("m.take")), ((F.col("nth") + 1) * F.col("slots") / F.col("m.take"))
    return frames.select("frame", "base", "kind").join(kinds, "kind").select(
        F.col("m.source").alias("source"),
        (F.col("frame") * F.col("m.quota") + F.col("nth")).alias("block"),
        (F.col("base") + F.floor(turn[0])).alias("release"),
        (F.col("base") + F.ceil(turn[1])).alias("due"),
        (F.col("base") + F.col("at")).alias("slot"),
    )


def mixed_order(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    block_chars: int = BLOCK_CHARS,
    frame_slots: int = FRAME_SLOTS,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """``rid__, doc_id, source, size, block, place, release, due, slot`` for every document.

    The mix is the order by (slot, place, doc_id): ``place`` is the document's
    first character in its source's stream. Without weights a source counts with
    its characters to the power ``temperature``. A source without a given
    weight gets one slot a frame. A null source is the source of the empty
    name, a null text is empty, a null id sorts first; repeated rows keep
    their own places. An empty table gives no rows.
    """
    rows = cut_lineage(
        with_row_id(docs).select(
            "rid__",
            "doc_id",
            F.coalesce("source", F.lit("")).alias("source"),
            F.length(whole_text()).cast("long").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("lot"),
        )
    ).withColumn("bucket", F.substring("lot", 1, 3))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("chars"))
    totals = sums.groupBy("source").agg(F.sum("chars").alias("total"))
    sources = cut_lineage(
        _quotas(totals, weights, frame_slots, temperature).select(
            "source", "quota", F.greatest(F.lit(1), F.ceil(F.col("total") / block_chars)).cast("long").alias("blocks")
        )
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sums.select("source", "bucket", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("start"))
        .join(sources.select("source", "blocks"), "source")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("lot", "doc_id", "rid__").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, ["source", "bucket"])
        .withColumn("place", F.col("start") + F.col("inner"))
        .withColumn("block", F.least(F.floor(F.col("place") / block_chars), F.col("blocks") - 1))
    )
    return placed.join(_schedule(sources), ["source", "block"]).select(
        "rid__", "doc_id", "source", "size", "block", "place", "release", "due", "slot"
    )


def in_mixed_order(docs: DataFrame, columns: list[str], **params) -> DataFrame:
    """All documents with the named columns, their rows (files and rows in files) in the order of the mix."""
    docs = with_fixed_id(docs)
    order = mixed_order(docs, **params).select("rid__", "slot", "place", F.col("doc_id").alias("tie__"))
    return (
        docs.select("rid__", *columns)
        .join(order, "rid__")
        .repartitionByRange("slot", "place", "tie__")
        .sortWithinPartitions("slot", "place", "tie__")
        .select(*columns)
    )


def query(spark, sf_dir: str) -> DataFrame:
    return mixed_order(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rid__")


SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, CAST(length(coalesce(text, '')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS lot FROM documents
), p AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY lot, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM d
), s AS (
  SELECT source, greatest(1, CAST(ceil(sum(size) / 65536.0) AS BIGINT)) AS blocks,
    pow(greatest(sum(size), 1), 0.7) AS weight FROM d GROUP BY source
), q AS (
  SELECT source, blocks, greatest(1, CAST(round(weight / (SELECT sum(weight) FROM s) * 1000) AS BIGINT)) AS quota FROM s
), f AS (
  SELECT source, quota, frame, least(quota, blocks - quota * frame) AS take, least(blocks, quota * frame) AS gone
  FROM q, range((SELECT max(CAST(ceil(blocks / quota) AS BIGINT)) + 1 FROM q)) r(frame)
), fr AS (
  SELECT frame, sum(gone) AS base, sum(greatest(take, 0)) AS slots FROM f GROUP BY frame
), jobs AS (
  SELECT f.frame, f.source, f.quota, j AS nth, slots, CAST(base AS BIGINT) AS base,
    CAST(floor(j * slots / take) AS BIGINT) AS release, CAST(ceil((j + 1) * slots / take) AS BIGINT) AS due
  FROM f JOIN fr USING (frame), range((SELECT max(quota) FROM q)) r(j) WHERE j < take
), run(t, frame, source, nth, given) AS (
  SELECT CAST(-1 AS BIGINT), frame, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST([] AS VARCHAR[]) FROM fr WHERE slots > 0
  UNION ALL
  SELECT t + 1, frame, b.source, b.nth, list_append(given, b.source || ':' || b.nth)
  FROM run, LATERAL (
    SELECT source, nth FROM jobs j WHERE j.frame = run.frame AND j.release <= run.t + 1
      AND NOT list_contains(run.given, j.source || ':' || j.nth) ORDER BY due, source LIMIT 1) b
), b AS (
  SELECT j.source, j.frame * j.quota + j.nth AS block, base + release AS release, base + due AS due, base + t AS slot
  FROM jobs j JOIN run USING (frame, source, nth)
)
SELECT doc_id, p.source, size, least(CAST(floor(place / 65536) AS BIGINT), blocks - 1) AS block, place, release, due, slot
FROM p JOIN q USING (source) JOIN b ON b.source = p.source AND b.block = least(CAST(floor(place / 65536) AS BIGINT), blocks - 1)
"""
