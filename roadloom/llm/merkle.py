"""A Merkle manifest of a dataset, with a proof for every row, by nested-interval labels.

Every source is a tree over its rows, and the sources' subroots are the leaves
of one more. A node is labelled by the interval ``[lo, hi)`` of leaf ranks that
it covers, so a node's ancestors are those whose intervals contain its own, and
its siblings what its parent's interval holds beside it. Trees grow by bands of
``BAND`` levels: the ranks of a bucket, ``ARITY ** BAND`` nodes wide, make one
row of at most 121 nodes, whatever the source's size. On the way down, each
band attaches ancestors by a containment join on (tree, bucket) and passes on
what is above the bucket, so a path travels once per bucket, not once per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.common import fold, table
from roadloom.operators.ordering import dense_index
from roadloom.session import broadcast_if_small, cut_lineage

ARITY, BAND = 3, 4
WIDTH = ARITY**BAND
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODES = "array<struct<lo:bigint,hi:bigint,digest:string,kids:array<struct<lo:bigint,hi:bigint,digest:string>>>>"
_STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value with its UTF-8 length in front, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (tree, doc_id, leaf, ...) with ``lo, hi`` (the rank in its tree) and ``n`` (leaves of the tree).

    Rows are sorted over all tasks by range, so a tree with a third of all rows
    spans many; a task's rows of a tree are shifted by those in tasks before it.
    """
    order = ["tree", "doc_id", "leaf", "rid__"]
    rows = cut_lineage(rows.withColumn("rid__", F.monotonically_increasing_id()))
    placed = cut_lineage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*rows.columns, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    )
    parts = placed.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    over = Window.partitionBy("tree")
    before = F.sum("held").over(over.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = cut_lineage(
        parts.select("part", "tree", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("held").over(over).alias("n"))
    )
    lo = F.col("at") - F.col("first") + F.col("before")
    joined = placed.join(broadcast_if_small(parts), ["part", "tree"])
    return cut_lineage(joined.select(*[c for c in rows.columns if c != "rid__"], lo.alias("lo"), (lo + 1).alias("hi"), "n"))


def _depth(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves."""
    powers = F.array(*[F.lit(ARITY**k).cast("long") for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def _merged(lower: str) -> Column:
    """The nodes over runs of ``ARITY`` nodes: their interval, digest and children."""

    def node(kids: Column) -> Column:
        return F.struct(
            kids[0]["lo"].alias("lo"),
            F.element_at(kids, -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.transform(kids, lambda k: k["digest"]), ""), 256).alias("digest"),
            kids.alias("kids"),
        )

    plain = F.transform(lower, lambda k: F.struct(k["lo"].alias("lo"), k["hi"].alias("hi"), k["digest"].alias("digest")))
    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(lower) / ARITY).cast("int") - 1), lambda i: F.slice(plain, i * ARITY + 1, ARITY))
    return F.transform(runs, node)


def _levelled(nodes: str, level: int) -> Column:
    return F.transform(nodes, lambda p: F.struct(F.lit(level).alias("level"), p.alias("p")))


@dataclass
class Band:
    """Some levels of all trees that reach them. ``base``: their nodes at the lowest; ``grown``: a row per bucket."""

    width: int
    base: DataFrame
    grown: DataFrame


def _grow(nodes: DataFrame) -> tuple[list[Band], DataFrame]:
    """The bands from the leaves up, and ``tree, digest`` of each tree's root.

    nodes: ``tree, lo, hi, digest, n`` and more.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    keep = ["tree", "n", "lo", "hi", "digest"]
    tops = nodes.filter("n = 1").select("tree", "digest")
    bands, base, level = [], nodes.filter("n > 1"), 0
    while most > ARITY**level:
        width = ARITY ** (level + BAND)
        depth = _depth(F.col("n"))
        base = base.withColumn("bucket", F.floor(F.col("lo") / width).cast("long"))
        nodes_of = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))
        grown = base.groupBy("tree", "n", "bucket").agg(nodes_of.alias("l0")).withColumn("left", depth - level)
        for k in range(1, BAND + 1):
            grown = grown.withColumn(f"l{k}", F.when(F.col("left") >= k, _merged(f"l{k - 1}")).otherwise(F.expr(f"cast(array() as {_NODES})")))
        done = F.col("left") <= BAND
        top = F.coalesce(*[F.get(F.col(f"l{k}"), F.lit(0)) for k in reversed(range(1, BAND + 1))])
        parents = F.flatten(F.array(*[_levelled(f"l{k}", level + k) for k in range(1, BAND + 1)]))
        grown = cut_lineage(grown.select("tree", "n", "bucket", done.alias("done"), parents.alias("parents"), top.alias("top")))
        bands.append(Band(width, base, grown))
        ends = grown.select("tree", "n", "done", "top.lo", "top.hi", "top.digest")
        tops = tops.unionByName(ends.filter("done").select("tree", "digest"))
        base = ends.filter("not done").select(*keep)
        level += BAND
    return bands, tops


def _attached(band: Band, carried: list[str]) -> DataFrame:
    """``tree, bucket, lo, carried, near``: each node's steps within its bucket, lowest level first.

    A step holds the digests of the siblings at that level, those left of the
    node and those right of it: the parent's interval less the node's.
    """
    parents = band.grown.select("tree", "bucket", F.explode("parents").alias("x")).select(
        "tree", "bucket", F.col("x.level").alias("level"), F.col("x.p.lo").alias("plo"), F.col("x.p.hi").alias("phi"), F.col("x.p.kids").alias("kids")
    )
    own = band.base.select("tree", "bucket", "lo", "hi", *carried)
    inside = own.alias("own").join(
        parents, (own["tree"] == parents["tree"]) & (own["bucket"] == parents["bucket"]) & (F.col("plo") <= F.col("own.lo")) & (F.col("own.hi") <= F.col("phi"))
    )

    def joined(kids: Column) -> Column:
        return F.array_join(F.transform(kids, lambda k: k["digest"]), "")

    step = F.struct(
        "level",
        joined(F.filter("kids", lambda k: k["hi"] <= F.col("own.lo"))).alias("left"),
        joined(F.filter("kids", lambda k: k["lo"] >= F.col("own.hi"))).alias("right"),
    )
    return (
        inside.select("own.*", step.alias("step"))
        .groupBy("tree", "bucket", "lo")
        .agg(*[F.first(c).alias(c) for c in carried], F.array_sort(F.collect_list("step")).alias("near"))
        .withColumn("near", F.transform("near", lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right"))))
    )


def _paths(nodes: DataFrame, bands: list[Band], above: DataFrame, carried: list[str]) -> DataFrame:
    """``tree, carried, steps, subroot, root`` for every leaf of every tree. above: ``tree, steps, subroot, root``."""
    upper = None
    ends = ["steps", "subroot", "root"]
    for number in reversed(range(len(bands))):
        band = bands[number]
        buckets = band.grown.select("tree", "bucket", "done")
        outer = buckets.filter("done").join(above, "tree").select("tree", "bucket", *ends)
        if upper is not None:
            places = upper.select("tree", F.floor(F.col("lo") / band.width).cast("long").alias("bucket"), *ends)
            outer = outer.unionByName(places)
        own = carried if number == 0 else []
        near = _attached(band, own)
        found = near.join(outer, ["tree", "bucket"]).select("tree", "lo", *own, F.concat("near", "steps").alias("steps"), "subroot", "root")
        upper = cut_lineage(found) if number else found
    alone = nodes.filter("n = 1").join(above, "tree").select("tree", *carried, *ends)
    return alone if upper is None else alone.unionByName(upper.select("tree", *carried, *ends))


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    A leaf hashes doc_id, source, lang, n_chars and text, nulls marked as such;
    other columns are ignored. Within a source leaves ascend by doc_id, null ids
    first, equal ids by leaf; rows equal in all are neighbours, in any order. A null
    source is a source of its own, before all others. ``tampered_text`` is the
    text to fold from the leaf to the root with the row's siblings (default: the
    text itself); ``verified`` says whether that gives the root. No rows give none.
    """
    values = [F.col(c) for c in FIELDS]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),  # null first, then by bytes
        "doc_id",
        leaf_digest(values).alias("leaf"),
        leaf_digest([*values[:-1], F.col("text") if tampered_text is None else tampered_text]).alias("changed"),
    )
    leaves = _ranked(rows).withColumnRenamed("leaf", "digest").withColumn("leaf", F.col("digest"))
    bands, tops = _grow(leaves)
    sources = dense_index(tops, "tree", "lo")
    count = sources.count()
    sources = cut_lineage(sources.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "lo", (F.col("lo") + 1).alias("hi"), F.lit(count).cast("long").alias("n"), "digest"))
    source_bands, root = _grow(sources)
    none = F.expr(f"cast(array() as {_STEPS})")
    start = root.select("tree", none.alias("steps"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = _paths(sources, source_bands, start, ["of", "digest"]).select(F.col("of").alias("tree"), "steps", F.col("digest").alias("subroot"), "root")
    found = _paths(leaves, bands, cut_lineage(above), ["doc_id", "leaf", "changed"])
    folded = F.aggregate("steps", F.col("changed"), lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark, sf_dir: str) -> DataFrame:
    changed = F.when(fold("doc_id", 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents"), changed)


_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(length(d)), lambda i: list_transform(range(8), lambda b: ((ascii(d[i + 1]) >> b) & 1)::BIGINT)))),
    lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b) & 1)))"""

SQL = f"""
WITH RECURSIVE plain AS (
  SELECT *, coalesce('=' || source, '') AS tree, coalesce(CAST(doc_id AS VARCHAR), '') AS d FROM documents
), told AS (
  SELECT *, CASE WHEN xor({_CRC}, 4294967295::BIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM plain
), leaves AS (
  SELECT tree, doc_id, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text="other")} AS changed FROM told
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes(tree, level, pos, n, digest) AS (
  SELECT tree, 0, pos, n, leaf FROM ranked
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY tree, level, n, pos // 3
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(level, pos, n, digest) AS (
  SELECT 0, pos, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, n, pos // 3
), low AS (
  SELECT tree, level, pos, n, digest FROM nodes UNION ALL SELECT NULL, level, pos, n, digest FROM tops
), steps AS (
  SELECT o.tree, o.level, o.pos, o.n,
    coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < o.pos), '') AS l, coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > o.pos), '') AS r
  FROM low o JOIN low s ON o.tree IS NOT DISTINCT FROM s.tree AND o.level = s.level AND o.pos // 3 = s.pos // 3
  WHERE o.n > 1 GROUP BY o.tree, o.level, o.pos, o.n
), folds(tree, doc_id, leaf, own, part, level, pos, acc, proof) AS (
  SELECT tree, doc_id, leaf, pos, 0, 0, pos, changed, '' FROM ranked
  UNION ALL
  SELECT f.tree, f.doc_id, f.leaf, f.own,
    CASE WHEN s.n IS NULL THEN f.part + 1 ELSE f.part END, CASE WHEN s.n IS NULL THEN 0 ELSE f.level + 1 END,
    CASE WHEN s.n IS NOT NULL THEN f.pos // 3 ELSE b.pos END,
    CASE WHEN s.n IS NOT NULL THEN sha256(s.l || f.acc || s.r) ELSE f.acc END, f.proof || coalesce(s.l || s.r, '')
  FROM folds f
  JOIN subroots b ON b.tree = f.tree
  LEFT JOIN steps s ON s.tree IS NOT DISTINCT FROM (CASE WHEN f.part = 0 THEN f.tree END) AND s.level = f.level AND s.pos = f.pos
  WHERE f.part < 2
)
SELECT f.doc_id, f.leaf, b.digest AS subroot, t.digest AS root, sha256(f.proof) AS proof_sha256, f.acc AS folded_root, f.acc = t.digest AS verified
FROM folds f JOIN subroots b ON b.tree = f.tree JOIN tops t ON t.n = 1
WHERE f.part = 2
"""
