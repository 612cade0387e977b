"""Routes out of an order / line-item star schema.

One order is one driven route and one line is one trip: the supplier's nation
is where the trip starts, the next line's start (or the customer's nation) is
where it ends, the part's brand is the item carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom.session import broadcast_if_small

TRIP_ORDER = ("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = _table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    home = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_name").alias("sroute")
    )
    return orders.join(home, orders.o_custkey == home.c_custkey).select(
        F.col("o_orderkey").alias("rid"), F.col("o_custkey").alias("driver"), "sroute"
    )


def actual_routes(spark: SparkSession, folder: str, merchandise: bool = True) -> DataFrame:
    """``rid, driver, sroute, route``. Without merchandise the part table is never read.

    The lines are grouped on the order key and the orders joined on the same
    key, so both sides of that join share one shuffle.
    """
    nation = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    supplier = _table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    origin = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", F.col("n_name").alias("origin")
    )
    columns = ["l_orderkey", *TRIP_ORDER] + (["l_quantity"] if merchandise else [])
    lines = _table(spark, folder, "lineitem").select(*columns)
    # Its size is overestimated (a product), and lines that wait for a shuffle join would move once more.
    lines = lines.join(broadcast_if_small(origin), lines.l_suppkey == origin.s_suppkey)
    payload = ["origin"]
    if merchandise:
        part = _table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("item"))
        lines = lines.join(part, lines.l_partkey == part.p_partkey).withColumn(
            "qty", F.col("l_quantity").cast("bigint")
        )
        payload += ["item", "qty"]
    trips = lines.groupBy(F.col("l_orderkey").alias("rid")).agg(
        F.array_sort(F.collect_list(F.struct(*TRIP_ORDER, *payload))).alias("trips")
    )
    routed = trips.join(_orders(spark, folder), "rid")

    def trip(t, i):
        parts = [
            t["origin"].alias("from"),
            F.coalesce(F.try_element_at("trips", i + 2)["origin"], F.col("sroute")).alias("to"),
        ]
        if merchandise:
            parts.append(F.create_map(t["item"], t["qty"]).alias("merchandise"))
        return F.struct(*parts)

    return routed.select("rid", "driver", "sroute", F.transform("trips", trip).alias("route"))


def standard_routes(actual: DataFrame) -> DataFrame:
    """The longest driven route per ``sroute`` stands in for the plan; lowest id wins ties.

    ``max_by`` combines map-side, so a popular ``sroute`` is never gathered.
    """
    return (
        actual.groupBy("sroute")
        .agg(
            F.max_by(
                F.struct("rid", "route"), F.struct(F.size("route"), -F.col("rid"))
            ).alias("best")
        )
        .select(F.col("best.rid").alias("std_no"), "sroute", F.col("best.route").alias("route"))
    )
