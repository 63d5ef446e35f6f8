"""Sales lines derived from an order/line star schema.

Turns ``lineitem``, ``orders``, ``part``, ``supplier``, ``nation`` and ``region`` into the
canonical transaction table. The star schema is clean, so the mapping adds the dirt a retail
export has (cancellations, admin codes, missing descriptions and customers, negative quantities,
zero prices, exact duplicates) by fixed formulas on the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.sources.schemas import RAW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal an input out over ``basketry.input.partitions`` tasks, if the session sets that.

    For single-file inputs on one machine; files of a cluster have splits enough.
    """
    wanted = df.sparkSession.conf.get("basketry.input.partitions", None)
    return df.repartition(int(wanted), *keys) if wanted else df


def sales_lines(
    spark: SparkSession, sf_dir: str, of_orders: Column | None = None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Raw transaction lines, one row per invoice line, duplicates included.

    ``of_orders`` restricts the orders before anything is joined to them. ``carried`` names columns of the
    star schema that stay beside the raw ones. Without a restriction the orders come last: their columns
    then travel once, and the lines of an order lie together.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag",
    )
    lines = spread(lines, "l_orderkey", "l_linenumber")
    orders = table(spark, sf_dir, "orders")
    orders = (orders if of_orders is None else orders.filter(of_orders)).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate"
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    countries = (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        .join(table(spark, sf_dir, "nation"), "n_nationkey")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("l_suppkey", F.col("r_name").alias("country"))
    )
    if of_orders is None:
        joined = lines.join(parts, "l_partkey").join(countries, "l_suppkey").join(orders, "l_orderkey")
    else:
        joined = lines.join(orders, "l_orderkey").join(parts, "l_partkey").join(countries, "l_suppkey")

    mix = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    quantity = F.col("l_quantity").cast("int")
    cancelled = (F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "R")
    copies = F.when(order % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return joined.select(
        F.concat(F.when(cancelled, "C").otherwise(""), order.cast("string")).alias("invoice"),
        F.when(part % 199 == 0, "POST")
        .when(part % 199 == 1, "m")
        .otherwise(part.cast("string"))
        .alias("stock_code"),
        F.when(part % 97 != 0, F.col("p_name")).alias("description"),
        F.when(mix % 173 == 0, -quantity).otherwise(quantity).alias("quantity"),
        (
            F.col("o_orderdate")
            + F.make_dt_interval(hours=(F.lit(8) + order % 10).cast("int"))
        ).alias("invoice_date"),
        F.when(mix % 211 == 0, 0.0)
        .otherwise(F.col("l_extendedprice") / F.col("l_quantity"))
        .alias("unit_price"),
        F.when(order % 5 != 0, F.col("o_custkey")).alias("customer_id"),
        "country",
        F.concat(F.lit("P"), F.year("o_orderdate").cast("string")).alias("source_sheet"),
        F.explode(copies).alias("copy"),
        *carried,
    ).select(*RAW.fieldNames(), *carried)
