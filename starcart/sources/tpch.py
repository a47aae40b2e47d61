"""The six source tables, derived from TPC-H-like parquet tables.

Ids become text, dates become purchase and delivery times, and two accounts belong
to each person, so that every report has something to say about these data.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starcart.functions.lazy import LazyTables
from starcart.schemas import MONEY


def _customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Places are nation and region; two accounts belong to each person."""
    nations = nation.withColumnRenamed("n_nationkey", "c_nationkey")
    regions = region.withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        customer.join(nations, "c_nationkey", "left")
        .join(regions, "n_regionkey", "left")
        .selectExpr(
            "cast(c_custkey as string) as customer_id",
            "concat('U', cast(c_custkey div 2 as string)) as customer_unique_id",
            "lpad(cast(c_custkey % 100 as string), 5, '0') as customer_zip_code_prefix",
            "n_name as customer_city",
            "r_name as customer_state",
        )
    )


def _orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Carrier and customer dates are the first and last ship date of the order's lines."""
    shipped = (
        lineitem.selectExpr("l_orderkey as o_orderkey", "l_shipdate")
        .groupBy("o_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    return orders.join(shipped, "o_orderkey", "left").selectExpr(
        "cast(o_orderkey as string) as order_id",
        "cast(o_orderkey as bigint) as index",
        "cast(o_custkey as string) as customer_id",
        # fixed values: the status letters of the given orders
        "case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped' "
        "when 'P' then 'processing' end as order_status",
        "o_orderdate as order_purchase_timestamp",
        "o_orderdate as order_approved_at",
        "first_ship as order_delivered_carrier_date",
        "last_ship as order_delivered_customer_date",
        "o_orderdate + interval 30 days as order_estimated_delivery_date",
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "cast(l_orderkey as string) as order_id",
        "cast(l_linenumber as int) as order_item_id",
        "cast(l_partkey as string) as product_id",
        "cast(l_suppkey as string) as seller_id",
        "l_shipdate as shipping_limit_date",
        f"cast(l_extendedprice as {MONEY}) as price",
        f"cast(l_quantity as {MONEY}) as freight_value",
    )


def _payments(orders: DataFrame) -> DataFrame:
    """One payment per order, and a second of zero for every tenth order."""
    return orders.selectExpr(
        "o_orderkey",
        "explode(sequence(1, if(o_orderkey % 10 = 0, 2, 1))) as payment_sequential",
        "o_orderpriority",
        "o_totalprice",
    ).selectExpr(
        "cast(o_orderkey as string) as order_id",
        "payment_sequential",
        "o_orderpriority as payment_type",
        "1 as payment_installments",
        f"cast(if(payment_sequential = 1, o_totalprice, 0) as {MONEY}) as payment_value",
    )


def _products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "cast(p_partkey as string) as product_id",
        "p_type as product_category_name",
        "length(p_name) as product_name_lenght",
        "cast(null as int) as product_description_lenght",
        "cast(null as int) as product_photos_qty",
        "cast(p_size as int) as product_weight_g",
        "cast(null as int) as product_length_cm",
        "cast(null as int) as product_height_cm",
        "cast(null as int) as product_width_cm",
    )


def _categories(part: DataFrame) -> DataFrame:
    """Product types and their names; one type is left without."""
    return (
        part.filter("p_type <> 'PROMO'")
        .select("p_type")
        .distinct()
        .selectExpr(
            "p_type as product_category_name", "lower(p_type) as product_category_name_english"
        )
    )


def tpch_sources(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """The source tables over ``{sf_dir}/*.parquet``, each opened on first use."""
    given = LazyTables(
        {
            name: partial(spark.read.parquet, f"{sf_dir}/{name}.parquet")
            for name in ("customer", "nation", "region", "orders", "lineitem", "part")
        }
    )
    return LazyTables(
        {
            "customers": lambda: _customers(given["customer"], given["nation"], given["region"]),
            "orders": lambda: _orders(given["orders"], given["lineitem"]),
            "order_items": lambda: _order_items(given["lineitem"]),
            "payments": lambda: _payments(given["orders"]),
            "products": lambda: _products(given["part"]),
            "product_category_name": lambda: _categories(given["part"]),
        }
    )
