"""The eight star tables, each a function of typed source tables.

``distinct`` is part of what the tables mean (the sources are not trusted to be
unique), so the plans below place it where it costs no shuffle of its own: the
big side is hash-partitioned once, by the join key, and that partitioning also
serves the ``distinct`` because the key is among its columns. The side that is
looked up is narrow and made unique *before* the join, so duplicated customers or
orders never multiply rows on the wire. A join key that holds a large share of the
rows is dealt to many tasks (``functions.hot``); what that does not foresee is split
at run time by the adaptive skew join (``plans.session``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starcart.functions.hot import distinct_columns, split_join
from starcart.functions.keys import location_key
from starcart.schemas import SOURCE_TABLES, STAR_TABLES

# First and last day of the default calendar, both included.
CALENDAR_START = "2000-01-01"
CALENDAR_END = "2030-01-01"


def _key(separator: str):
    return location_key(
        "customer_city", "customer_state", "customer_zip_code_prefix", separator
    ).alias("location_id")


def location_dim(customers: DataFrame, separator: str = "") -> DataFrame:
    """Distinct (city, state, zip prefix) with their key.

    The key is a function of the three columns, so it is computed after the
    ``distinct``: once per place, not once per customer.
    """
    return (
        customers.select("customer_city", "customer_state", "customer_zip_code_prefix")
        .distinct()
        .select(
            _key(separator),
            F.col("customer_city").alias("location_city"),
            F.col("customer_state").alias("location_state"),
            F.col("customer_zip_code_prefix").alias("location_zip_code_prefix"),
        )
    )


def customers_dim(customers: DataFrame, separator: str = "") -> DataFrame:
    """One row per source customer row; not made distinct."""
    return customers.select(_key(separator), "customer_id", "customer_unique_id")


def customer_locations(customers: DataFrame, separator: str = "") -> DataFrame:
    """Distinct (customer_id, location_id): the only part of customers a join needs."""
    return customers.select("customer_id", _key(separator)).distinct()


def orders_dim(
    orders: DataFrame, customers: DataFrame, separator: str = "", hot_customers: DataFrame | None = None
) -> DataFrame:
    """Orders with the place of their customer.

    A customer id with several places yields one row per place.
    """
    located = split_join(
        orders.select(*SOURCE_TABLES["orders"]),
        customer_locations(customers, separator),
        "customer_id",
        hot_customers,
    )
    return distinct_columns(located, list(STAR_TABLES["orders_dim"]))


def order_locations(
    orders: DataFrame, customers: DataFrame, separator: str = "", hot_customers: DataFrame | None = None
) -> DataFrame:
    """Distinct (order_id, location_id), from the two id columns of orders."""
    located = split_join(
        orders.select("order_id", "customer_id"),
        customer_locations(customers, separator),
        "customer_id",
        hot_customers,
    )
    return located.select("order_id", "location_id").distinct()


def payments_dim(payments: DataFrame) -> DataFrame:
    return payments.select(*STAR_TABLES["payments_dim"])


def products_dim(products: DataFrame) -> DataFrame:
    """Product rows with two misspelt column names put right."""
    return products.withColumnsRenamed(
        {
            "product_name_lenght": "product_name_length",
            "product_description_lenght": "product_description_length",
        }
    ).select(*STAR_TABLES["products_dim"])


def category_dim(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("product_category_name").alias("category_name"),
        F.col("product_category_name_english").alias("category_name_english"),
    )


def _calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``ddate`` column.

    ``week`` is the ISO week while ``year`` is the calendar year: 2000-01-01 has
    year 2000 and week 52, so the two do not form a grouping pair.
    """
    return days.selectExpr(
        "ddate",
        "year(ddate) as year",
        "month(ddate) as month",
        "day(ddate) as day",
        "dayofweek(ddate) as weekday",
        "dayofyear(ddate) as yearday",
        "weekofyear(ddate) as week",
        "quarter(ddate) as quarter",
    )


def _valid(day: Column) -> Column:
    """The day, or the nearest of the years 1 to 9999; a calendar thus has under four million."""
    earliest, latest = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    return F.least(F.greatest(day, earliest), latest)


def date_dim(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included.

    At most as many rows as there are dates (under four million), whatever the
    size of the other tables.
    """
    first, last = _valid(F.lit(start).cast("date")), _valid(F.lit(end).cast("date"))
    days = F.sequence(first, last, F.expr("interval 1 day"))
    return _calendar(spark.range(0, 1, 1, 1).select(F.explode(days).alias("ddate")))


def date_dim_covering(
    orders: DataFrame, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """The calendar, stretched where purchases lie before ``start`` or after ``end``.

    Only two dates leave the scan of the orders, so no purchase has to fall into
    the group without a month.
    """
    purchased = F.to_date("order_purchase_timestamp")
    return _calendar(
        orders.agg(
            _valid(F.least(F.min(purchased), F.lit(start).cast("date"))).alias("first"),
            _valid(F.greatest(F.max(purchased), F.lit(end).cast("date"))).alias("last"),
        ).select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("ddate"))
    )


def order_items_fact(
    order_items: DataFrame, locations: DataFrame, hot_orders: DataFrame | None = None
) -> DataFrame:
    """Order lines with the buyer's place; ``locations`` as from ``order_locations``.

    One join, not two: the orders and customers are first reduced to pairs of ids.
    """
    located = split_join(
        order_items.select(*SOURCE_TABLES["order_items"]), locations, "order_id", hot_orders
    )
    return distinct_columns(located, list(STAR_TABLES["order_items_fact"]))
