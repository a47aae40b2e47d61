"""The business reports over a star, each returning a DataFrame.

``star`` maps table names to DataFrames, as returned by ``build_star`` or
``read_star``. All joins are between grouped sides (``functions.counted``), but for lines joined by
order, where hot orders are dealt into pieces (``functions.hot``). Spark itself broadcasts small
sides under ``spark.sql.autoBroadcastJoinThreshold``; the one hint is on the list of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starcart.functions.counted import counted, matches
from starcart.functions.hot import MEASURE, measured, split_join
from starcart.functions.lazy import to_count_keys
from starcart.functions.pieces import string_agg

Star = Mapping[str, DataFrame]


def _amount(name: str, legacy_decimal: bool) -> Column:
    """A money column; the legacy rule drops values of 100,000 and more."""
    return F.col(name).try_cast("decimal(9,4)") if legacy_decimal else F.col(name)


def top_products(star: Star, n: int = 5) -> DataFrame:
    """Products by number of order lines; ties go by product id."""
    return (
        counted(star["order_items_fact"], "product_id", weight="number_of_sales")
        .orderBy(F.desc("number_of_sales"), F.asc_nulls_last("product_id"))
        .limit(n)
    )


def _purchase_days(orders: DataFrame, *others: str) -> DataFrame:
    """Rows of orders_dim per purchase day (and ``others``)."""
    days = orders.select(*others, F.to_date("order_purchase_timestamp").alias("ddate"))
    return counted(days, *others, "ddate")


def orders_by_month(star: Star) -> DataFrame:
    """Orders per (year, month); those outside the calendar have no month."""
    return (
        _purchase_days(star["orders_dim"])
        .join(star["date_dim"].select("ddate", "year", "month"), "ddate", "left")
        .groupBy("year", "month")
        .agg(F.sum("n").alias("number_of_orders"))
        .orderBy("year", "month")
    )


def orders_by_city(star: Star) -> DataFrame:
    """Orders per city name, most first; a name found in two states is one city."""
    return (
        counted(star["orders_dim"], "location_id")
        .join(
            counted(star["location_dim"], "location_id", "location_city", weight="m"),
            "location_id",
            "left",
        )
        .groupBy("location_city")
        .agg(F.sum(F.col("n") * matches("m")).alias("number_of_orders"))
        .orderBy(F.desc("number_of_orders"), F.asc_nulls_last("location_city"))
    )


def revenue_by_month(star: Star, legacy_decimal: bool = False) -> DataFrame:
    """Sum of item prices per (year, month) of purchase.

    Prices are summed per order first, and that shuffle also serves the join.
    """
    revenue = (
        star["order_items_fact"]
        .groupBy("order_id")
        .agg(F.sum(_amount("price", legacy_decimal)).alias("revenue"))
    )
    daily = (
        revenue.join(_purchase_days(star["orders_dim"], "order_id"), "order_id", "left")
        .groupBy("ddate")
        .agg(F.sum(F.col("revenue") * matches("n")).alias("revenue"))
    )
    return (
        daily.join(star["date_dim"].select("ddate", "year", "month"), "ddate", "left")
        .groupBy("year", "month")
        .agg(F.sum("revenue").cast("decimal(38,4)").alias("revenue"))
        .orderBy("year", "month")
    )


def late_delivery_pct(star: Star, rule: str = "calendar") -> DataFrame:
    """Late deliveries as a percentage of all orders, in one pass.

    ``calendar``: delivered at least one calendar day after the purchase day.
    ``elapsed``: delivered more than 24 hours after the purchase.
    Only orders with status ``delivered`` can be late; every order counts in the
    total. No orders give null.
    """
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    if rule == "calendar":
        late = F.datediff(F.to_date(arrived), F.to_date(bought)) >= 1
    elif rule == "elapsed":
        late = arrived - bought > F.expr("interval '1' day")
    else:
        raise ValueError(f"rule must be 'calendar' or 'elapsed', not {rule!r}")
    share = F.try_divide(
        F.count_if((F.col("order_status") == "delivered") & late).cast("decimal(18,2)"),
        F.count(F.lit(1)).cast("decimal(18,2)"),
    )
    return star["orders_dim"].agg(
        F.round(share * 100, 2).cast("decimal(15,2)").alias("late_delivery_pct")
    )


def _category_totals(star: Star, sold: DataFrame) -> DataFrame:
    """Totals per English category name of ``sold`` (product_id, n)."""
    by_category = (
        sold.join(
            counted(star["products_dim"], "product_id", "product_category_name", weight="m"),
            "product_id",
            "left",
        )
        .groupBy(F.col("product_category_name").alias("category_name"))
        .agg(F.sum(F.col("n") * matches("m")).alias("n"))
    )
    return (
        by_category.join(
            counted(star["category_dim"], "category_name", "category_name_english", weight="m"),
            "category_name",
            "left",
        )
        .groupBy("category_name_english")
        .agg(F.sum(F.col("n") * matches("m")).alias("total_sold"))
    )


def _account_firsts(star: Star) -> DataFrame:
    """Distinct (customer_id, person, time of the account's first purchase)."""
    firsts = (
        star["orders_dim"]
        .groupBy("customer_id")
        .agg(F.min("order_purchase_timestamp").alias("first_at"))
    )
    people = star["customers_dim"].select("customer_id", "customer_unique_id").distinct()
    return people.join(firsts, "customer_id")


def first_orders(star: Star) -> DataFrame:
    """Ids of every person's first order; orders tied at that time all qualify.

    A person's first time is the least of their accounts' first times, so the
    orders are grouped by account and never gathered per person.
    """
    accounts = _account_firsts(star)
    people = accounts.groupBy("customer_unique_id").agg(F.min("first_at").alias("first_at"))
    winners = accounts.join(people, ["customer_unique_id", "first_at"], "left_semi").select(
        "customer_id", F.col("first_at").alias("order_purchase_timestamp")
    )
    return (
        star["orders_dim"]
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(winners, ["customer_id", "order_purchase_timestamp"], "left_semi")
        .select("order_id")
    )


def _hot_orders(star: Star, hot: str) -> DataFrame | None:
    """Orders with a large share of the lines."""
    return measured(to_count_keys(star, "order_items_fact"), "order_id", hot)


def _sold_lines(star: Star) -> DataFrame:
    return star["order_items_fact"].select("order_id", "product_id")


def _sold_all(star: Star, hot: str) -> DataFrame:
    """Sales per product with the literal first-purchase lookup.

    The lookup compares account ids with person ids and is left-joined, so it
    removes nothing; an order it finds several times counts that many times.
    """
    people = (
        _account_firsts(star)
        .groupBy(F.col("customer_unique_id").alias("customer_id"))
        .agg(F.min("first_at").alias("order_purchase_timestamp"))
    )
    found = (
        star["orders_dim"]
        .select("order_id", "customer_id", "order_purchase_timestamp")
        .join(people, ["customer_id", "order_purchase_timestamp"], "left_semi")
    )
    lines = _sold_lines(star)
    return (
        split_join(lines, counted(found, "order_id", weight="m"), "order_id", _hot_orders(star, hot))
        .groupBy("product_id")
        .agg(F.sum(matches("m")).alias("n"))
    )


def _sold_first(star: Star, hot: str) -> DataFrame:
    """Sales per product among first orders."""
    lines, firsts = _sold_lines(star), first_orders(star).distinct()
    dealt = _hot_orders(star, hot)
    return counted(split_join(lines, firsts, "order_id", dealt, "left_semi"), "product_id")


def top_categories(
    star: Star, n: int = 5, first_purchase: bool = True, hot: str = MEASURE
) -> DataFrame:
    """Categories by number of order lines; ties go by name.

    ``first_purchase=True`` counts the lines of each person's first order(s).
    ``False`` is the report as it was first written, whose filter has no effect
    on unique orders. Lines without a category or translation form one group.
    ``hot`` is how orders with a large share of the lines are joined (``functions.hot``).
    """
    sold = _sold_first(star, hot) if first_purchase else _sold_all(star, hot)
    return (
        _category_totals(star, sold)
        .orderBy(F.desc("total_sold"), F.asc_nulls_last("category_name_english"))
        .limit(n)
    )


_TOTALS = ("order_item_price", "order_freight", "should_pay")


def _lost(name: str, amount: Column) -> Column:
    """Whether the legacy rule drops a value that is there."""
    return F.col(name).isNotNull() & amount.isNull()


def payment_control_as_written(
    star: Star, legacy_decimal: bool = True, hot: str = MEASURE
) -> DataFrame:
    """The control query as first written: items joined to payments, per order.

    An order with k payments shows k times its item totals, next to its largest payment. A row is one
    item id of an order, with ``occurrences``, the times it comes up among the joined rows, instead of
    one text of all ids; the totals of the order stand on each of its rows. ``lost_lines`` counts the
    joined rows whose price or freight the legacy decimal drops from the sums. Only the totals are
    multiplied, no joined row is built and nothing is gathered per order. ``payment_control_item_texts`` gives the
    text; ``hot`` is how orders with a large share of the lines meet their totals (``functions.hot``).
    """
    price = _amount("price", legacy_decimal)
    freight = _amount("freight_value", legacy_decimal)
    lost = _lost("price", price) | _lost("freight_value", freight)
    ids = star["order_items_fact"].groupBy("order_id", "order_item_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(price).alias("order_item_price"),
        F.sum(freight).alias("order_freight"),
        F.sum(price + freight).alias("should_pay"),
        F.count_if(lost).alias("lost_lines"),
    )
    totals = ids.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in (*_TOTALS, "lost_lines")])
    paid = star["payments_dim"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payments"), F.max("payment_value").alias("payment_value")
    )
    orders = star["orders_dim"].groupBy("order_id").agg(F.count(F.lit(1)).alias("copies"))
    per_order = (
        totals.join(paid, "order_id")
        .join(orders, "order_id")
        .withColumn("times", F.col("payments") * F.col("copies"))
    )
    lines = ids.select("order_id", "order_item_id", "n")
    return (
        split_join(lines, per_order, "order_id", _hot_orders(star, hot))
        .where("times is not null")
        .select(
            "order_id",
            "order_item_id",
            (F.col("n") * F.col("times")).alias("occurrences"),
            *[(F.col(c) * F.col("times")).cast("decimal(38,4)").alias(c) for c in _TOTALS],
            "payment_value",
            (F.col("lost_lines") * F.col("times")).alias("lost_lines"),
        )
    )


def payment_control_item_texts(star: Star, per_piece: int = 1000, hot: str = MEASURE) -> DataFrame:
    """The control query's text of all item ids of an order, ``per_piece`` ids to a row.

    ``piece`` counts from 0 within the order; ``item_ids`` lists ids in ascending order, each as often as it comes
    up among the joined rows, separated by commas; ``n_ids`` is their number.
    """
    ids = payment_control_as_written(star, hot=hot).select("order_id", "order_item_id", "occurrences")
    texts = string_agg(ids, "order_id", "order_item_id", per_piece, times="occurrences")
    return texts.select("order_id", "piece", F.col("n_values").alias("n_ids"), F.col("text").alias("item_ids"))


def payment_control(star: Star) -> DataFrame:
    """What is due against what was paid, for every order of orders_dim exactly once.

    An order without lines owes nothing, one without payments has paid nothing; a missing price or
    freight counts as zero, and ``incomplete_lines`` counts the lines with one. ``difference`` is what
    was paid beyond what was due, or short of it.
    """
    price, freight = (F.coalesce(c, F.lit(0).cast("decimal(18,4)")) for c in ("price", "freight_value"))
    missing = F.col("price").isNull() | F.col("freight_value").isNull()
    items = star["order_items_fact"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("number_of_items"),
        F.count_if(missing).alias("incomplete_lines"),
        F.sum(price).alias("order_item_price"),
        F.sum(freight).alias("order_freight"),
        F.sum(price + freight).alias("should_pay"),
    )
    paid = star["payments_dim"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("number_of_payments"), F.sum("payment_value").alias("payment_value")
    )
    counts = ("number_of_items", "incomplete_lines", "number_of_payments")
    money = (*_TOTALS, "payment_value")
    return (
        star["orders_dim"]
        .select("order_id")
        .where("order_id is not null")
        .distinct()
        .join(items, "order_id", "left")
        .join(paid, "order_id", "left")
        .select(
            "order_id",
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
            *[F.coalesce(c, F.lit(0)).cast("decimal(38,4)").alias(c) for c in money],
        )
        .withColumn("difference", (F.col("payment_value") - F.col("should_pay")).cast("decimal(38,4)"))
    )
