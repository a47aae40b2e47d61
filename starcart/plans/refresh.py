"""Building a whole star and keeping it in a store."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from starcart.functions.hot import ADAPTIVE, MEASURE, any_hot, measured
from starcart.functions.lazy import LazyTables
from starcart.operators import star as tables
from starcart.schemas import STAR_TABLES
from starcart.sources.versions import VersionedStore


class Store(Protocol):
    exact: bool

    def write(self, df: DataFrame, table: str) -> None: ...

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...


def build_star(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    date_start: str = tables.CALENDAR_START,
    date_end: str = tables.CALENDAR_END,
    separator: str = "",
    hot: str = MEASURE,
    covering: bool = False,
) -> LazyTables:
    """All eight tables, as plans; nothing is read until a table is used.

    ``hot`` is how the loads treat hot customers and orders (``functions.hot``). ``covering`` stretches
    the calendar to the purchases.
    """

    def located_orders() -> DataFrame:
        return tables.order_locations(
            sources["orders"],
            sources["customers"],
            separator,
            measured(sources["orders"], "customer_id", hot, sources["customers"]),
        )

    def calendar() -> DataFrame:
        if covering:
            return tables.date_dim_covering(sources["orders"], date_start, date_end)
        return tables.date_dim(spark, date_start, date_end)

    return LazyTables(
        {
            "location_dim": lambda: tables.location_dim(sources["customers"], separator),
            "customers_dim": lambda: tables.customers_dim(sources["customers"], separator),
            "orders_dim": lambda: tables.orders_dim(
                sources["orders"],
                sources["customers"],
                separator,
                measured(sources["orders"], "customer_id", hot, sources["customers"]),
            ),
            "payments_dim": lambda: tables.payments_dim(sources["payments"]),
            "products_dim": lambda: tables.products_dim(sources["products"]),
            "category_dim": lambda: tables.category_dim(sources["product_category_name"]),
            "date_dim": calendar,
            "order_items_fact": lambda: tables.order_items_fact(
                sources["order_items"],
                located_orders(),
                measured(sources["order_items"], "order_id", hot, sources["orders"]),
            ),
        },
        counted_from={"order_items_fact": lambda: sources["order_items"]},
    )


def write_star(star: Mapping[str, DataFrame], store: Store, at_once: int = 4) -> None:
    """Replace every table of the store, ``at_once`` at a time, without a transaction.

    Spark shares its tasks among the writes; a failed one is raised after the others have ended.
    """
    frames = dict(star.items())
    with ThreadPoolExecutor(at_once) as pool:
        done = [pool.submit(store.write, df, name) for name, df in frames.items()]
    for one in done:
        one.result()


def read_star(spark: SparkSession, store: Store) -> LazyTables:
    """All eight tables of the store, typed."""
    return LazyTables({name: partial(store.read, spark, name) for name in STAR_TABLES})


def refresh_star(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    store: Store,
    date_start: str = tables.CALENDAR_START,
    date_end: str = tables.CALENDAR_END,
    separator: str = "",
    hot: str = MEASURE,
    covering: bool = False,
) -> LazyTables:
    """Build, write and re-read the star.

    Where the store gives back exactly what it got, the fact takes the place of
    each order from the orders_dim just written, and so neither customers nor
    orders are read and joined a second time. Where no order is hot, the pairs of order
    and place travel once: they are made unique where they meet the lines.
    """
    star = build_star(spark, sources, date_start, date_end, separator, hot, covering)
    write_star({name: star[name] for name in star if name != "order_items_fact"}, store)
    if store.exact:
        places = store.read(spark, "orders_dim").select("order_id", "location_id")
        dealt = any_hot(measured(sources["order_items"], "order_id", hot, places))
        # with hot orders, counted or not, pairs are made unique before they travel to the lines
        if hot != ADAPTIVE and dealt is None:
            places = places.where("order_id is not null").repartition("order_id")
        fact = tables.order_items_fact(sources["order_items"], places.distinct(), dealt)
    else:
        fact = star["order_items_fact"]
    store.write(fact, "order_items_fact")
    return read_star(spark, store)


def publish_star(
    spark: SparkSession, sources: Mapping[str, DataFrame], versions: VersionedStore, **options
) -> LazyTables:
    """``refresh_star`` into a new version that is published when all of it is written.

    Until then, and if anything fails, readers of ``versions.at(spark)`` get the version before.
    """
    version = versions.begin()
    star = refresh_star(spark, sources, version, **options)
    versions.publish(spark, version)
    return star


def register_views(star: Mapping[str, DataFrame]) -> None:
    """Make every table available to ``spark.sql`` under its own name."""
    for name, df in star.items():
        df.createOrReplaceTempView(name)
