"""Star-schema ETL and reporting for e-commerce orders, as plain PySpark jobs."""

from starcart.operators.reports import (
    late_delivery_pct,
    orders_by_city,
    orders_by_month,
    payment_control,
    payment_control_as_written,
    revenue_by_month,
    top_categories,
    top_products,
)
from starcart.plans.refresh import (
    build_star,
    publish_star,
    read_star,
    refresh_star,
    register_views,
    write_star,
)
from starcart.plans.session import prepare
from starcart.sources.files import load_sources
from starcart.sources.stores import FileStore, JdbcStore
from starcart.sources.versions import VersionedStore

__all__ = [
    "FileStore",
    "JdbcStore",
    "VersionedStore",
    "build_star",
    "late_delivery_pct",
    "load_sources",
    "orders_by_city",
    "orders_by_month",
    "payment_control",
    "payment_control_as_written",
    "prepare",
    "publish_star",
    "read_star",
    "refresh_star",
    "register_views",
    "revenue_by_month",
    "top_categories",
    "top_products",
    "write_star",
]
