"""Column names and types of the six source tables and the eight star tables.

Sources may be text (CSV); the types here are what the loader turns them into.
Timestamps carry no zone in the sources, so they are ``timestamp_ntz`` and no
result depends on the session time zone. Money is ``decimal(18,4)``.
"""

from __future__ import annotations

MONEY = "decimal(18,4)"

_ORDER_TIMES = {
    "order_purchase_timestamp": "timestamp_ntz",
    "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
}

_PRODUCT_MEASURES = {
    "product_photos_qty": "int",
    "product_weight_g": "int",
    "product_length_cm": "int",
    "product_height_cm": "int",
    "product_width_cm": "int",
}

_PAYMENT = {
    "order_id": "string",
    "payment_sequential": "int",
    "payment_type": "string",
    "payment_installments": "int",
    "payment_value": MONEY,
}

SOURCE_TABLES: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",  # leading zeros matter
        "customer_city": "string",
        "customer_state": "string",
    },
    "orders": {
        "order_id": "string",
        "index": "bigint",
        "customer_id": "string",
        "order_status": "string",
        **_ORDER_TIMES,
    },
    "order_items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": MONEY,
        "freight_value": MONEY,
    },
    "payments": _PAYMENT,
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_lenght": "int",  # spelt this way in the files
        "product_description_lenght": "int",  # spelt this way in the files
        **_PRODUCT_MEASURES,
    },
    "product_category_name": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}

STAR_TABLES: dict[str, dict[str, str]] = {
    "location_dim": {
        "location_id": "string",
        "location_city": "string",
        "location_state": "string",
        "location_zip_code_prefix": "string",
    },
    "customers_dim": {
        "location_id": "string",
        "customer_id": "string",
        "customer_unique_id": "string",
    },
    "orders_dim": {
        "order_id": "string",
        "location_id": "string",
        "index": "bigint",
        "customer_id": "string",
        "order_status": "string",
        **_ORDER_TIMES,
    },
    "payments_dim": _PAYMENT,
    "products_dim": {
        "product_id": "string",
        "product_category_name": "string",
        "product_name_length": "int",
        "product_description_length": "int",
        **_PRODUCT_MEASURES,
    },
    "category_dim": {
        "category_name": "string",
        "category_name_english": "string",
    },
    "date_dim": {
        "ddate": "date",
        "year": "int",
        "month": "int",
        "day": "int",
        "weekday": "int",  # Sunday = 1
        "yearday": "int",
        "week": "int",  # ISO week: (year, week) is not a calendar pair
        "quarter": "int",
    },
    "order_items_fact": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "location_id": "string",
        "shipping_limit_date": "timestamp_ntz",
        "price": MONEY,
        "freight_value": MONEY,
    },
}

# Keys the data model declares. The load does not enforce them; the audits
# report where the data break them.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "location_dim": ("location_id",),
    "customers_dim": ("customer_id",),
    "orders_dim": ("order_id",),
    "payments_dim": ("order_id", "payment_sequential"),
    "products_dim": ("product_id",),
    "category_dim": ("category_name",),
    "date_dim": ("ddate",),
    "order_items_fact": ("order_id", "order_item_id"),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("order_items_fact", "order_id", "orders_dim", "order_id"),
    ("order_items_fact", "product_id", "products_dim", "product_id"),
    ("order_items_fact", "location_id", "location_dim", "location_id"),
    ("customers_dim", "location_id", "location_dim", "location_id"),
    ("orders_dim", "customer_id", "customers_dim", "customer_id"),
    ("orders_dim", "order_purchase_timestamp", "date_dim", "ddate"),
    ("payments_dim", "order_id", "orders_dim", "order_id"),
    ("products_dim", "product_category_name", "category_dim", "category_name"),
)
