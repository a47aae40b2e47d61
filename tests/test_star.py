"""The eight tables, on hand-made rows."""

from __future__ import annotations

import datetime as dt
import hashlib

from conftest import values

from starcart.operators import star as tables
from starcart.schemas import STAR_TABLES


def _customer(cid, city="a", state="b", zip_code="01", person=None):
    return {
        "customer_id": cid,
        "customer_unique_id": person or f"p-{cid}",
        "customer_city": city,
        "customer_state": state,
        "customer_zip_code_prefix": zip_code,
    }


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_columns_and_types(star_of):
    star = star_of()
    for name, columns in STAR_TABLES.items():
        assert dict(star[name].dtypes) == columns
        assert star[name].columns == list(columns)


def test_location_key_is_md5_of_the_parts_joined(star_of):
    star = star_of(customers=[_customer("1", "rio", "RJ", "00123")])
    assert values(star["location_dim"]) == [(_md5("rioRJ00123"), "rio", "RJ", "00123")]


def test_parts_without_separator_collide_and_with_one_do_not(star_of):
    customers = [_customer("1", "ab", "c", "1"), _customer("2", "a", "bc", "1")]
    assert len({r[0] for r in values(star_of(customers=customers)["location_dim"])}) == 1
    apart = star_of(customers=customers, separator="|")["location_dim"]
    assert {r[0] for r in values(apart)} == {_md5("ab|c|1"), _md5("a|bc|1")}


def test_null_part_gives_null_key_and_the_row_is_kept(star_of):
    star = star_of(customers=[_customer("1", None), _customer("2", None), _customer("3")])
    rows = values(star["location_dim"])
    assert sorted(r[0] is None for r in rows) == [False, True]
    assert len(values(star["customers_dim"])) == 3


def test_locations_are_distinct_customers_are_not(star_of):
    star = star_of(customers=[_customer("1"), _customer("1"), _customer("2")])
    assert star["location_dim"].count() == 1
    assert star["customers_dim"].count() == 3


def test_duplicated_customer_fans_out_only_over_different_places(star_of):
    star = star_of(
        customers=[_customer("1"), _customer("1"), _customer("1", "z")],
        orders=[{"order_id": "o", "customer_id": "1"}, {"order_id": "o", "customer_id": "1"}],
        order_items=[{"order_id": "o", "order_item_id": "1", "price": "5"}] * 2,
    )
    assert sorted(r.location_id for r in star["orders_dim"].collect()) == sorted(
        [_md5("ab01"), _md5("zb01")]
    )
    assert star["order_items_fact"].count() == 2


def test_orders_and_lines_without_match_are_kept(star_of):
    star = star_of(
        orders=[{"order_id": "o", "customer_id": "gone"}, {"order_id": None, "customer_id": None}],
        order_items=[
            {"order_id": "o", "order_item_id": "1"},
            {"order_id": "gone", "order_item_id": "1"},
            {"order_id": None, "order_item_id": "1"},
        ],
    )
    assert star["orders_dim"].count() == 2
    assert star["order_items_fact"].count() == 3
    assert {r.location_id for r in star["order_items_fact"].collect()} == {None}


def test_product_and_category_names(star_of):
    star = star_of(
        products=[
            {"product_id": "p", "product_name_lenght": "40", "product_description_lenght": "287.0"}
        ],
        product_category_name=[
            {"product_category_name": "cama", "product_category_name_english": "bed"}
        ],
    )
    row = star["products_dim"].collect()[0]
    assert (row.product_name_length, row.product_description_length) == (40, 287)
    assert values(star["category_dim"]) == [("cama", "bed")]


def test_default_calendar(spark):
    days = tables.date_dim(spark)
    assert days.count() == 10959
    first = days.orderBy("ddate").first()
    # Saturday; ISO week 52 belongs to the year before
    assert tuple(first) == (dt.date(2000, 1, 1), 2000, 1, 1, 7, 1, 52, 1)
    last = days.orderBy("ddate", ascending=False).first()
    assert tuple(last) == (dt.date(2030, 1, 1), 2030, 1, 1, 3, 1, 1, 1)


def test_calendar_range_is_a_parameter(spark):
    assert tables.date_dim(spark, "2019-12-31", "2020-01-02").count() == 3


def test_calendar_stretches_to_the_orders(star_of):
    star = star_of(
        orders=[
            {"order_id": "1", "order_purchase_timestamp": "1999-12-30 10:00:00"},
            {"order_id": "2", "order_purchase_timestamp": "2030-01-03 10:00:00"},
            {"order_id": "3"},
        ]
    )
    assert tables.date_dim_covering(star["orders_dim"]).count() == 10959 + 2 + 2
    assert tables.date_dim_covering(star_of()["orders_dim"]).count() == 10959
