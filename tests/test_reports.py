"""Reports on hand-made rows, one test per trap of the data model."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import values

from starcart.operators import reports
from starcart.plans.refresh import register_views


def _order(oid, bought=None, arrived=None, status="delivered", customer="c"):
    return {
        "order_id": oid,
        "customer_id": customer,
        "order_status": status,
        "order_purchase_timestamp": bought,
        "order_delivered_customer_date": arrived,
    }


def _item(oid, number, product="p", price="1", freight="0"):
    return {
        "order_id": oid,
        "order_item_id": str(number),
        "product_id": product,
        "price": price,
        "freight_value": freight,
    }


def _payment(oid, number, value):
    return {"order_id": oid, "payment_sequential": str(number), "payment_value": value}


def test_top_products_breaks_ties_by_id(star_of):
    star = star_of(order_items=[_item("o", i, f"p{i % 6}") for i in range(12)])
    top = reports.top_products(star)
    assert top.columns == ["product_id", "number_of_sales"]
    assert values(top) == [(f"p{i}", 2) for i in range(5)]
    assert reports.top_products(star, n=6).count() == 6


def test_orders_outside_the_calendar_have_no_month(star_of):
    orders = [
        _order("1", "1999-12-31 23:59:59"),
        _order("2", "2000-01-01 00:00:00"),
        _order("3", "2030-01-01 12:00:00"),
        _order("4", "2030-01-02 00:00:00"),
        _order("5", None),
    ]
    assert values(reports.orders_by_month(star_of(orders=orders))) == [
        (None, None, 3),
        (2000, 1, 1),
        (2030, 1, 1),
    ]
    wide = star_of(orders=orders, date_start="1990-01-01", date_end="2040-01-01")
    assert values(reports.orders_by_month(wide))[0] == (None, None, 1)


def test_months_sort_as_numbers(star_of):
    star = star_of(orders=[_order(str(m), f"2017-{m:02d}-05 00:00:00") for m in (10, 2, 1)])
    assert [r[1] for r in values(reports.orders_by_month(star))] == [1, 2, 10]


def test_one_city_name_in_two_states_is_one_city(star_of):
    star = star_of(
        customers=[
            {"customer_id": str(i), "customer_city": c, "customer_state": s,
             "customer_zip_code_prefix": "1"}
            for i, (c, s) in enumerate([("x", "A"), ("x", "B"), ("y", "A")])
        ],
        orders=[_order(f"o{i}", customer=str(i % 4)) for i in range(8)],
    )
    assert values(reports.orders_by_city(star)) == [("x", 4), ("y", 2), (None, 2)]


def test_revenue_keeps_large_prices_unless_legacy(star_of):
    star = star_of(
        orders=[_order("o", "2017-03-01 00:00:00")],
        order_items=[
            _item("o", i, price=p)
            for i, p in enumerate(["99999.9999", "100000.0000", "x", None, "0.0001"])
        ],
    )
    assert values(reports.revenue_by_month(star)) == [(2017, 3, Decimal("200000.0000"))]
    assert values(reports.revenue_by_month(star, legacy_decimal=True)) == [
        (2017, 3, Decimal("100000.0000"))
    ]


def test_revenue_counts_a_line_once_per_matching_order_row(star_of):
    star = star_of(
        orders=[
            _order("o", "2017-03-01 00:00:00"),
            _order("o", "2017-03-01 09:00:00"),
            _order("o", "2017-04-01 00:00:00"),
        ],
        order_items=[_item("o", 1, price="2"), _item("o", 2, price="3"), _item("none", 1)],
    )
    assert values(reports.revenue_by_month(star)) == [
        (None, None, Decimal("1.0000")),
        (2017, 3, Decimal("10.0000")),
        (2017, 4, Decimal("5.0000")),
    ]


def test_late_rules(star_of):
    star = star_of(
        orders=[
            _order("midnight", "2017-01-01 23:59:00", "2017-01-02 00:01:00"),
            _order("day", "2017-01-01 10:00:00", "2017-01-02 10:00:00"),
            _order("more", "2017-01-01 10:00:00", "2017-01-02 10:00:01"),
            _order("never", "2017-01-01 10:00:00"),
            _order("other", "2017-01-01 10:00:00", "2017-02-01 10:00:00", status="shipped"),
            _order("soon", "2017-01-01 10:00:00", "2017-01-01 11:00:00"),
        ]
    )
    assert values(reports.late_delivery_pct(star)) == [(Decimal("50.00"),)]
    assert values(reports.late_delivery_pct(star, rule="elapsed")) == [(Decimal("16.67"),)]
    with pytest.raises(ValueError):
        reports.late_delivery_pct(star, rule="weekly")


def test_no_orders_give_no_percentage(star_of):
    for rule in ("calendar", "elapsed"):
        assert values(reports.late_delivery_pct(star_of(), rule=rule)) == [(None,)]


@pytest.fixture
def buyers(star_of):
    """ann has two accounts and ties on her first time; bob's id is also an account."""
    customers = [
        {"customer_id": c, "customer_unique_id": u, "customer_city": "x", "customer_state": "y",
         "customer_zip_code_prefix": "1"}
        for c, u in [("a1", "ann"), ("a2", "ann"), ("b1", "bob"), ("z", None)]
    ]
    orders = [
        _order("first1", "2017-01-01 08:00:00", customer="a1"),
        _order("first2", "2017-01-01 08:00:00", customer="a2"),
        _order("later", "2017-01-01 08:00:01", customer="a1"),
        _order("bobs", "2018-01-01 00:00:00", customer="b1"),
        _order("undated", None, customer="b1"),
        _order("nobody", "2016-01-01 00:00:00", customer="z"),
    ]
    items = [
        _item("first1", 1, "bed"),
        _item("first2", 1, "bed"),
        _item("first2", 2, "untranslated"),
        _item("later", 1, "lamp"),
        _item("later", 2, "lamp"),
        _item("bobs", 1, "nothing"),
        _item("bobs", 2, "unknown product"),
        _item("undated", 1, "lamp"),
        _item("nobody", 1, "lamp"),
    ]
    return star_of(
        customers=customers,
        orders=orders,
        order_items=items,
        products=[
            {"product_id": "bed", "product_category_name": "cama"},
            {"product_id": "lamp", "product_category_name": "luz"},
            {"product_id": "untranslated", "product_category_name": "???"},
            {"product_id": "nothing", "product_category_name": None},
        ],
        product_category_name=[
            {"product_category_name": "cama", "product_category_name_english": "bed"},
            {"product_category_name": "luz", "product_category_name_english": "light"},
        ],
    )


def test_first_orders_keep_ties_and_join_accounts_of_a_person(buyers):
    assert sorted(values(reports.first_orders(buyers))) == [("bobs",), ("first1",), ("first2",)]


def test_categories_of_new_customers(buyers):
    assert values(reports.top_categories(buyers)) == [(None, 3), ("bed", 2)]


def test_categories_as_written_count_every_line(buyers):
    assert values(reports.top_categories(buyers, first_purchase=False)) == [
        ("light", 4),
        (None, 3),
        ("bed", 2),
    ]


def test_as_written_lookup_can_only_multiply(star_of):
    """Where an account id equals a person id, an order found twice counts twice."""
    star = star_of(
        customers=[{"customer_id": "x", "customer_unique_id": "x"}],
        orders=[
            _order("o", "2017-01-01 00:00:00", customer="x", status="delivered"),
            _order("o", "2017-01-01 00:00:00", customer="x", status="shipped"),
        ],
        order_items=[_item("o", 1), _item("o", 2), _item("q", 1)],
    )
    assert values(reports.top_categories(star, first_purchase=False)) == [(None, 5)]
    assert values(reports.top_categories(star)) == [(None, 2)]


@pytest.fixture
def paid(star_of):
    return star_of(
        orders=[_order("o"), _order("unpaid"), _order("empty")],
        order_items=[
            _item("o", 10, price="10.10", freight="1"),
            _item("o", 2, price="20.20", freight=None),
            _item("unpaid", 1),
            _item("not an order", 1),
        ],
        payments=[
            _payment("o", 1, "9.50"),
            _payment("o", 2, "100.00"),
            _payment("o", 3, "0.50"),
            _payment("empty", 1, "7"),
            _payment("not an order", 1, "7"),
        ],
    )


def test_payment_control_has_every_order_once(paid):
    """Orders without lines or payments too; a missing freight counts as zero and is counted."""
    money = [Decimal(x).quantize(Decimal("0.0001")) for x in ("30.30", "1", "31.30", "110", "78.70")]
    rows = {r[0]: tuple(r)[1:] for r in reports.payment_control(paid).collect()}
    assert set(rows) == {"o", "unpaid", "empty"}
    assert rows["o"] == (2, 1, 3, *money)
    assert rows["unpaid"][:3] == (1, 0, 0)
    assert rows["unpaid"][-1] == -rows["unpaid"][-3]
    assert rows["empty"] == (0, 0, 1, *[Decimal(x).quantize(Decimal("0.0001")) for x in (0, 0, 0, 7, 7)])


def test_payment_control_as_written_multiplies_per_payment(paid):
    totals = (Decimal("90.9000"), Decimal("3.0000"), Decimal("33.3000"), Decimal("100.0000"), 0)
    rows = sorted(tuple(r) for r in reports.payment_control_as_written(paid).collect())
    assert rows == [("o", 2, 3, *totals), ("o", 10, 3, *totals)]


def test_payment_control_as_written_counts_what_the_legacy_decimal_drops(star_of):
    star = star_of(
        orders=[_order("o")],
        order_items=[_item("o", 1, price="100000"), _item("o", 2, price="5")],
        payments=[_payment("o", 1, "1"), _payment("o", 2, "1")],
    )
    rows = reports.payment_control_as_written(star).collect()
    assert {(r.order_item_price, r.lost_lines) for r in rows} == {(Decimal("10.0000"), 2)}
    exact = reports.payment_control_as_written(star, legacy_decimal=False).collect()
    assert {(r.order_item_price, r.lost_lines) for r in exact} == {(Decimal("200010.0000"), 0)}


def test_every_column_has_a_name_of_its_own(paid):
    for report in (
        reports.top_products(paid),
        reports.payment_control_as_written(paid),
        reports.revenue_by_month(paid),
    ):
        assert all(c.isidentifier() for c in report.columns)
    assert "revenue" in reports.revenue_by_month(paid).columns


def test_star_can_be_queried_by_name(spark, paid):
    register_views(paid)
    assert values(spark.sql("select count(*) from order_items_fact")) == [(4,)]
