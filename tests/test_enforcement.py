"""Rows that keep the declared keys, and the quarantine."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starcart.operators import audits
from starcart.operators.enforcement import NULL_KEY, REPEATED, enforce, enforcement_counts, parents_first
from starcart.schemas import FOREIGN_KEYS, PRIMARY_KEYS


def test_parents_come_first():
    order = parents_first()
    assert all(order.index(parent) < order.index(child) for child, _, parent, _ in FOREIGN_KEYS)


def _spoilt(star_of, rng, n):
    pick = lambda *some: rng.choice(some)
    return star_of(
        date_end="2000-02-01",
        customers=[{"customer_id": pick("c1", "c2", "c3", None), "customer_city": pick("a", "b", None),
                    "customer_state": "s", "customer_zip_code_prefix": "1"} for _ in range(n // 4)],
        orders=[{"order_id": pick(*(f"o{i}" for i in range(12)), None), "customer_id": pick("c1", "c2", "gone", None),
                 "order_purchase_timestamp": pick("2000-01-05", "1999-01-01", None, "2000-01-06 10:00:00")}
                for _ in range(n // 2)],
        order_items=[{"order_id": pick(*(f"o{i}" for i in range(12)), "gone", None), "order_item_id": pick("1", "2", None),
                      "product_id": pick("p1", "p2", "gone", None), "price": pick("1", "2", None)} for _ in range(n)],
        payments=[{"order_id": pick("o1", "o2", "gone"), "payment_sequential": pick("1", "2")} for _ in range(n // 4)],
        products=[{"product_id": pick("p1", "p2", "p3"), "product_category_name": pick("x", "y", None)} for _ in range(6)],
        product_category_name=[{"product_category_name": "x", "product_category_name_english": pick("X", "Z")}] * 2,
    )


@pytest.mark.parametrize("seed", range(2))
def test_nothing_is_lost_and_what_is_accepted_keeps_its_keys(star_of, seed):
    star = _spoilt(star_of, random.Random(seed), 80)
    done = enforce(star, hot=("measure", "adaptive")[seed % 2])
    for name, df in star.items():
        kept, left = done.accepted[name], done.quarantine[name]
        rows = Counter(tuple(r) for r in kept.collect())
        for r in left.collect():
            *row, copies, reasons = r
            assert copies > 0 and reasons
            rows[tuple(row)] += copies
        assert rows == Counter(tuple(r) for r in df.collect()), name
        key = PRIMARY_KEYS[name]
        # a key is given up only where no sound row has it
        sound = left.where(F.array_contains("reasons", REPEATED)).select(*key).distinct()
        assert sound.join(kept, list(key), "left_anti").count() == 0
    for r in audits.primary_key_violations(done.accepted).collect():
        assert (r.null_key_rows, r.repeated_keys, r.surplus_rows) == (0, 0, 0), r
    for r in audits.foreign_key_violations(done.accepted).collect():
        assert (r.orphan_rows, r.orphan_keys) == (0, 0), r


def test_reasons_and_the_winner(spark, star_of):
    rows = [{"order_id": "o", "order_item_id": "1", "price": str(p)} for p in (1, 2, 3, 3)]
    rows += [{"order_id": None, "order_item_id": "1", "product_id": "gone"}, {"order_id": "gone", "order_item_id": "2"}]
    star = star_of(orders=[{"order_id": "o"}], order_items=rows)
    star = {name: star[name] for name in ("orders_dim", "products_dim", "order_items_fact")}
    winners = set()
    for partitions in (1, 7):
        given = {**star, "order_items_fact": star["order_items_fact"].unionAll(star["order_items_fact"]).repartition(partitions)}
        done = enforce(given)
        (winner,) = done.accepted["order_items_fact"].collect()
        winners.add(winner)
        left = {(str(r.price), r.order_id): (r.copies, r.reasons) for r in done.quarantine["order_items_fact"].collect()}
        lost = ["no products_dim.product_id for product_id"]
        assert left["None", None] == (2, [NULL_KEY, *lost])
        assert left["None", "gone"] == (2, ["no orders_dim.order_id for order_id"])
        for price in ("1.0000", "2.0000", "3.0000"):
            # the fact was made distinct when it was built, then doubled
            assert left[price, "o"] == (1 if str(winner.price) == price else 2, [REPEATED])
    assert len(winners) == 1


def test_a_parent_in_quarantine_answers_no_reference(star_of):
    star = star_of(
        orders=[{"order_id": "o", "customer_id": "gone"}],
        order_items=[{"order_id": "o", "order_item_id": "1"}],
        payments=[{"order_id": "o", "payment_sequential": "1"}],
    )
    star = {name: star[name] for name in ("customers_dim", "orders_dim", "payments_dim", "order_items_fact")}
    counts = {(r.table_name, r.verdict): r.row_count for r in enforcement_counts(enforce(star)).collect()}
    assert counts["orders_dim", "no customers_dim.customer_id for customer_id"] == 1
    assert counts["order_items_fact", "no orders_dim.order_id for order_id"] == 1
    assert counts["payments_dim", "no orders_dim.order_id for order_id"] == 1
    assert ("orders_dim", "accepted") not in counts


def test_a_key_with_a_third_of_the_rows(spark, star_of):
    star = {"orders_dim": star_of(orders=[{"order_id": f"o{i}"} for i in range(50)])["orders_dim"]}
    fact = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 'o1', concat('o', id % 50)) order_id", "cast(if(id % 3 = 0, 1, id) as int) order_item_id",
        "cast(null as string) product_id", "'s' seller_id", "cast(null as string) location_id",
        "cast(null as timestamp_ntz) shipping_limit_date", "cast(id as decimal(18,4)) price",
        "cast(1 as decimal(18,4)) freight_value",
    )
    done = enforce({**star, "order_items_fact": fact})
    assert done.accepted["order_items_fact"].count() == 6000
    assert done.quarantine["order_items_fact"].agg(F.sum("copies")).first()[0] == 3000


@pytest.mark.parametrize("hot_share", [0, 3])
def test_rows_do_not_travel_again_and_the_least_sound_row_stays(spark, star_of, capsys, hot_share):
    star = {name: star_of(orders=[{"order_id": f"o{i}"} for i in range(60)], products=[{"product_id": "p"}])[name]
            for name in ("orders_dim", "products_dim")}
    some = f"{hot_share} > 0 and id % 3 = 0"
    fact = spark.range(1200).selectExpr(
        f"if({some}, 'o1', concat('o', id % 60)) order_id", f"cast(if({some}, 1, id div 180) as int) order_item_id",
        "if(id % 7 < 3, 'gone', 'p') product_id", "'s' seller_id", "cast(null as string) location_id",
        "cast(null as timestamp_ntz) shipping_limit_date", "cast(id % 400 as decimal(18,4)) price",
        "cast(1 as decimal(18,4)) freight_value",
    )
    done = enforce({**star, "order_items_fact": fact})
    name, key = "order_items_fact", ("order_id", "order_item_id")
    best: dict = {}
    counts = Counter()
    for r in fact.withColumn("h", F.xxhash64(*fact.columns)).collect():
        counts[tuple(r)[:-1]] += 1
        if r.product_id == "p":
            best[r[0], r[1]] = min(best.get((r[0], r[1]), (r.h, tuple(r)[:-1])), (r.h, tuple(r)[:-1]))
    assert sorted(map(tuple, done.accepted[name].collect())) == sorted(row for _, row in best.values())
    assert done.accepted[name].select(*key).distinct().count() == len(best)
    for _, row in best.values():
        counts[row] -= 1
    left = Counter()
    for *row, copies, reasons in done.quarantine[name].collect():
        left[tuple(row)] += copies
        assert reasons == [REPEATED if row[2] == "p" else "no products_dim.product_id for product_id"]
    assert left == +counts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done.quarantine["orders_dim"].explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
