"""The plans are the ones meant: what is shuffled, pruned, split and broadcast."""

from __future__ import annotations

import os
import random
import re

import compare
import oracle
import pytest
from pyspark.sql import functions as F

import starcart as s
from starcart.functions import hot
from starcart.functions.hot import PIECE, distinct_columns, hot_grid, hot_keys, split_join
from starcart.operators import audits
from starcart.operators import star as tables
from starcart.plans.session import RUNTIME_SETTINGS
from starcart.sources.profile import source_profile
from starcart.sources.stores import FileStore
from starcart.sources.tpch import tpch_sources

SF_DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df = df.select("*")
    df.toArrow()
    return plan_of(df).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = FileStore(str(tmp_path_factory.mktemp("star")))
    return s.refresh_star(spark, tpch_sources(spark, SF_DIR), store)


@pytest.fixture
def large_tables(spark):
    """Plan as if no table were small enough to broadcast."""
    off = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in off}
    for key, value in off.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def all_frames(star):
    return {
        "top": s.top_products(star),
        "month": s.orders_by_month(star),
        "city": s.orders_by_city(star),
        "revenue": s.revenue_by_month(star),
        "late": s.late_delivery_pct(star),
        "elapsed": s.late_delivery_pct(star, "elapsed"),
        "categories": s.top_categories(star),
        "categories as written": s.top_categories(star, first_purchase=False),
        "control": s.payment_control(star),
        "control as written": s.payment_control_as_written(star),
        "primary keys": audits.primary_key_violations(star),
        "foreign keys": audits.foreign_key_violations(star),
    }


def test_no_cross_join_no_python_and_no_window(spark, stored, large_tables):
    frames = {**all_frames(stored), "profile": source_profile(tpch_sources(spark, SF_DIR))}
    for name, df in frames.items():
        plan = plan_of(df)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window", "Scan Existing"):
            assert word not in plan, (name, word)


def test_top_lists_are_not_sorted_as_a_whole(stored):
    for df in (s.top_products(stored), s.top_categories(stored)):
        plan = plan_of(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_scans_read_only_what_a_report_needs(stored):
    def read(df):
        return [
            set(re.findall(r"(\w+):", m))
            for m in re.findall(r"ReadSchema: struct<(.*?)>(?:\s|$)", df._jdf.queryExecution().toString())
        ]

    assert read(s.top_products(stored)) == [{"product_id"}]
    assert {"order_id", "product_id"} in read(s.top_categories(stored))
    assert {"order_id", "price"} in read(s.revenue_by_month(stored))


def test_prices_are_summed_per_order_in_the_shuffle_of_the_join(stored, large_tables):
    plan = plan_of(s.revenue_by_month(stored))
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+, \d+\)", plan)) == 2
    # partial sums leave the scan of the fact, not its rows
    assert re.search(r"partial_sum\(price#\d+\)", plan)


def test_payment_control_shuffles_each_table_once(stored, large_tables):
    assert plan_of(s.payment_control(stored)).count("Exchange ") == 3


def test_payment_control_as_written_gathers_nothing(stored, large_tables):
    plan = plan_of(s.payment_control_as_written(stored))
    assert "collect_list(order_item_id" not in plan and "_piece" in plan
    assert re.search(r"hashpartitioning\(order_id#\d+, order_item_id#\d+, \d+\)", plan)


def test_payment_control_with_a_third_of_the_lines_in_one_order(spark, hot_sources, split_early):
    star = s.build_star(spark, s.load_sources(spark, hot_sources, "parquet"))
    hot = s.payment_control_as_written(star).where("order_id = '7'")
    lines = star["order_items_fact"].where("order_id = '7'")
    payments = star["payments_dim"].where("order_id = '7'").count()
    assert hot.count() == lines.select("order_item_id").distinct().count()
    assert hot.agg(F.sum("occurrences")).first()[0] == lines.count() * payments


def test_late_share_is_one_scan(stored):
    plan = plan_of(s.late_delivery_pct(stored))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange ") == 1 and "Exchange SinglePartition" in plan


def test_first_orders_use_semi_joins_and_read_accounts_once(stored, large_tables):
    assert "LeftSemi" in plan_of(s.top_categories(stored))
    assert "LeftSemi" in plan_of(s.top_categories(stored, first_purchase=False))
    plan = final_plan(s.top_categories(stored))
    # one scan each of fact, products, categories and customers, two of the orders:
    # the branch that is needed twice is shuffled once and reused
    assert plan.count("ReusedExchange") == 2
    assert plan.count("FileScan") == 6


def test_calendar_is_broadcast_by_its_size(stored):
    for df in (s.orders_by_month(stored), s.revenue_by_month(stored)):
        assert re.search(r"BroadcastHashJoin \[ddate#\d+\]", plan_of(df))
        assert "ResolvedHint" not in df._jdf.queryExecution().toString()


def test_distinct_of_the_loads_has_no_shuffle_of_its_own(spark, large_tables):
    sources = tpch_sources(spark, SF_DIR)
    locations = spark.range(100).selectExpr("cast(id as string) order_id", "'x' location_id")
    fact = plan_of(tables.order_items_fact(sources["order_items"], locations))
    assert len(re.findall(r"Exchange hashpartitioning", fact)) == 2  # one per side of the join
    assert len(re.findall(r"hashpartitioning\(order_id#\d+, \d+\)", fact)) == 2


def test_fact_load_does_not_compute_deliveries(spark):
    """Only ids of the orders are read; the per-order ship dates are pruned away."""
    star = s.build_star(spark, tpch_sources(spark, SF_DIR), hot="adaptive")
    plan = plan_of(star["order_items_fact"])
    assert plan.count("FileScan") == 5  # lineitem, orders, customer, nation, region
    assert "min(l_shipdate" not in plan


# -- hot keys ---------------------------------------------------------------------


def third(column, value, *spread):
    """``column``, with a third of its rows set to ``value``."""
    return F.when(F.xxhash64(*spread) % 3 == 0, F.lit(value)).otherwise(F.col(column))


@pytest.fixture(scope="module")
def hot_sources(spark, tmp_path_factory):
    """A third of the lines in one order and of one product, a third of the orders
    from one customer; stored, so that Spark and DuckDB read the same rows."""
    root = str(tmp_path_factory.mktemp("hot"))
    sources = dict(tpch_sources(spark, SF_DIR))
    items, orders = sources["order_items"], sources["orders"]
    line = ["order_id", "order_item_id", "product_id", "price"]
    sources["order_items"] = items.select(
        third("order_id", "7", *line).alias("order_id"),
        "order_item_id",
        third("product_id", "11", F.lit("p"), *line).alias("product_id"),
        *[c for c in items.columns if c not in ("order_id", "order_item_id", "product_id")],
    )
    sources["orders"] = orders.withColumn("customer_id", third("customer_id", "5", "order_id"))
    for name, df in sources.items():
        df.repartition(8).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def split_early(spark, large_tables):
    """Skew thresholds for tables of a few megabytes instead of terabytes."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key in small:
        spark.conf.set(key, RUNTIME_SETTINGS.get(key, "4"))


def test_hot_join_keys_are_split_where_the_distinct_shares_the_shuffle(
    spark, hot_sources, split_early
):
    star = s.build_star(spark, s.load_sources(spark, hot_sources, "parquet"), hot="adaptive")
    for name in ("orders_dim", "order_items_fact"):
        assert "skew=true" in final_plan(star[name]), name


def hot_list(spark, rows):
    return spark.createDataFrame(rows, "_hot string, _pieces long")


def test_hot_keys_are_found_by_their_share(spark, hot_sources):
    items = s.load_sources(spark, hot_sources, "parquet")["order_items"]
    rows, lines = items.count(), items.filter("order_id = '7'").count()
    assert hot_keys(items, "order_id", 16).collect() == [("7", -(-lines * 16 // rows) + 1)]
    nulls = items.withColumn("order_id", F.lit(None).cast("string"))
    assert hot_keys(nulls, "order_id", 4).collect() == [(None, 5)]
    assert hot_keys(items.limit(0), "order_id", 4).collect() == []


def test_no_hot_key_is_left_out(spark):
    """More than a thousand keys, each with several fair shares."""
    many = spark.range(1500 * 40).selectExpr(
        "if(id % 2 = 0, cast(id % 3000 as string), concat('rare', id)) as order_id"
    )
    found = hot_keys(many, "order_id", 20_000).collect()
    assert {r[0] for r in found} == {str(k) for k in range(0, 3000, 2)}


def test_hot_keys_in_pieces_give_the_same_tables(spark, hot_sources, split_early):
    sources = dict(s.load_sources(spark, hot_sources, "parquet"))
    # besides the hot key: rows without a key, and equal rows
    lost = sources["order_items"].limit(500).withColumn("order_id", F.lit(None).cast("string"))
    sources["order_items"] = sources["order_items"].unionAll(lost).unionAll(lost)
    plain = s.build_star(spark, sources, hot="adaptive")
    customers = hot_list(spark, [("5", 7), (None, 3)])
    orders = hot_list(spark, [("7", 9), (None, 4), ("not there", 2)])
    pieces = {
        "orders_dim": tables.orders_dim(sources["orders"], sources["customers"], "", customers),
        "order_items_fact": tables.order_items_fact(
            sources["order_items"],
            tables.order_locations(sources["orders"], sources["customers"], "", customers),
            orders,
        ),
    }
    for name, df in pieces.items():
        assert df.columns == plain[name].columns
        assert compare.differences(df.toArrow(), plain[name].toArrow()) == [], name


def test_registered_loads_deal_hot_keys(spark):
    """At any size: the path that is checked is the one that runs at 100 TB."""
    star = s.build_star(spark, tpch_sources(spark, SF_DIR))
    frames = [star["orders_dim"], star["order_items_fact"], s.top_categories(star), s.top_categories(star, 5, False)]
    for df in frames:
        plan = plan_of(df)
        assert "_piece" in plan
        assert "approx_top_k" in plan
    with pytest.raises(ValueError):
        s.top_categories(star, hot="sometimes")


def test_hot_orders_in_pieces_give_the_same_categories(spark, hot_sources, split_early):
    star = s.build_star(spark, s.load_sources(spark, hot_sources, "parquet"))
    for first in (True, False):
        plain = s.top_categories(star, 100, first, hot="adaptive")
        pieces = s.top_categories(dict(star), 100, first)  # the container makes no difference
        assert "_piece" in plan_of(pieces)
        assert pieces.collect() == plain.collect()


def test_pieces_need_no_further_shuffle(spark, large_tables):
    items = tpch_sources(spark, SF_DIR)["order_items"]
    locations = spark.range(100).selectExpr("cast(id as string) order_id", "'x' location_id")
    plan = plan_of(tables.order_items_fact(items, locations, hot_list(spark, [("7", 9)])))
    assert len(re.findall(r"hashpartitioning\(order_id#\d+, _piece#\d+L, \d+\)", plan)) == 2
    assert plan.count("Exchange hashpartitioning") == 2


def test_pieces_of_a_hot_key_are_about_equal(spark, hot_sources):
    items = s.load_sources(spark, hot_sources, "parquet")["order_items"]
    none = items.select("order_id").filter("false")
    dealt = split_join(items, none, "order_id", hot_list(spark, [("7", 8)]))
    sizes = [r[1] for r in dealt.filter("order_id = '7'").groupBy(PIECE).count().collect()]
    assert len(sizes) == 8
    assert max(sizes) < 1.2 * sum(sizes) / 8


def test_results_with_hot_keys(spark, hot_sources, split_early):
    db = compare.duckdb.connect()
    for name in s.load_sources(spark, hot_sources, "parquet"):
        db.execute(
            f"create view src_{name} as select * from '{hot_sources}/{name}.parquet/*.parquet'"
        )
    star = s.build_star(spark, s.load_sources(spark, hot_sources, "parquet"))
    frames = {
        "report_top_products": s.top_products(star),
        "report_orders_by_city": s.orders_by_city(star),
        "report_revenue_by_month": s.revenue_by_month(star),
        "report_top_categories_new_customers": s.top_categories(star),
        "report_top_categories_as_written": s.top_categories(star, first_purchase=False),
        "report_payment_control": s.payment_control(star),
        "report_payment_control_as_written": s.payment_control_as_written(star),
    }
    for name, df in frames.items():
        theirs = db.sql(f"with {oracle.star_ctes()} {oracle.REPORTS[name]}").to_arrow_table()
        assert compare.differences(df.toArrow(), theirs) == [], name


def test_hot_key_is_one_row_per_task_before_the_shuffle(spark, hot_sources, split_early):
    """Grouped sides leave each map task with at most one row per key."""
    star = s.build_star(spark, s.load_sources(spark, hot_sources, "parquet"))
    for df, count in (
        (s.orders_by_city(star), "location_id"),
        (s.top_products(star), "product_id"),
    ):
        assert re.search(
            rf"HashAggregate\(keys=\[{count}#\d+\], functions=\[partial_count", plan_of(df)
        )


def test_foreign_key_audit_reads_each_stored_table_once(stored, large_tables):
    plan = plan_of(audits.foreign_key_violations(stored))
    assert plan.count("FileScan") == 8


# -- keys that are hot on both sides --------------------------------------------------


@pytest.fixture
def sixteen(spark):
    """Sixteen shuffle partitions as they come, without the run-time merging and splitting of tasks."""
    given = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in given}
    for key, value in given.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _tasks(df):
    return sorted(r[1] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_customer_with_many_places_and_a_third_of_the_orders(spark, sixteen):
    """The joined rows, 3,000 x 4,000 for one key, are dealt evenly; plain pieces would repeat every place."""
    orders = spark.range(12_000).selectExpr(
        "cast(id as string) order_id", "if(id % 3 = 0, 'c', concat('x', id)) customer_id"
    )
    places = spark.range(3_000).selectExpr("'c' customer_id", "cast(id as string) location_id").unionAll(
        spark.range(12_000).selectExpr("concat('x', id) customer_id", "'one' location_id")
    )
    grid = hot_grid(orders, places, "customer_id")
    (cell,) = grid.collect()
    assert cell[0] == "c" and 1 < cell._columns < cell._pieces
    joined = split_join(orders, places, "customer_id", grid)
    sizes = _tasks(joined)
    assert sum(sizes) == 4_000 * 3_000 + 8_000
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[7]
    # the rows that travel for it stay few: no more than the joined rows of one task
    assert cell._columns * 4_000 + cell._pieces * 3_000 < sizes[7]


def test_a_key_with_many_places_and_few_orders(spark, sixteen):
    """No task reads all of its places."""
    orders = spark.range(1_600).selectExpr("cast(id as string) order_id", "concat('x', id) customer_id")
    places = spark.range(9_000).selectExpr(
        "if(id % 3 = 0, 'x5', concat('x', id)) customer_id", "cast(id as string) location_id"
    )
    (cell,) = hot_grid(orders, places, "customer_id").collect()
    assert cell[0] == "x5" and cell._columns >= 6
    assert max(_tasks(split_join(orders, places, "customer_id", hot_grid(orders, places, "customer_id")))) < 900


@pytest.mark.parametrize("seed", range(4))
def test_a_grid_joins_like_a_plain_join(spark, seed):
    rng = random.Random(seed)
    keys = ["a", "a", "a", "b", "b", "c", "d", "e", None]
    left = [(rng.choice(keys), rng.randint(0, 3)) for _ in range(rng.randint(0, 60))]
    right = [(rng.choice([*keys, "z", "z", "z"]), rng.randint(0, 3)) for _ in range(rng.randint(0, 60))]
    big = spark.createDataFrame(left, "k string, v int")
    lookup = spark.createDataFrame(right, "k string, w int")
    plain = big.join(lookup, "k", "left")
    made = [(k, r, c) for k, r, c in [("a", 3, 2), ("b", 1, 4), (None, 2, 1)] if k is None or k in {r[0] for r in right}]
    given = spark.createDataFrame(made, "_hot string, _pieces long, _columns long")
    for grid in (hot_grid(big, lookup, "k"), given):
        joined = split_join(big, lookup, "k", grid)
        assert sorted(map(str, joined.drop(PIECE).collect())) == sorted(map(str, plain.collect()))
        assert distinct_columns(joined, ["k", "v", "w"]).count() == plain.distinct().count()
    with pytest.raises(ValueError):
        split_join(big, lookup, "k", given, "left_semi")


def test_more_keys_than_one_sketch_follows(spark, monkeypatch):
    monkeypatch.setattr(hot, "_MOST_FOLLOWED", 1000)
    many = spark.range(90_000).selectExpr("if(id % 2 = 0, cast(id % 300 as string), concat('rare', id)) as k")
    found = {r[0] for r in hot_keys(many, "k", 600).collect()}
    assert found == {str(k) for k in range(0, 300, 2)}
