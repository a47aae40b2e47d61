"""DuckDB SQL that says, over the given tables, what each registered query returns.

Written as plain joins over plain rows: no grouping before a join, so that it does
not share the shape of the Spark plans it checks.
"""

from __future__ import annotations

MONEY = "decimal(18,4)"

SOURCES = f"""
src_customers as (
  select cast(c_custkey as varchar) as customer_id,
         'U' || cast(c_custkey // 2 as varchar) as customer_unique_id,
         lpad(cast(c_custkey % 100 as varchar), 5, '0') as customer_zip_code_prefix,
         n_name as customer_city, r_name as customer_state
  from customer
  left join nation on c_nationkey = n_nationkey
  left join region on n_regionkey = r_regionkey
),
src_orders as (
  select cast(o_orderkey as varchar) as order_id, cast(o_orderkey as bigint) as "index",
         cast(o_custkey as varchar) as customer_id,
         case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
                            when 'P' then 'processing' end as order_status,
         o_orderdate as order_purchase_timestamp, o_orderdate as order_approved_at,
         first_ship as order_delivered_carrier_date, last_ship as order_delivered_customer_date,
         o_orderdate + interval 30 day as order_estimated_delivery_date
  from orders
  left join (select l_orderkey, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship
             from lineitem group by l_orderkey) on o_orderkey = l_orderkey
),
src_order_items as (
  select cast(l_orderkey as varchar) as order_id, cast(l_linenumber as integer) as order_item_id,
         cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
         l_shipdate as shipping_limit_date, cast(l_extendedprice as {MONEY}) as price,
         cast(l_quantity as {MONEY}) as freight_value
  from lineitem
),
src_payments as (
  select cast(o_orderkey as varchar) as order_id, 1 as payment_sequential,
         o_orderpriority as payment_type, 1 as payment_installments,
         cast(o_totalprice as {MONEY}) as payment_value
  from orders
  union all
  select cast(o_orderkey as varchar), 2, o_orderpriority, 1, cast(0 as {MONEY})
  from orders where o_orderkey % 10 = 0
),
src_products as (
  select cast(p_partkey as varchar) as product_id, p_type as product_category_name,
         cast(length(p_name) as integer) as product_name_lenght,
         cast(null as integer) as product_description_lenght,
         cast(null as integer) as product_photos_qty, cast(p_size as integer) as product_weight_g,
         cast(null as integer) as product_length_cm, cast(null as integer) as product_height_cm,
         cast(null as integer) as product_width_cm
  from part
),
src_product_category_name as (
  select distinct p_type as product_category_name, lower(p_type) as product_category_name_english
  from part where p_type <> 'PROMO'
)"""


def _days(first: str, last: str) -> str:
    return f"""
  select cast(d as date) as ddate, cast(year(d) as integer) as "year",
         cast(month(d) as integer) as "month", cast(day(d) as integer) as "day",
         cast(dayofweek(d) + 1 as integer) as weekday, cast(dayofyear(d) as integer) as yearday,
         cast(weekofyear(d) as integer) as "week", cast(quarter(d) as integer) as "quarter"
  from (select unnest(generate_series({first}, {last}, interval 1 day)) as d)"""


def star_ctes(first: str = "date '2000-01-01'", last: str = "date '2030-01-01'") -> str:
    """The star over the ``src_`` tables."""
    return f"""located as (
  select *, md5(customer_city || customer_state || customer_zip_code_prefix) as location_id
  from src_customers
),
location_dim as (
  select distinct location_id, customer_city as location_city, customer_state as location_state,
         customer_zip_code_prefix as location_zip_code_prefix
  from located
),
customers_dim as (select location_id, customer_id, customer_unique_id from located),
orders_dim as (
  select distinct o.order_id, c.location_id, o."index", o.customer_id, o.order_status,
         o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
         o.order_delivered_customer_date, o.order_estimated_delivery_date
  from src_orders o left join located c on o.customer_id = c.customer_id
),
payments_dim as (select * from src_payments),
products_dim as (
  select product_id, product_category_name, product_name_lenght as product_name_length,
         product_description_lenght as product_description_length, product_photos_qty,
         product_weight_g, product_length_cm, product_height_cm, product_width_cm
  from src_products
),
category_dim as (
  select product_category_name as category_name,
         product_category_name_english as category_name_english
  from src_product_category_name
),
date_dim as ({_days(first, last)}
),
order_items_fact as (
  select distinct i.order_id, i.order_item_id, i.product_id, i.seller_id, c.location_id,
         i.shipping_limit_date, i.price, i.freight_value
  from src_order_items i
  left join src_orders o on i.order_id = o.order_id
  left join located c on o.customer_id = c.customer_id
)"""


SOURCE_COLUMNS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "orders": "order_id string, index bigint, customer_id string, order_status string, "
    "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
    "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
    "order_estimated_delivery_date timestamp_ntz",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date timestamp_ntz, price decimal(18,4), freight_value decimal(18,4)",
    "payments": "order_id string, payment_sequential int, payment_type string, "
    "payment_installments int, payment_value decimal(18,4)",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g int, "
    "product_length_cm int, product_height_cm int, product_width_cm int",
    "product_category_name": "product_category_name string, product_category_name_english string",
}

STAR_NAMES = (
    "location_dim",
    "customers_dim",
    "orders_dim",
    "payments_dim",
    "products_dim",
    "category_dim",
    "date_dim",
    "order_items_fact",
)


def _profile() -> str:
    parts = []
    for table, columns in SOURCE_COLUMNS.items():
        for column in columns.split(", "):
            name, kind = column.split(" ")
            parts.append(
                f"""select '{table}' as table_name, '{name}' as column_name,
  '{kind}' as data_type, '{kind}' as actual_type, 'present' as status, count(*) as row_count,
  count(*) - count("{name}") as null_count, cast(0 as bigint) as reject_count,
  cast(0 as bigint) as rounded_count from src_{table}"""
            )
    return f"with {SOURCES}\n" + "\nunion all ".join(parts)


def _profile_csv() -> str:
    """The lines as text: ids, prices and freights spoilt by rule, a column more."""
    spoilt = {"order_item_id": "order_item_id % 10 = 0", "price": "order_item_id % 7 = 0"}
    columns = [c.split(" ") for c in SOURCE_COLUMNS["order_items"].split(", ")]
    parts = []
    for name, kind in [*columns, ["note", None]]:
        rejected = f"count(*) filter ({spoilt[name]})" if name in spoilt else "0"
        nulls = f'count(*) filter ("{name}" is null)' if kind else "0"
        lost = "count(*) filter (order_item_id % 3 = 0)" if name == "freight_value" else "0"
        parts.append(
            f"""select 'order_items' as table_name, '{name}' as column_name,
  {f"'{kind}'" if kind else "cast(null as varchar)"} as data_type, 'string' as actual_type,
  '{"present" if kind else "extra"}' as status, count(*) as row_count,
  {nulls} + {rejected} as null_count, cast({rejected} as bigint) as reject_count,
  cast({lost} as bigint) as rounded_count from src_order_items"""
        )
    return f"with {SOURCES}\n" + "\nunion all ".join(parts)


def _mixed_headers() -> str:
    """The payments; a third of the files have no column for the installments."""
    return f"""with {SOURCES}
select order_id, payment_sequential, payment_type,
       case when cast(order_id as bigint) % 3 <> 2 then payment_installments end as payment_installments,
       payment_value
from src_payments"""


def _formats() -> str:
    """The orders, every fourth without a purchase time."""
    return f"""with {SOURCES}
select * replace (case when "index" % 4 <> 3 then order_purchase_timestamp end as order_purchase_timestamp)
from src_orders"""


def _format_profile() -> str:
    written = ("ISO", "dd/MM/yyyy HH:mm:ss", "yyyy/MM/dd''T''HH:mm:ss")
    rows = ["(0, cast(null as varchar), 3)", *[f"({i + 1}, '{f}', {i})" for i, f in enumerate(written)]]
    return f"""with {SOURCES}
select 'orders' as table_name, 'order_purchase_timestamp' as column_name, cast(position as integer) as position,
       format, (select count(*) from src_orders where "index" % 4 = way and order_purchase_timestamp is not null
                or "index" % 4 = way and way = 3) as cell_count
from (values {", ".join(rows)}) t(position, format, way)"""


def _sketches() -> str:
    """Exact counts; a column is a key candidate if it has no null and as many values as rows, but for 2.5 per cent."""
    parts = [
        f"""select '{table}' as table_name, '{column}' as column_name, count(*) as row_count,
  count(*) - count("{column}") as null_count, true as within_error,
  count(*) > 0 and count("{column}") = count(*)
    and count(distinct cast("{column}" as varchar)) >= 0.975 * count(*) as key_candidate
from src_{table}"""
        for table in ("customers", "orders", "products")
        for column in (c.split()[0] for c in SOURCE_COLUMNS[table].split(", "))
    ]
    return f"with {SOURCES}\n" + "\nunion all ".join(parts)


def _row_counts() -> str:
    parts = [
        f"select '{name}' as table_name, count(*) as row_count from {name}" for name in STAR_NAMES
    ]
    return f"with {SOURCES},\n{star_ctes()}\n" + "\nunion all ".join(parts)


def _published() -> str:
    """As the version published last, which has first payments only."""
    return _row_counts().replace("from payments_dim", "from payments_dim where payment_sequential = 1")


def _primary_keys(tables: str | None = None, prefix: str = "") -> str:
    tables = tables or f"{SOURCES},\n{star_ctes()}"
    keys = {
        "location_dim": "location_id",
        "customers_dim": "customer_id",
        "orders_dim": "order_id",
        "payments_dim": "order_id, payment_sequential",
        "products_dim": "product_id",
        "category_dim": "category_name",
        "date_dim": "ddate",
        "order_items_fact": "order_id, order_item_id",
    }
    parts = []
    for table, key in keys.items():
        known = " and ".join(f"{c} is not null" for c in key.split(", "))
        rows = f"{prefix}{table}"
        parts.append(
            f"""select '{table}' as table_name, '{key}' as key_columns,
  (select count(*) from {rows}) as row_count,
  (select count(*) from {rows} where not ({known})) as null_key_rows,
  count(*) as repeated_keys, cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows
from (select {key}, count(*) as n from {rows} where {known} group by all having count(*) > 1)"""
        )
    return f"with {tables}\n" + "\nunion all ".join(parts)


def _foreign_keys(tables: str | None = None, prefix: str = "") -> str:
    tables = tables or f"{SOURCES},\n{star_ctes()}"
    edges = (
        ("order_items_fact", "order_id", "order_id", "orders_dim", "order_id"),
        ("order_items_fact", "product_id", "product_id", "products_dim", "product_id"),
        ("order_items_fact", "location_id", "location_id", "location_dim", "location_id"),
        ("customers_dim", "location_id", "location_id", "location_dim", "location_id"),
        ("orders_dim", "customer_id", "customer_id", "customers_dim", "customer_id"),
        (
            "orders_dim",
            "order_purchase_timestamp",
            "cast(order_purchase_timestamp as date)",
            "date_dim",
            "ddate",
        ),
        ("payments_dim", "order_id", "order_id", "orders_dim", "order_id"),
        (
            "products_dim",
            "product_category_name",
            "product_category_name",
            "category_dim",
            "category_name",
        ),
    )
    parts = []
    for child, column, expression, parent, key in edges:
        orphan = f"r is not null and not exists (select 1 from {prefix}{parent} p where p.{key} = r)"
        parts.append(
            f"""select '{child}.{column}' as child, '{parent}.{key}' as parent,
  count(*) as child_rows, count(*) - count(r) as null_rows,
  count(*) filter (where orphan) as orphan_rows,
  count(distinct r) filter (where orphan) as orphan_keys
from (select r, {orphan} as orphan from (select {expression} as r from {prefix}{child}))"""
        )
    return f"with {tables}\n" + "\nunion all ".join(parts)


def _enforced() -> str:
    """The spoilt star, parents first: ``v_`` tables have a verdict per row, ``a_`` tables the accepted rows."""
    spoilt = """
s_customers_dim as (select * from customers_dim where cast(customer_id as bigint) % 50 <> 0),
s_orders_dim as (
  select * replace (case when "index" % 40 <> 0 then order_id end as order_id) from orders_dim
),
s_order_items_fact as (
  select * from order_items_fact
  union all
  select * replace (cast(price + 1 as decimal(18,4)) as price) from order_items_fact where order_item_id = 1
  union all select * from order_items_fact where order_item_id = 2
)"""
    # table, its key, and (column, its value as a key, parent, key of the parent)
    checks = (
        ("location_dim", "location_id", ()),
        ("category_dim", "category_name", ()),
        ("date_dim", "ddate", ()),
        ("customers_dim", "customer_id", (("location_id", "location_id", "location_dim", "location_id"),)),
        ("products_dim", "product_id",
         (("product_category_name", "product_category_name", "category_dim", "category_name"),)),
        ("orders_dim", "order_id",
         (("customer_id", "customer_id", "customers_dim", "customer_id"),
          ("order_purchase_timestamp", "cast(order_purchase_timestamp as date)", "date_dim", "ddate"))),
        ("payments_dim", "order_id, payment_sequential", (("order_id", "order_id", "orders_dim", "order_id"),)),
        ("order_items_fact", "order_id, order_item_id",
         (("order_id", "order_id", "orders_dim", "order_id"),
          ("product_id", "product_id", "products_dim", "product_id"),
          ("location_id", "location_id", "location_dim", "location_id"))),
    )
    changed = ("customers_dim", "orders_dim", "order_items_fact")
    steps = []
    for table, key, edges in checks:
        null = " or ".join(f"{c} is null" for c in key.split(", "))
        whys = [f"case when {null} then 'null in key' end"] + [
            f"case when {value} is not null and {value} not in (select {name} from a_{parent} where {name} is not null) "
            f"then 'no {parent}.{name} for {column}' end"
            for column, value, parent, name in edges
        ]
        rows = f"s_{table}" if table in changed else table
        steps.append(
            f"""
w_{table} as (select *, concat_ws('; ', {", ".join(whys)}) as why from {rows}),
v_{table} as (
  select *, case when why <> '' then why
                 when row_number() over (partition by why, {key}) > 1 then 'repeated key' else 'accepted' end as verdict
  from w_{table}
),
a_{table} as (select * from v_{table} where verdict = 'accepted')"""
        )
    return f"{SOURCES},\n{star_ctes("date '1990-01-01'")},{spoilt},{','.join(steps)}"


def _enforcement_counts() -> str:
    parts = [
        f"select '{name}' as table_name, verdict, count(*) as row_count from v_{name} group by verdict"
        for name in STAR_NAMES
    ]
    return f"with {_enforced()}\n" + "\nunion all ".join(parts)


def _over_star(body: str, **calendar: str) -> str:
    return f"with {SOURCES},\n{star_ctes(**calendar)}\n{body}"


_BY_MONTH = """
select d."year", d."month", count(*) as number_of_orders
from orders_dim o left join date_dim d on cast(o.order_purchase_timestamp as date) = d.ddate
group by 1, 2"""


def _revenue(price: str) -> str:
    return f"""
select d."year", d."month", cast(sum({price}) as decimal(38,4)) as revenue
from order_items_fact f
left join orders_dim o on f.order_id = o.order_id
left join date_dim d on cast(o.order_purchase_timestamp as date) = d.ddate
group by 1, 2"""


def _late(condition: str) -> str:
    return f"""
select cast(round(
         cast(count(*) filter (where order_status = 'delivered' and {condition}) as decimal(18,2))
         / nullif(cast(count(*) as decimal(18,2)), 0) * 100, 2)
       as decimal(15,2)) as late_delivery_pct
from orders_dim"""


_CATEGORIES = """
select c.category_name_english, count(*) as total_sold
from order_items_fact f
{first}
left join products_dim p on f.product_id = p.product_id
left join category_dim c on p.product_category_name = c.category_name
group by 1 order by 2 desc, 1 asc nulls last limit 5"""

# Each person's earliest time over all accounts; then the orders of that time whose account id
# reads like the person's id.
_LITERAL_LOOKUP = """left join (
  with earliest as (
    select people.customer_unique_id as person, min(bought.order_purchase_timestamp) as at_time
    from orders_dim bought, customers_dim people
    where bought.customer_id = people.customer_id
    group by person)
  select named.order_id from orders_dim named, earliest
  where named.customer_id = earliest.person and named.order_purchase_timestamp = earliest.at_time
) fp on f.order_id = fp.order_id"""

_FIRST_ORDERS = """join (
  select distinct order_id from (
    select o2.order_id, rank() over (partition by c2.customer_unique_id
                                     order by o2.order_purchase_timestamp) as nth
    from orders_dim o2 join customers_dim c2 on c2.customer_id = o2.customer_id)
  where nth = 1
) fp on f.order_id = fp.order_id"""

_CONTROL_AS_WRITTEN = """
, joined as (
  select o.order_id, f.order_item_id, f.price, f.freight_value, p.payment_value,
    try_cast(f.price as decimal(9,4)) as legacy_price,
    try_cast(f.freight_value as decimal(9,4)) as legacy_freight
  from orders_dim o
  join order_items_fact f on f.order_id = o.order_id
  join payments_dim p on p.order_id = o.order_id),
totals as (
  select order_id,
    cast(sum(legacy_price) as decimal(38,4)) as order_item_price,
    cast(sum(legacy_freight) as decimal(38,4)) as order_freight,
    cast(sum(legacy_price + legacy_freight) as decimal(38,4)) as should_pay,
    max(payment_value) as payment_value,
    count(*) filter (where (price is not null and legacy_price is null)
      or (freight_value is not null and legacy_freight is null)) as lost_lines
  from joined group by order_id)
select order_id, order_item_id, count(*) as occurrences, any_value(order_item_price) as order_item_price,
  any_value(order_freight) as order_freight, any_value(should_pay) as should_pay,
  any_value(t.payment_value) as payment_value, any_value(lost_lines) as lost_lines
from joined join totals t using (order_id) group by order_id, order_item_id"""

_CONTROL_ITEM_TEXTS = """
, listed as (
  select o.order_id, list(f.order_item_id order by f.order_item_id) as ids
  from orders_dim o
  join order_items_fact f on f.order_id = o.order_id
  join payments_dim p on p.order_id = o.order_id
  where f.order_item_id is not null group by o.order_id)
select order_id, piece, cast(len(ids[piece * 3 + 1:piece * 3 + 3]) as bigint) as n_ids,
  array_to_string(ids[piece * 3 + 1:piece * 3 + 3], ',') as item_ids
from (select *, unnest(generate_series(0, cast((len(ids) - 1) // 3 as bigint))) as piece from listed)"""

_CONTROL = """
select o.order_id, coalesce(number_of_items, 0) as number_of_items,
  coalesce(incomplete_lines, 0) as incomplete_lines,
  coalesce(number_of_payments, 0) as number_of_payments,
  cast(coalesce(order_item_price, 0) as decimal(38,4)) as order_item_price,
  cast(coalesce(order_freight, 0) as decimal(38,4)) as order_freight,
  cast(coalesce(should_pay, 0) as decimal(38,4)) as should_pay,
  cast(coalesce(payment_value, 0) as decimal(38,4)) as payment_value,
  cast(coalesce(payment_value, 0) - coalesce(should_pay, 0) as decimal(38,4)) as difference
from (select distinct order_id from orders_dim where order_id is not null) o
left join (
  select order_id, count(*) as number_of_items,
    count(*) filter (where price is null or freight_value is null) as incomplete_lines,
    cast(sum(coalesce(price, 0)) as decimal(38,4)) as order_item_price,
    cast(sum(coalesce(freight_value, 0)) as decimal(38,4)) as order_freight,
    cast(sum(coalesce(price, 0) + coalesce(freight_value, 0)) as decimal(38,4)) as should_pay
  from order_items_fact group by order_id) i on i.order_id = o.order_id
left join (
  select order_id, count(*) as number_of_payments,
    cast(sum(payment_value) as decimal(38,4)) as payment_value
  from payments_dim group by order_id) p on p.order_id = o.order_id"""

# What each report returns, over the tables of the star.
REPORTS = {
    "report_top_products": """select product_id, count(*) as number_of_sales from order_items_fact
group by 1 order by 2 desc, 1 asc nulls last limit 5""",
    "report_orders_by_month": _BY_MONTH,
    "report_orders_by_city": """select l.location_city, count(*) as number_of_orders
from orders_dim o left join location_dim l on o.location_id = l.location_id group by 1""",
    "report_revenue_by_month": _revenue("f.price"),
    "report_revenue_by_month_as_written": _revenue("try_cast(f.price as decimal(9,4))"),
    "report_late_pct_calendar": _late(
        "datediff('day', order_purchase_timestamp, order_delivered_customer_date) >= 1"
    ),
    "report_late_pct_elapsed": _late(
        "order_delivered_customer_date > order_purchase_timestamp + interval 1 day"
    ),
    "report_top_categories_as_written": _CATEGORIES.format(first=_LITERAL_LOOKUP),
    "report_top_categories_new_customers": _CATEGORIES.format(first=_FIRST_ORDERS),
    "report_payment_control_as_written": _CONTROL_AS_WRITTEN,
    "report_payment_control_item_texts": _CONTROL_ITEM_TEXTS,
    "report_payment_control": _CONTROL,
}


def all_sql() -> dict[str, str]:
    covering = (
        "(select least(min(cast(o_orderdate as date)), date '2000-01-01') from orders)",
        "(select greatest(max(cast(o_orderdate as date)), date '2030-01-01') from orders)",
    )
    wide = {"first": "date '1990-01-01'", "last": "date '2030-01-01'"}
    return {
        "scan_csv": f"with {SOURCES}\nselect * from src_orders",
        "scan_csv_mixed_headers": _mixed_headers(),
        "scan_csv_formats": _formats(),
        "source_format_profile": _format_profile(),
        "source_sketches": _sketches(),
        "source_profile": _profile(),
        "source_profile_csv": _profile_csv(),
        "sink_csv_roundtrip": _over_star("select * from order_items_fact"),
        "sink_csv_odd_texts": "select cast(doc_id as varchar) as category_name, text as category_name_english from documents",
        "sink_parquet_roundtrip": _over_star("select * from orders_dim"),
        **{f"load_{name}": _over_star(f"select * from {name}") for name in STAR_NAMES},
        "load_date_dim": _days(*covering),
        "star_row_counts": _row_counts(),
        "star_refresh": _row_counts(),
        "star_published_version": _published(),
        "enforce_keys": _enforcement_counts(),
        "enforce_keys_audit_primary": _primary_keys(_enforced(), "a_"),
        "enforce_keys_audit_foreign": _foreign_keys(_enforced(), "a_"),
        "audit_primary_keys": _primary_keys(),
        "audit_foreign_keys": _foreign_keys(),
        **{name: _over_star(body) for name, body in REPORTS.items()},
        "report_orders_by_month_wide_calendar": _over_star(_BY_MONTH, **wide),
        "report_revenue_by_month_wide_calendar": _over_star(_revenue("f.price"), **wide),
    }
