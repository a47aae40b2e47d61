"""Reading, profiling and storing."""

from __future__ import annotations

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import DataFrameReader, DataFrameWriter

from starcart.functions.parsing import rounded, typed, unparsed
from starcart.operators import audits
from starcart.plans import session
from starcart.plans.jobs import all_reports, main
from starcart.plans.refresh import build_star, read_star, refresh_star, write_star
from starcart.schemas import SOURCE_TABLES, STAR_TABLES
from starcart.sources.files import csv_layout, load_sources, read_csv, read_raw, typed_sources
from starcart.sources.profile import format_profile, source_profile
from starcart.sources.stores import FileStore, JdbcStore


def test_bad_dates_and_numbers_become_null_and_are_counted(raw):
    times = ["garbage", "", None, "2017-10-02 10:56:33", "2017-10-02"]
    tables = raw(
        orders=[{"order_id": str(i), "order_approved_at": t} for i, t in enumerate(times)],
        order_items=[{"order_item_id": n} for n in ("1", "01", "2.0", "2.5", "x", " ")],
    )
    orders = typed_sources(tables)["orders"].select("order_approved_at")
    assert [r[0] for r in values(orders)] == [
        None,
        None,
        None,
        dt.datetime(2017, 10, 2, 10, 56, 33),
        dt.datetime(2017, 10, 2),
    ]
    items = typed_sources(tables)["order_items"].select("order_item_id")
    assert [r[0] for r in values(items)] == [1, 1, 2, None, None, None]
    profile = {(r.table_name, r.column_name): r for r in source_profile(tables).collect()}
    approved = profile["orders", "order_approved_at"]
    assert (approved.row_count, approved.null_count, approved.reject_count) == (5, 3, 1)
    number = profile["order_items", "order_item_id"]
    assert (number.row_count, number.null_count, number.reject_count) == (6, 3, 2)
    assert len(profile) == sum(len(c) for c in SOURCE_TABLES.values())


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))


@pytest.fixture
def csv_root(tmp_path):
    _write(
        tmp_path / "customers.csv",
        "customer_state,customer_city,extra,customer_zip_code_prefix,customer_id,customer_unique_id\n"
        'SP,"sao, paulo",1,01001,c1,u1\nRJ,rio,2,20000,c2,u2\n',
    )
    _write(
        tmp_path / "orders.csv",
        "index,order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "0,o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-04 19:55:00,"
        "2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "1,o2,c2,shipped,2018-01-02 00:00:00,,,,2018-01-20 00:00:00\n",
    )
    _write(
        tmp_path / "order_items.csv",
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2017-10-06 11:07:15,29.99,8.72\no2,1,p1,s1,2018-01-08 00:00:00,29.99,8.72\n",
    )
    _write(
        tmp_path / "payments.csv",
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,credit_card,1,38.71\n",
    )
    _write(
        tmp_path / "products.csv",
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,cama,40,287.0,1,225,16,10,14\n",
    )
    _write(  # byte order mark, CRLF, no newline at the end
        tmp_path / "product_category_name.csv",
        "﻿product_category_name,product_category_name_english\r\ncama,bed\r\nluz,light",
    )
    return str(tmp_path)


def test_csv_columns_are_found_by_name(spark, csv_root):
    sources = load_sources(spark, csv_root)
    assert sorted(values(sources["customers"])) == [
        ("c1", "u1", "01001", "sao, paulo", "SP"),
        ("c2", "u2", "20000", "rio", "RJ"),
    ]
    for name, columns in SOURCE_TABLES.items():
        assert dict(sources[name].dtypes) == columns


def test_byte_order_mark_and_crlf_leave_no_trace(spark, csv_root):
    categories = load_sources(spark, csv_root)["product_category_name"]
    assert categories.columns == ["product_category_name", "product_category_name_english"]
    assert sorted(values(categories)) == [("cama", "bed"), ("luz", "light")]


def test_paths_can_be_given_one_by_one(spark, csv_root, tmp_path):
    _write(tmp_path / "elsewhere.txt", "product_category_name,product_category_name_english\nx,y\n")
    raw = read_raw(
        spark, csv_root, paths={"product_category_name": str(tmp_path / "elsewhere.txt")}
    )
    assert values(raw["product_category_name"]) == [("x", "y")]


def test_load_and_reports_from_files(spark, csv_root, tmp_path, capsys):
    target = str(tmp_path / "star")
    refresh_star(spark, load_sources(spark, csv_root), FileStore(target, "csv", files=4))
    star = read_star(spark, FileStore(target, "csv"))
    assert {n: star[n].count() for n in STAR_TABLES} == {
        "location_dim": 2,
        "customers_dim": 2,
        "orders_dim": 2,
        "payments_dim": 1,
        "products_dim": 1,
        "category_dim": 2,
        "date_dim": 10959,
        "order_items_fact": 2,
    }
    found = {name: values(report) for name, report in all_reports(star).items()}
    assert found["late deliveries, percent of orders"] == [(Decimal("50.00"),)]
    assert found["orders by year and month"] == [(2017, 10, 1), (2018, 1, 1)]
    assert found["top categories of new customers"] == [("bed", 2)]
    assert found["payment control"][0][-1] == Decimal("0.0000")
    for name, columns in STAR_TABLES.items():
        assert dict(star[name].dtypes) == columns


def test_refresh_gives_what_build_gives(spark, csv_root, tmp_path):
    sources = load_sources(spark, csv_root)
    built = build_star(spark, sources)
    for store in (
        FileStore(str(tmp_path / "p")),
        FileStore(str(tmp_path / "c"), "csv"),
    ):
        stored = refresh_star(spark, sources, store)
        for name in STAR_TABLES:
            assert sorted(values(stored[name]), key=str) == sorted(values(built[name]), key=str)


ODD_TEXT = [
    (" a ", "blank outside"),
    ("", "empty"),
    (None, "null"),
    ('say "hi", please', "quote and comma"),
    ("back\\slash", "backslash"),
    ("00123", "leading zeros"),
]


def test_plain_csv_loses_blanks_and_empty_text_but_exact_csv_does_not(spark, tmp_path):
    df = spark.createDataFrame(ODD_TEXT, "category_name string, category_name_english string")
    plain = FileStore(str(tmp_path / "plain"), "csv", options={})
    assert not plain.exact and not FileStore("x", "json").exact
    plain.write(df, "category_dim")
    kept = dict((v, k) for k, v in values(plain.read(spark, "category_dim")))
    assert kept["blank outside"] == "a"
    assert kept["empty"] is None
    assert kept["leading zeros"] == "00123"
    for store in (
        FileStore(str(tmp_path / "exact"), "csv"),
        FileStore(str(tmp_path / "parquet")),
    ):
        assert store.exact
        store.write(df, "category_dim")
        assert sorted(values(store.read(spark, "category_dim")), key=str) == sorted(
            ODD_TEXT, key=str
        )


def test_exact_csv_keeps_microseconds(spark, tmp_path):
    moment = dt.datetime(2020, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(moment,)], "order_approved_at timestamp_ntz").selectExpr(
        *[
            "order_approved_at" if c == "order_approved_at" else f"cast(null as {t}) as `{c}`"
            for c, t in STAR_TABLES["orders_dim"].items()
        ]
    )
    store = FileStore(str(tmp_path), "csv")
    store.write(df, "orders_dim")
    assert store.read(spark, "orders_dim").collect()[0].order_approved_at == moment


def test_exact_csv_gives_back_any_text(spark, tmp_path):
    """Line breaks, null marks, escapes and random Unicode; the files can still be read in parts."""
    rng = random.Random(3)
    texts = ["two\nlines", "carriage\rreturn", "\\N", "\\n", "\\b", "\\", "\\\\N", "a\\\nb", '"\n"', ",", "\r\n", " \n ", "", None]
    signs = ["\\", "\n", "\r", '"', ",", "b", "n", "r", "N", " ", "\t", "\u2028", "\x85"]
    for _ in range(400):
        drawn = [rng.choice(signs) if rng.random() < 0.6 else chr(rng.randrange(1, 0xD800)) for _ in range(rng.randrange(9))]
        texts.append("".join(drawn) + rng.choice(["", "😀"]))
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "category_name string, category_name_english string")
    store = FileStore(str(tmp_path / "c"), "csv")
    store.write(df, "category_dim")
    found = {int(k): v for k, v in values(store.read(spark, "category_dim"))}
    assert {i: t for i, t in enumerate(texts) if found.get(i, "?") != t} == {}
    lines = spark.read.text(store.path("category_dim"))
    assert lines.where("value not like '%category_name%'").count() == len(texts)


def test_cells_of_other_types_are_counted(spark):
    """What a typed source loses shows as rejected, or as rounded."""
    cases = [
        ("5000000000L", "int", 1, 0), ("1e30d", "decimal(18,4)", 1, 0), ("12.5d", "int", 1, 0),
        ("12d", "int", 0, 0), ("cast(1 as int)", "bigint", 0, 0), ("'123.456789'", "decimal(18,4)", 0, 1),
        ("'40.0000001'", "decimal(18,4)", 0, 1), ("'40.5'", "decimal(18,4)", 0, 0), ("''", "int", 0, 0),
        ("cast(null as double)", "int", 0, 0), ("12.34567d", "decimal(18,4)", 0, 1),
    ]
    for value, want, rejected, lost in cases:
        df = spark.sql(f"select {value} as x")
        have = dict(df.dtypes)["x"]
        row = df.selectExpr(
            f"count_if({unparsed('x', have, want)})", f"count_if({rounded('x', have, want)})"
        ).first()
        assert tuple(row) == (rejected, lost), (value, want)


def test_date_and_time_formats(spark):
    df = spark.sql("select '31/12/2019' as d, '31.12.2019 23-59' as t, 'soon' as bad")
    out = typed(
        df,
        {"d": "date", "t": "timestamp_ntz", "bad": "date"},
        {"d": "dd/MM/yyyy", "t": "dd.MM.yyyy HH-mm", "bad": "dd/MM/yyyy"},
    ).first()
    assert tuple(out) == (dt.date(2019, 12, 31), dt.datetime(2019, 12, 31, 23, 59), None)
    rejected = f"count_if({unparsed('bad', 'string', 'date', 'dd/MM/yyyy')})"
    assert df.selectExpr(rejected).first()[0] == 1


def test_profile_shows_missing_and_extra_columns(spark):
    raw = {"payments": spark.sql("select 'o' as order_id, 'x' as note, 2.5d as payment_value")}
    rows = {r.column_name: r for r in source_profile(raw).collect()}
    assert (rows["note"].status, rows["note"].data_type, rows["note"].actual_type) == ("extra", None, "string")
    assert (rows["payment_type"].status, rows["payment_type"].actual_type) == ("missing", None)
    assert (rows["payment_type"].null_count, rows["payment_value"].actual_type) == (1, "double")


def test_number_of_files_and_overwrite(spark, star_of, tmp_path):
    star = star_of()
    store = FileStore(str(tmp_path), "csv", files=4)
    write_star({"date_dim": star["date_dim"]}, store)
    write_star({"date_dim": star["date_dim"]}, store)
    parts = [f for f in os.listdir(tmp_path / "date_dim") if f.startswith("part-")]
    assert len(parts) == 4
    assert read_csv(spark, store.path("date_dim")).count() == 10959


def test_jdbc_store_hands_over_the_callers_settings(spark, star_of, monkeypatch):
    """No database is started here: the call to Spark's writer is recorded."""
    calls = []

    def record(self, url, table, mode=None, properties=None):
        calls.append((url, table, properties))

    options = []
    original = DataFrameWriter.options
    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    monkeypatch.setattr(
        DataFrameWriter, "options", lambda self, **o: (options.append(o), original(self, **o))[1]
    )
    modes = []
    original_mode = DataFrameWriter.mode
    monkeypatch.setattr(
        DataFrameWriter, "mode", lambda self, m: (modes.append(m), original_mode(self, m))[1]
    )
    store = JdbcStore(
        "jdbc:postgresql://host/db",
        {"driver": "org.postgresql.Driver", "user": "u", "password": "p"},
        connections=16,
        options={"batchsize": "5000"},
    )
    write_star(star_of(), store)
    assert sorted(table for _, table, _ in calls) == sorted(STAR_TABLES)
    assert {url for url, _, _ in calls} == {"jdbc:postgresql://host/db"}
    assert calls[0][2] == {"driver": "org.postgresql.Driver", "user": "u", "password": "p"}
    assert set(modes) == {"overwrite"}
    assert options[0] == {"batchsize": "5000"}  # numPartitions would make Spark merge tasks


def test_jdbc_reads_in_parts(monkeypatch, spark):
    calls = []
    monkeypatch.setattr(
        DataFrameReader,
        "jdbc",
        lambda self, url, table, predicates=None, properties=None: (
            calls.append((table, predicates)),
            spark.sql("select 'a' as category_name, 'b' as category_name_english"),
        )[1],
    )
    store = JdbcStore("jdbc:x", connections=2, hashes={"category_dim": "hashtext(category_name)"})
    store.read(spark, "category_dim")
    JdbcStore("jdbc:x").read(spark, "category_dim")
    part = "mod(abs(coalesce(hashtext(category_name), 0)), 2) = "
    assert calls == [("category_dim", [f"{part}0", f"{part}1"]), ("category_dim", None)]


def test_object_store_settings_hold_the_callers_values():
    settings = session.s3a_settings("http://store:9000", "key", "secret")
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.access.key"] == "key"
    assert settings["spark.hadoop.fs.s3a.secret.key"] == "secret"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert all(key.startswith("spark.hadoop.fs.s3a.") for key in settings)


def test_settings_grow_with_the_input():
    small, large = (session.sized_settings(b, 4000) for b in (10**9, 10**14))
    assert small["spark.sql.shuffle.partitions"] == "4000"
    assert small["spark.sql.files.maxPartitionBytes"] == str(16 * 1024**2)
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert large["spark.sql.files.maxPartitionBytes"] == str(10**9)


def test_scratch_folder_lies_in_the_shared_one(tmp_path):
    def session_with(master="local[8]", **given):
        class Session:
            class conf:
                get = staticmethod(lambda key, default=None: given.get(key.split(".")[1], default))

            class sparkContext:
                pass

        Session.sparkContext.master = master
        return Session

    root = str(tmp_path)
    assert session.scratch_root(session_with(checkpoint=root)).startswith(f"{root}/starcart-")
    assert session.scratch_root(session_with(sql=f"file:{root}")).startswith(f"file:{root}/starcart-")
    cluster = session_with("spark://host:7077", sql=f"file:{root}")
    with pytest.raises(ValueError):
        session.scratch_root(cluster)
    shared = session_with("spark://host:7077", sql="hdfs://store/warehouse")
    assert session.scratch_root(shared).startswith("hdfs://store/warehouse/starcart-")


def test_command_line_reads_a_database_in_parts(monkeypatch, spark, tmp_path):
    calls = {}

    def jdbc(self, url, table, predicates=None, properties=None):
        calls[table] = predicates
        nothing = ", ".join(f"cast(null as {t}) as `{c}`" for c, t in STAR_TABLES[table].items())
        return spark.sql(f"select {nothing} where false")

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    _write(tmp_path / "db.json", '{"user": "u"}')
    given = ["--jdbc-url", "jdbc:x", "--jdbc-properties", str(tmp_path / "db.json"), "--connections", "3"]
    hashes = ["--hash", "orders_dim=hashtext(order_id)", "--hash", "order_items_fact=ascii(a) + b = 1"]
    main(["reports", *given, *hashes, "--output", str(tmp_path / "out")])
    assert len(calls["orders_dim"]) == len(calls["order_items_fact"]) == 3
    assert "ascii(a) + b = 1" in calls["order_items_fact"][0] and calls["payments_dim"] is None


def test_command_line_takes_several_formats_of_a_column(spark, csv_root, tmp_path, capsys):
    given = ["--pattern", "shipping_limit_date=dd.MM.yyyy", "--pattern", "shipping_limit_date=ISO"]
    main(["etl", "--source", csv_root, "--target", str(tmp_path / "star"), "--profile", *given])
    assert "dd.MM.yyyy" in capsys.readouterr().out
    fact = read_star(spark, FileStore(str(tmp_path / "star")))["order_items_fact"]
    assert fact.where("shipping_limit_date is null").count() == 0


def test_command_line_checks_its_arguments(csv_root, tmp_path):
    with pytest.raises(SystemExit):
        main(["etl", "--source", csv_root, "--jdbc-url", "jdbc:x"])
    with pytest.raises(SystemExit):
        main(["reports", "--star", str(tmp_path), "--input-bytes", "5"])


def test_command_line_stores_whole_reports(spark, csv_root, tmp_path):
    star, output = str(tmp_path / "star"), str(tmp_path / "out")
    main(["etl", "--source", csv_root, "--target", star, "--covering", "--hot", "measure"])
    main(["reports", "--star", star, "--output", output])
    built = all_reports(read_star(spark, FileStore(star)))
    assert len(os.listdir(output)) == len(built)
    for title, report in built.items():
        name = title.split(",")[0].replace(" ", "_")
        stored = spark.read.parquet(f"{output}/{name}")
        assert sorted(map(str, stored.collect())) == sorted(map(str, report.collect())), title


def test_command_line_loads_and_reports(spark, csv_root, tmp_path, capsys):
    target = str(tmp_path / "out")
    main(["etl", "--source", csv_root, "--target", target, "--profile"])
    main(["reports", "--star", target])
    printed = capsys.readouterr().out
    assert "customer_zip_code_prefix" in printed
    assert "top categories of new customers" in printed
    assert "50.00" in printed


def test_audits_report_broken_keys(star_of):
    star = star_of(
        orders=[
            {"order_id": "o", "order_status": "a", "order_purchase_timestamp": "1990-01-01"},
            {"order_id": "o", "order_status": "b", "order_purchase_timestamp": "2010-01-01"},
            {"order_id": None},
        ],
        order_items=[
            {"order_id": "o", "order_item_id": "1", "product_id": "p"},
            {"order_id": "gone", "order_item_id": "1", "product_id": "p"},
            {"order_id": "gone", "order_item_id": "2"},
        ],
        products=[{"product_id": "p", "product_category_name": "none"}],
    )
    keys = {r.table_name: tuple(r)[2:] for r in audits.primary_key_violations(star).collect()}
    assert keys["orders_dim"] == (3, 1, 1, 1)
    assert keys["order_items_fact"] == (3, 0, 0, 0)
    assert keys["category_dim"] == (0, 0, 0, 0)
    edges = {r.child: tuple(r)[2:] for r in audits.foreign_key_violations(star).collect()}
    assert edges["order_items_fact.order_id"] == (3, 0, 2, 1)
    assert edges["order_items_fact.product_id"] == (3, 1, 0, 0)
    assert edges["orders_dim.order_purchase_timestamp"] == (3, 1, 1, 1)
    assert edges["products_dim.product_category_name"] == (1, 0, 1, 1)
    counts = dict(values(audits.star_row_counts(star)))
    assert counts["orders_dim"] == 3 and counts["location_dim"] == 0


# -- headers that differ from file to file -----------------------------------------


def test_every_file_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "odd name%20[1]"
    folder.mkdir()
    _write(folder / "1.csv", "a,b\n1,2\n")
    _write(folder / "2.csv", "b,a\n20,10\n")
    _write(folder / "3 x%2F.csv", "\n﻿b,a\r\n200,100\r\n")
    _write(folder / "4.csv", "a,c\n1000,3000\n")
    _write(folder / "empty.csv", "")
    path = str(folder).replace("[", "\\[").replace("]", "\\]")
    df = read_csv(spark, path)
    assert df.columns == ["b", "a", "c"]
    assert sorted((r.a, r.b, r.c) for r in df.collect()) == [
        ("1", "2", None), ("10", "20", None), ("100", "200", None), ("1000", None, "3000"),
    ]
    layout = csv_layout(spark, path, {"a": "string", "b": "string"}).collect()
    assert [tuple(r) for r in layout] == [
        (["b", "a"], 2, [], []), (["a", "b"], 1, [], []), (["a", "c"], 1, ["b"], ["c"]),
    ]


def test_files_with_one_header_are_one_scan(spark, tmp_path):
    df = spark.range(5000).selectExpr("cast(id as string) a", "repeat('x', 200) b")
    df.repartition(4).write.option("header", True).csv(str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"))
    assert back.count() == 5000
    assert back._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_an_empty_directory_of_headers_and_comments(spark, tmp_path):
    _write(tmp_path / "a.csv", "# made by hand\nx,y\n")
    _write(tmp_path / "b.csv", "# made by hand\ny,x\n1,2\n")
    assert values(read_csv(spark, str(tmp_path), comment="#").select("x", "y")) == [("2", "1")]


# -- dates and times in several formats --------------------------------------------


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Europe/Berlin"])
def test_local_times_do_not_depend_on_the_zone(spark, zone):
    texts = ["2018-11-04 00:30:00", "2018-02-17 23:30:00", "2018-03-25 02:30:00", "2018-10-28 02:30:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for pattern in (None, "yyyy-MM-dd HH:mm:ss", ["dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss"]):
            out = typed(df, {"t": "timestamp_ntz"}, {"t": pattern}).collect()
            assert [str(r.t) for r in out] == texts
        out = typed(df, {"t": "date"}, {"t": "yyyy-MM-dd HH:mm:ss"}).collect()
        assert [str(r.t) for r in out] == [t[:10] for t in texts]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_formats_with_quoted_letters_and_offsets(spark):
    df = spark.sql("select '2018-11-04T00:30:00' as a, '5 o''clock 2019-01-02' as b, '2018-11-04 00:30+02:00' as c")
    patterns = {"a": "yyyy-MM-dd'T'HH:mm:ss", "b": "H' o''clock 'yyyy-MM-dd", "c": "yyyy-MM-dd HH:mmXXX"}
    out = typed(df, dict.fromkeys("abc", "timestamp_ntz"), patterns).first()
    assert [str(x) for x in out] == ["2018-11-04 00:30:00", "2019-01-02 05:00:00", "2018-11-03 22:30:00"]


def test_formats_are_tried_in_order_and_counted(raw):
    times = ["2018-01-02 03:04:05", "01/02/2018", "13/02/2018", "3.2.2018 04-05", "", None, "soon", "2018-05-06"]
    tables = raw(orders=[{"order_approved_at": t} for t in times])
    patterns = {"order_approved_at": ["ISO", "MM/dd/yyyy", "dd/MM/yyyy", "d.M.yyyy HH-mm"], "price": "unused"}
    out = typed_sources(tables, patterns)["orders"].select("order_approved_at")
    assert [str(r[0]) for r in values(out)] == [
        "2018-01-02 03:04:05", "2018-01-02 00:00:00", "2018-02-13 00:00:00", "2018-02-03 04:05:00",
        "None", "None", "None", "2018-05-06 00:00:00",
    ]
    found = values(format_profile(tables, {"order_approved_at": patterns["order_approved_at"]}))
    assert [r[2:] for r in found] == [
        (0, None, 1), (1, "ISO", 2), (2, "MM/dd/yyyy", 1), (3, "dd/MM/yyyy", 1), (4, "d.M.yyyy HH-mm", 1),
    ]


@pytest.mark.parametrize(
    ("text", "want", "kept", "rejected", "lost"),
    [
        ("40.0000001", "int", None, 1, 0),
        ("40." + "0" * 25 + "1", "bigint", None, 1, 0),
        ("40." + "0" * 25, "bigint", 40, 0, 0),
        ("9223372036854775807", "bigint", 9223372036854775807, 0, 0),
        ("1." + "0" * 25 + "1", "decimal(18,4)", Decimal("1.0000"), 0, 1),
    ],
)
def test_no_digit_is_lost_unseen(spark, text, want, kept, rejected, lost):
    df = spark.createDataFrame([(text,)], "x string")
    counts = [f"count_if({unparsed('x', 'string', want)})", f"count_if({rounded('x', 'string', want)})"]
    assert tuple(df.selectExpr(*counts).first()) == (rejected, lost)
    assert typed(df, {"x": want}).first()[0] == kept
