import datetime as dt

from millrace.operators.quality import dq_report
from millrace.sources import load, results
from millrace.sources.schemas import ORDERS, PRODUCTS, REVIEWS, TRANSLATION, GEOLOCATION


def test_csv_with_bom_quotes_line_break_and_bad_date(spark, tmp_path):
    path = tmp_path / "order_reviews.csv"
    path.write_bytes(
        "﻿review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,"good, fast","two\nlines ""quoted""",2018-01-02 03:04:05,not a date\n'
        "r2,o2,1,,,2018-13-45,2018-01-03 00:00:00\n".encode()
    )
    table, status = load.load_table(spark, str(path), REVIEWS)
    rows = {r["review_id"]: r for r in table.collect()}
    assert rows["r1"]["review_comment_title"] == "good, fast"
    assert rows["r1"]["review_comment_message"] == 'two\nlines "quoted"'
    assert rows["r1"]["review_creation_date"] == dt.datetime(2018, 1, 2, 3, 4, 5)
    assert rows["r1"]["review_answer_timestamp"] is None
    assert rows["r2"]["review_creation_date"] is None
    assert status.first().asDict() == {"table": "order_reviews", "loaded": 2, "status": "OK"}


def test_null_keys_dropped_first_of_duplicates_kept(spark, tmp_path):
    path = tmp_path / "orders.csv"
    lines = ["a,c1,delivered", "b,c2,shipped", "a,c3,canceled", ",c4,shipped", "b,c5,delivered", "a,c6,shipped"]
    path.write_text(",".join(ORDERS.schema.names) + "\n" + "\n".join(f"{x},,,,," for x in lines) + "\n")
    table, _ = load.load_table(spark, str(path), ORDERS)
    assert {(r.order_id, r.customer_id) for r in table.collect()} == {("a", "c1"), ("b", "c2")}
    assert table.columns == ORDERS.schema.names


def test_load_all_reports_missing_and_translates(spark, tmp_path):
    (tmp_path / "category_translation.csv").write_text("product_category_name,product_category_name_english\nbrinquedos,toys\n")
    (tmp_path / "products.csv").write_text(
        ",".join(PRODUCTS.schema.names) + "\np1,brinquedos,,,,,,,\np2,nada,,,,,,,\np3,,,,,,,,\n"
    )
    (tmp_path / "geolocation.csv").write_text(
        ",".join(GEOLOCATION.schema.names) + "\n1,1.5,2.5,x,SP\n1,1.5,2.5,y,SP\n1,1.6,2.5,z,SP\n"
    )
    tables, summary = load.load_all(spark, str(tmp_path), str(tmp_path / "out"))
    names = {r.product_id: r.product_category_name_english for r in tables["products"].collect()}
    assert names == {"p1": "toys", "p2": None, "p3": None}
    assert sorted(r.geolocation_city for r in tables["geolocation"].collect()) == ["x", "z"]
    rows = {r["table"]: (r["loaded"], r["status"]) for r in summary.collect()}
    assert rows["orders"] == (0, "MISSING") and rows["products"] == (3, "OK") and rows["TOTAL"][0] == 6
    fallback = load.translate_categories(spark.createDataFrame([("q",)], "product_category_name string"), None)
    assert fallback.first()["product_category_name_english"] == "q"
    assert {r.table_name: r.table_rows for r in load.catalogue(tables).collect()}["products"] == 3
    assert TRANSLATION.name in tables


def test_append_by_month(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS id, TIMESTAMP_NTZ '2018-01-05 00:00:00' AS t UNION ALL SELECT 'b', TIMESTAMP_NTZ '2018-02-05 00:00:00'")
    load.append_table(df, str(tmp_path / "t"), "t")
    load.append_table(df, str(tmp_path / "t"), "t")
    assert spark.read.parquet(str(tmp_path / "t")).filter("purchase_month = '2018-01'").count() == 2


def test_a_named_load_replaces_itself(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS id, TIMESTAMP_NTZ '2018-01-05 00:00:00' AS t UNION ALL SELECT 'b', TIMESTAMP_NTZ '2018-02-05 00:00:00'")
    for rows, name in ((df, "one"), (df, "two"), (df.filter("id = 'a'"), "one")):
        load.append_table(rows, str(tmp_path / "t"), "t", name)
    got = spark.read.parquet(str(tmp_path / "t")).select("id", "load_id").collect()
    assert sorted(map(tuple, got)) == [("a", "one"), ("a", "two"), ("b", "two")]


def test_quality_report(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1, "x"), (1, None), (9, "x"), (9, "z"), (None, "q")], "k int, v string")
    report = dq_report(
        {"p": parent, "c": child}, floors={"p": 3, "c": 5}, keys={"c": ["k"], "p": ["k"]},
        references=[("c", "k", "p", "k")], not_null=[("c", "v")],
    )
    got = {(r["table"], r["check"]): (r["value"], r["passed"]) for r in report.collect()}
    assert got == {
        ("p", "row_floor"): (2, False), ("c", "row_floor"): (5, True), ("c", "not_null"): (1, False),
        ("c", "unique_key"): (2, False), ("p", "unique_key"): (0, True), ("c", "foreign_key"): (2, False),
    }


def test_result_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "category string, mape double")
    results.write_csv(df, str(tmp_path / "csv"))
    assert sorted(results.read_csv(spark, str(tmp_path / "csv"), df.schema).collect()) == sorted(df.collect())
    results.write_json(df, str(tmp_path / "json"))
    assert sorted(results.read_json(spark, str(tmp_path / "json"), df.schema).collect()) == sorted(df.collect())
    (tmp_path / "sel.json").write_text(
        '{"global_default_model": "gbm", "per_category": {"x": {"selected_model": "lstm", "confidence": "high",'
        ' "reason": "r", "mapes": {"baseline": 3.0, "lstm": 1.0, "gbm": 2.0}}}}'
    )
    row = results.read_selection(spark, str(tmp_path / "sel.json")).first()
    assert (row["category"], row["selected_model"], row["lstm_mape"], row["global_default_model"]) == ("x", "lstm", 1.0, "gbm")
    (tmp_path / "stats.json").write_text('{"x": {"total_days": 3, "zero_pct": 1.5}, "y": {"total_days": 4, "zero_pct": 0.0}}')
    stats = results.read_keyed_json(spark, str(tmp_path / "stats.json"), "total_days: int, zero_pct: double")
    assert {r["category"]: r["total_days"] for r in stats.collect()} == {"x": 3, "y": 4}


def test_latest_snapshot_takes_latest_date_not_last_row(spark):
    df = spark.createDataFrame([("a", dt.date(2018, 1, 2), 2.0), ("a", dt.date(2018, 1, 1), 1.0)], "category string, sale_date date, x double")
    assert results.latest_snapshot(df).first()["x"] == 2.0


def test_required_columns(spark):
    import pytest

    with pytest.raises(ValueError):
        results.require_columns(spark.range(1), ["mape"], "results")
    assert results.require_columns(spark.range(1), ["id"], "results").count() == 1
