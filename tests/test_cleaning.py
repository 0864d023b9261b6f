"""Silver cleaning cases (FIXTURES.md §C3)."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import cleaning as cl


def test_trim_spaces_only_by_default(spark):
    df = spark.createDataFrame([("  x ", "\tx", 1)], "a string, b string, n int")
    r = cl.trim_strings(df).collect()[0]
    assert (r["a"], r["b"], r["n"]) == ("x", "\tx", 1)
    assert cl.trim_strings(df, " \t").collect()[0]["b"] == "x"


def test_parse_datetimes_by_name(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "ann", "x"), ("bad", "bob", "y"), (None, None, "z")],
                               "created_at string, updated_by string, note string")
    out = cl.parse_datetimes(df)
    got = [r["created_at"] for r in out.orderBy("note").collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None]
    # "updated_by" contains "date": the name rule turns the text into null ...
    assert {r["updated_by"] for r in out.collect()} == {None}
    # ... unless it is excluded.
    kept = cl.parse_datetimes(df, exclude=("updated_by",))
    assert {r["updated_by"] for r in kept.collect()} == {"ann", "bob", None}


def test_fill_quantity(spark):
    df = spark.createDataFrame([("3",), ("n/a",), (None,)], "quantity string")
    assert [r["quantity"] for r in cl.fill_quantity(df).collect()] == [3.0, 0.0, 0.0]
    other = spark.createDataFrame([("3",)], "qty string")
    assert cl.fill_quantity(other).collect()[0]["qty"] == "3"


def test_median_impute(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "price double")
    assert sorted(r["price"] for r in cl.impute_median(df, "price").collect()) == [1.0, 2.0, 2.0, 3.0, 10.0]
    empty = spark.createDataFrame([(None,), (None,)], "price double")
    assert [r["price"] for r in cl.impute_median(empty, "price").collect()] == [None, None]


def test_price_candidates_first_only(spark):
    df = spark.createDataFrame([("1.5", "2.5"), ("x", "y")], "unit_price string, cost string")
    out = cl.cast_price(df)
    assert dict(out.dtypes) == {"unit_price": "double", "cost": "string"}
    assert [r["unit_price"] for r in out.collect()] == [1.5, None]


def test_clean_inventory(spark):
    df = spark.createDataFrame([(" Apple ", "1"), (" Apple ", "1"), ("Pear", None), ("Fig", "3")],
                               "`Product Name` string, ` Unit Price` string")
    out = cl.clean_inventory(df)
    assert out.columns == ["product_name", "unit_price"]
    assert sorted((r["product_name"], r["unit_price"]) for r in out.collect()) == [
        ("Apple", 1.0), ("Fig", 3.0), ("Pear", 1.0)]


def test_dedup_by_id_nulls_collapse(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "id int, v string")
    out = cl.dedup_by_key(df, ["id"])
    assert sorted((r["id"] is None, r["v"]) for r in out.collect()) == [(False, "b"), (True, "d")]


def test_dedup_by_key_prefers_latest(spark):
    df = spark.createDataFrame([(1, "2024-01-02", "old"), (1, "2024-01-03", "new"), (1, None, "zzz")],
                               "k int, d string, v string")
    assert cl.dedup_by_key(df, ["k"], order_by=["d"]).collect()[0]["v"] == "new"


def test_clean_transactions_dedups_before_id(spark):
    row = (" 7", " SALE ", "-2", "2024-01-02")
    df = spark.createDataFrame([row, row], "`Product ID` string, `Transaction Type` string, "
                                           "Quantity string, `Transaction Date` string")
    out = cl.clean_transactions(df).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["product_id"], r["transaction_type"], r["quantity"]) == ("7", "SALE", -2.0)
    assert len(r["transaction_id"]) == 64
    again = cl.clean_transactions(df).collect()[0]["transaction_id"]
    assert again == r["transaction_id"]
    uu = cl.clean_transactions(df, id_method="uuid").collect()
    assert len(uu) == 1 and len(uu[0]["transaction_id"]) == 36


def test_clean_transactions_with_id(spark):
    df = spark.createDataFrame([(1, "a", "2024-01-01"), (1, "b", "2024-01-05"), (2, "c", None)],
                               "id int, transaction_type string, transaction_date string")
    out = {r["id"]: r["transaction_type"] for r in cl.clean_transactions(df).collect()}
    assert out == {1: "b", 2: "c"}


def test_supplier_key(spark):
    only_id = spark.createDataFrame([(1, "x")], "id int, name string")
    assert cl.clean_suppliers(only_id).columns == ["supplier_id", "name"]
    both = spark.createDataFrame([(1, 2)], "id int, supplier_id int")
    assert cl.conform_supplier_key(both).columns == ["id", "supplier_id"]


def test_distinct_rows_get_distinct_ids(spark):
    """Separators, null marks and digits in the text can't make two rows read alike, and
    an id does not depend on the session's time zone."""
    texts = ["a|b", "b|c", "a", "c", "<null>", "x", None, "", "n", "1:a", "1:", ":", "|"]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "p string, q string")
    assert cl.ensure_transaction_id(df).select("transaction_id").distinct().count() == len(texts) ** 2
    zone = spark.conf.get("spark.sql.session.timeZone")
    when = spark.createDataFrame([(0,), (1700000000,)], "s long").select(F.timestamp_seconds("s").alias("t"))
    got = []
    try:
        for z in ("UTC", "Asia/Jakarta"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got.append(sorted(r.transaction_id for r in cl.ensure_transaction_id(when).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got[0] == got[1]


def test_latest_row_survives_for_text_and_typed_dates(spark):
    rows_ = [(1, "2024-01-02", "9"), (1, "2024-05-01", "1"), (2, None, "5")]
    text = spark.createDataFrame(rows_, "id int, created_date string, amount string")
    typed = text.withColumn("created_date", F.to_timestamp("created_date"))
    for df in (text, typed):
        kept = {r.id: r.amount for r in cl.clean_transactions(df).collect()}
        assert kept == {1: "1", 2: "5"}
