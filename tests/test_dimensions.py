from pyspark.sql import functions as F

from retailstar.plans.dimensions import (current_rows, dim_country, dim_date, dim_order_method,
                                         dim_product, dim_retailer)
from retailstar.plans.facts import fact_sales

FLAT = ("retailer_country string, order_method_type string, retailer_type string, "
        "product_line string, product_type string, product string, year int, quarter string, "
        "revenue decimal(18,4), quantity int, gross_margin decimal(6,4)")


def _ref(spark):
    return spark.createDataFrame([("Canada", 38, "Americas"), ("Peru", 33, "Americas")],
                                 "name string, population long, region string")


def test_dim_country_sources_overlap_and_enrichment(spark):
    db = spark.createDataFrame([(7, "canada ", 38, "americas")],
                               "id long, name string, population long, region string")
    csv = spark.createDataFrame([("  CANADA",), ("peru",), ("Atlantis",)], "retailer_country string")
    d = dim_country(db, csv, _ref(spark))
    got = {r["name"]: (r["country_id"], r["population"], r["region"]) for r in d.collect()}
    assert got == {"Canada": (7, 38, "Americas"), "Peru": (None, 33, "Americas"),
                   "Atlantis": (None, None, "Unknown")}
    assert sorted(r["country_tk"] for r in d.collect()) == [1, 2, 3]
    # key order is (region, name)
    assert [r["name"] for r in d.orderBy("country_tk").collect()] == ["Canada", "Peru", "Atlantis"]
    assert d.filter(F.col("date_to").isNull()).count() == 3


def test_dim_country_without_file_source(spark):
    db = spark.createDataFrame([(1, "Peru", 33, "Americas")],
                               "id long, name string, population long, region string")
    assert dim_country(db, None, None).count() == 1


def test_dim_product_fills_unknown_type(spark):
    product = spark.createDataFrame([(1, "tent", None), (2, "stove", 10)],
                                    "id long, name string, product_type_fk long")
    ptype = spark.createDataFrame([(10, "cooking gear", 5)], "id long, name string, product_line_fk long")
    line = spark.createDataFrame([(5, "camping")], "id long, name string")
    d = dim_product(product, ptype, line)
    got = {r["product_name"]: (r["product_type_name"], r["product_line_name"]) for r in d.collect()}
    assert got == {"Tent": ("Unknown Type", "Misc Line"), "Stove": ("Cooking Gear", "Camping")}


def test_dim_date_skips_bad_quarters(spark):
    sales = spark.createDataFrame([(2012, "Q1 2012"), (2012, " Q3 2012 "), (2012, "Q5"),
                                   (2013, ""), (2013, None), (2012, "Q1 2012")],
                                  "year int, quarter string")
    d = dim_date(sales)
    assert [(r["date_tk"], r["year"], r["quarter"]) for r in d.orderBy("date_tk").collect()] == [
        (1, 2012, 1), (2, 2012, 3)]


def test_dim_retailer_and_order_method(spark):
    rt = spark.createDataFrame([(1, "golf shop", 1)], "id long, name string, speciality_store int")
    csv = spark.createDataFrame([("Golf Shop",), ("outdoors shop",)], "retailer_type string")
    r = dim_retailer(rt, csv)
    got = {x["name"]: (x["retailer_id"], x["speciality_store"]) for x in r.collect()}
    assert got["Golf Shop"] == (1, 1) and got["Outdoors Shop"][0] is None
    om = spark.createDataFrame([(3, "web")], "id long, name string")
    csv2 = spark.createDataFrame([("Web",), ("fax",)], "order_method_type string")
    assert sorted(x["name"] for x in dim_order_method(om, csv2).collect()) == ["Fax", "Web"]


def test_current_rows_accepts_both_conventions(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, None), (2, dt.datetime(9999, 12, 31)), (3, dt.datetime(2020, 1, 1))],
                               "k int, date_to timestamp")
    assert sorted(r["k"] for r in current_rows(df).collect()) == [1, 2]


def _tables(spark):
    t = {
        "country": spark.createDataFrame([(1, "Canada", 38, "Americas")],
                                         "id long, name string, population long, region string"),
        "order_method": spark.createDataFrame([(1, "Web")], "id long, name string"),
        "retailer_type": spark.createDataFrame([(1, "Golf Shop", 0)],
                                               "id long, name string, speciality_store int"),
        "product_line": spark.createDataFrame([(1, "Camping")], "id long, name string"),
        "product_type": spark.createDataFrame([(1, "Tents", 1), (2, "Lanterns", 1)],
                                              "id long, name string, product_line_fk long"),
        # the same product name under two types
        "product": spark.createDataFrame([(1, "Star", 1), (2, "Star", 2)],
                                         "id long, name string, product_type_fk long"),
        "sales": spark.createDataFrame(
            [(1, 2012, "Q1 2012", 10.0, 1, 0.5, 1, 1, 1, 1),
             (2, 2012, "Q2 2012", 20.0, 2, 0.4, 1, 1, 2, 1),
             (3, 2012, "Q2 2012", 30.0, 3, 0.3, 1, 1, 2, 9)],
            "id long, year int, quarter string, revenue double, quantity int, gross_margin double, "
            "country_fk long, order_method_fk long, product_fk long, retailer_type_fk long"),
    }
    return t


def _dims(spark, t):
    return {"dim_product": dim_product(t["product"], t["product_type"], t["product_line"]),
            "dim_country": dim_country(t["country"]),
            "dim_retailer": dim_retailer(t["retailer_type"]),
            "dim_order_method": dim_order_method(t["order_method"]),
            "dim_date": dim_date(t["sales"])}


def test_fact_same_product_name_two_types_no_fanout(spark):
    t = _tables(spark)
    f = fact_sales(t, _dims(spark, t))
    assert f.count() == 3
    assert f.filter(F.col("product_tk").isNull()).count() == 0
    assert sorted(r["fact_sales_tk"] for r in f.collect()) == [1, 2, 3]


def test_fact_unknown_retailer_keep_or_drop(spark):
    t = _tables(spark)
    keep = fact_sales(t, _dims(spark, t), unmatched="keep")
    drop = fact_sales(t, _dims(spark, t), unmatched="drop")
    assert keep.count() == 3 and keep.filter(F.col("retailer_tk").isNull()).count() == 1
    assert drop.count() == 2


def test_reference_duplicates_and_untidy_names(spark):
    db = spark.createDataFrame([], "id long, name string, population long, region string")
    csv = spark.createDataFrame([("canada",), ("Peru ",)], "retailer_country string")
    ref = spark.createDataFrame([("CANADA ", 38, "Americas"), ("Canada", 40, "Americas"), ("canada", None, "X"),
                                 (" peru", 33, "Americas"), (None, 1, "Nowhere")],
                                "name string, population long, region string")
    d = dim_country(db, csv, ref)
    assert sorted((r.name, r.population, r.region) for r in d.collect()) == [
        ("Canada", 38, "Americas"), ("Peru", 33, "Americas")]


def test_version_dates_follow_the_session_not_the_driver(spark):
    import os
    import time
    om = spark.createDataFrame([(3, "web")], "id long, name string")
    before = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        d = dim_order_method(om, open_end="9999-12-31 00:00:00")
        assert d.select(F.col("date_from").cast("string")).first()[0] == "1900-01-01 00:00:00"
        assert current_rows(d).count() == 1
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()


def test_load_timestamp_reaches_every_dimension(spark):
    t = _tables(spark)
    when = "2024-05-06 07:08:09"
    for d in (dim_product(t["product"], t["product_type"], t["product_line"], load_ts=when),
              dim_country(t["country"], load_ts=when), dim_retailer(t["retailer_type"], load_ts=when),
              dim_order_method(t["order_method"], load_ts=when)):
        assert {r[0] for r in d.select(F.col("date_from").cast("string")).collect()} == {when}


def test_repeated_business_key_fails_the_build(spark):
    import pytest
    from retailstar.operators.quality import ExpectationError
    from retailstar.plans.warehouse import check_business_keys
    good = spark.createDataFrame([("a",), ("b",)], "name string")
    check_business_keys({"dim_country": good})
    with pytest.raises(ExpectationError, match="dim_country"):
        check_business_keys({"dim_country": good.union(good)})


def test_types_under_two_lines_are_reported(spark):
    from retailstar.plans.normalize import type_conflicts
    df = spark.createDataFrame([("t", "x"), ("t", "y"), ("u", "x")], "product_type string, product_line string")
    assert [tuple(r) for r in type_conflicts(df).collect()] == [("t", 2)]


def test_fact_by_source_id_drops_rows_without_match(spark):
    from retailstar.plans.facts import fact_by_source_id
    t = _tables(spark)
    out = fact_by_source_id(t["sales"], _dims(spark, t)).collect()
    assert sorted(r.sales_id for r in out) == [1, 2]
