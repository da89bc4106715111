"""A load does each thing once, and what does not need each other side by side."""
import threading

import pytest
from pyspark.sql import functions as F

from retailstar.operators.keys import dense_number
from retailstar.operators.split import label_split
from retailstar.plans import dimensions as D
from retailstar.plans import facts, publish, reload
from retailstar.plans.versions import next_versions
from retailstar.session import at_once


def test_steps_run_side_by_side(spark):
    """Two steps that wait for each other end; results keep the order, errors are raised when all have ended."""
    meet, ended = threading.Barrier(2, timeout=60), []

    def step(n):
        meet.wait()
        found = spark.range(n).count(), spark.sparkContext.getLocalProperty("who")
        ended.append(n)
        return found

    spark.sparkContext.setLocalProperty("who", "a load")
    try:
        assert at_once(spark, [lambda: step(3), lambda: step(5)]) == [(3, "a load"), (5, "a load")]
    finally:
        spark.sparkContext.setLocalProperty("who", None)
    assert at_once(spark, []) == []

    def fails():
        meet.wait()
        raise KeyError("one")

    ended.clear()
    with pytest.raises(KeyError):
        at_once(spark, [fails, lambda: step(7)])
    assert ended == [7]


def test_what_steps_have_written_comes_together():
    old = publish.Manifest(3, {"a": "a-1", "b": "b-1"}, {"sales": {"1": "1-x", "2": "2-x"}}, {"a": 5, "b": 6, "sales/1": 7, "sales/2": 8})
    parts = [old.with_table("a", "a-2", 9), old.with_table("b", "b-2", 6), old.with_load("sales", "2", "2-y", 4), old, old.with_load("fact", "2", "f", 1)]
    assert reload._joined(old, parts) == publish.Manifest(
        3, {"a": "a-2", "b": "b-2"}, {"sales": {"1": "1-x", "2": "2-y"}, "fact": {"2": "f"}},
        {"a": 9, "b": 6, "sales/1": 7, "sales/2": 4, "fact/2": 1})
    assert reload._joined(old, []) == old


def test_members_are_made_once(spark):
    """The check of the business key and the join read what has been made, they do not make it again."""
    made = spark.sparkContext.accumulator(0)

    def member(i):
        made.add(1)
        return i, f"C{i}", i + 1, "R"

    kind = "country_id long, name string, population long, region string"
    one = D.first_versions(D.COUNTRY, spark.createDataFrame([(i, f"C{i}", i, "R") for i in range(20)], kind))
    members = spark.createDataFrame(spark.sparkContext.parallelize(range(20), 2).map(member), kind)
    assert next_versions(D.COUNTRY, one, members, "2020-01-01").count() == 40
    assert made.value == 20


def test_split_hashes_a_row_once_for_its_label(spark):
    rows = spark.range(500).selectExpr("id % 400 AS a", "string(id % 7) AS b")
    out = label_split(rows, 0.2)
    assert out._jdf.queryExecution().executedPlan().toString().count("md5(") == 1
    assert {r.part: r.n for r in out.groupBy("part").agg(F.count("*").alias("n")).collect()} == {"sample": 100, "rest": 400}


def test_places_that_are_there_are_not_numbered_again(spark):
    """The same numbers, also beyond the most places and with null combinations."""
    rows = spark.createDataFrame([(i % 11, i % 3 or None, f"q{i % 4}", i) for i in range(200)], "p long, a int, b string, v int")
    order = ["p", "a", "b", "v"]
    plain = sorted(dense_number(rows, order, "n").collect(), key=lambda r: r.n)
    places = dense_number(rows.select("a", "b").distinct(), ["a", "b"], "place").persist()
    try:
        for n in (places.count(), 1_000_000):
            got = dense_number(rows, order, "n", together=["a", "b"], places=(places, n))
            assert got.columns == [*rows.columns, "n"] and sorted(got.collect(), key=lambda r: r.n) == plain
    finally:
        places.unpersist()


def test_sales_over_time_come_by_id(spark):
    """The rows of the lookups by name and date, without a name or a pattern per sale."""
    names = lambda *n: spark.createDataFrame([(i + 1, x) for i, x in enumerate(n)], "id long, name string")
    t = {"country": names(" peru ", "FIJI", "peru", "rome", None), "order_method": names("web"), "retailer_type": names("kiosk").selectExpr("*", "1 AS speciality_store"), "product_line": names("camping"),
         "product_type": spark.createDataFrame([(1, "tents", 1)], "id long, name string, product_line_fk long"),
         "product": spark.createDataFrame([(1, "star", 1), (2, "moon", None), (3, "gone", 1)], "id long, name string, product_type_fk long")}
    t["sales"] = spark.createDataFrame(
        [(i, 2018 + i % 5 if i % 7 else None, [f"Q{1 + i % 4} x", " Q2", "none", None][i % 4], float(i), i, 0.1,
          i % 6 + 1 if i % 9 else None, 1 + i % 2, i % 4 + 1 if i % 5 else None, 1) for i in range(90)],
        "id long, year int, quarter string, revenue double, quantity int, gross_margin double, "
        "country_fk long, order_method_fk long, product_fk long, retailer_type_fk long")
    country = D.first_versions(D.COUNTRY, spark.createDataFrame([(1, "Peru", 33, "A"), (2, "Fiji", 1, "O"), (None, None, 1, "O")], "country_id long, name string, population long, region string"))
    country = next_versions(D.COUNTRY, country, spark.createDataFrame([(1, "Peru", 34, "A")], "country_id long, name string, population long, region string"), "2020-01-01")
    product = D.dim_product(t["product"].where("id < 3"), t["product_type"], t["product_line"])
    product = next_versions(D.PRODUCT, product, spark.createDataFrame(
        [(1, "Star", "Huts", "Camping")], "product_id long, product_name string, product_type_name string, product_line_name string"), "2019-04-01", key=("product_name",))
    dims = {"dim_product": product, "dim_country": country, "dim_retailer": D.dim_retailer(t["retailer_type"]),
            "dim_order_method": D.dim_order_method(t["order_method"]), "dim_date": D.dim_date(t["sales"]).where("year <> 2021")}
    rows = facts.database_sales(t).withColumn("sold", F.make_date("year", F.col("quarter") * 3 - 2, F.lit(1)).cast("timestamp"))
    for how in ("keep", "drop"):
        by = facts.lookup_keys(rows, dims, how, at="sold", lookups=reload.LOOKUPS_OVER_TIME)
        got = facts.fact_rows_over_time(t, dims, reload.LOOKUPS_OVER_TIME, how)
        assert sorted(map(str, got.collect())) == sorted(map(str, by.collect())) and got.count() > 0
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "initcap" not in plan and "regexp" not in plan
        assert got.columns == by.columns
        if how == "keep":   # none, Fiji and both versions of Peru
            assert got.count() == 90 and got.select("country_tk").distinct().count() == 4
