"""What the build shuffles is narrow: one place stands for columns of few combinations."""

from decimal import Decimal

import pytest

from retailstar import session
from retailstar.operators import keys
from retailstar.plans import facts, normalize
from retailstar.plans.warehouse import build_dimensions
from retailstar.sources.testdata import sales_lines

from tests.conftest import SMOKE


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def ranged(monkeypatch):
    """Per table that is sorted in ranges: its columns and the line of the plan that deals them."""
    seen, made = [], keys.temporary_table

    def noted(df, name):
        if name == "numbered":
            seen.append((df.columns, next(line for line in _plan(df).splitlines() if "RepartitionByExpression" in line)))
        return made(df, name)

    monkeypatch.setattr(keys, "temporary_table", noted)
    return seen


def test_columns_together_are_numbered_as_one_by_one(spark, ranged):
    rows = [(i % 3 or None, ["b", None, "a"][i % 7 % 3], i % 4 or None, i % 5) for i in range(200)] * 2
    df = spark.createDataFrame(rows, "a int, b string, c int, d int")
    order = ["d", "a", "b", "c"]
    plain = keys.dense_number(df, order, "n").collect()
    ranged.clear()
    got, n = keys.numbered_with_total(df, order, "n", together=["a", "b"], partitions=5)
    assert got.columns == ["a", "b", "c", "d", "n"] and got.dtypes[:4] == df.dtypes and n == 400
    assert sorted(map(str, got.collect())) == sorted(map(str, plain))
    line = next(line for cols, line in ranged if "d" in cols)
    assert "__rs_place" in line and "a#" not in line and "b#" not in line
    assert keys.dense_number(df.limit(0), order, "n", together=["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        keys.dense_number(df, order, "n", together=["d", "b"])


def test_many_combinations_are_sorted_as_they_are(spark, ranged, monkeypatch):
    """A large table of places would be joined by two more shuffles of the rows."""
    df = spark.createDataFrame([(i % 40, i % 7, i % 3) for i in range(300)], "a int, b int, c int")
    plain = keys.dense_number(df, ["a", "b", "c"], "n").collect()
    monkeypatch.setattr(keys, "MOST_PLACES", 100)
    ranged.clear()
    got = keys.dense_number(df, ["a", "b", "c"], "n", together=["a", "b"]).collect()
    assert sorted(got) == sorted(plain)
    assert not any("__rs_place" in line for columns, line in ranged if "c" in columns)


def test_fact_and_sales_are_sorted_without_small_keys_and_quarters(spark, ranged):
    fact = [(i % 11, i % 3 or None, i % 2, i % 4 + 1, 1, Decimal(i % 5), i % 6, Decimal("0.1")) for i in range(90)]
    cols = "product_tk long, country_tk long, retailer_tk long, date_tk int, order_method_tk long, revenue decimal(18,4), " \
           "quantity long, gross_margin decimal(6,4)"
    got = facts.number_fact(spark.createDataFrame(fact, cols)).orderBy("fact_sales_tk").collect()
    first = lambda r: tuple((v is not None, v) for v in r)
    assert [tuple(r[c] for c in facts.FACT_KEY_ORDER) for r in got] == sorted(fact, key=first)
    assert [r.fact_sales_tk for r in got] == list(range(1, 91))
    flat = spark.createDataFrame(
        [(f"C{i % 3}", "M", "T", "L", "L B", f"P{i % 5}", 2001 + i % 2, f"Q{i % 4 + 1}" if i % 9 else None, Decimal(i % 7), i % 4, Decimal("0.1"))
         for i in range(60)],
        "retailer_country string, order_method_type string, retailer_type string, product_line string, product_type string, "
        "product string, year int, quarter string, revenue decimal(18,4), quantity int, gross_margin decimal(6,4)")
    sales = normalize.normalize_sales(flat, normalize.normalize_entities(flat, spark.createDataFrame([], "name string, population long, region string")))
    assert [r.id for r in sales.orderBy("id").collect()] == list(range(1, 61)) and sales.where("quarter IS NULL").count() == 7
    lines = [line for columns, line in ranged if "revenue" in columns]
    assert len(lines) == 2 and all("__rs_place" in line for line in lines)
    assert not any(f"{c}#" in line for line in lines for c in ("country_tk", "date_tk", "order_method_tk", "year", "quarter"))


def test_sales_meet_their_products_last(spark):
    names = spark.createDataFrame([(1, "a")], "id long, name string")
    t = {"country": names.selectExpr("*", "1L AS population", "'r' AS region"), "order_method": names, "product_line": names,
         "retailer_type": names.selectExpr("*", "1 AS speciality_store")}
    t["product_type"] = names.selectExpr("*", "1L AS product_line_fk")
    t["product"] = names.selectExpr("*", "1L AS product_type_fk")
    t["sales"] = spark.createDataFrame([(1, 2001, "Q1 2001", 5.0, 1, 0.1, 1, 1, 1, 1)],
                                       "id long, year int, quarter string, revenue double, quantity int, gross_margin double, "
                                       "country_fk long, order_method_fk long, product_fk long, retailer_type_fk long")
    dims = build_dimensions(t, None, None)
    found = facts.fact_rows(t, dims)
    joins = [line for line in _plan(found).splitlines() if "Join" in line]
    assert len(joins) == 5 and "product_fk" in joins[0]
    assert [tuple(r) for r in found.collect()] == [(1, 1, 1, 1, 1, 5.0, 1, 0.1)]


def test_orders_bring_their_quarter_not_their_day(spark):
    lines = sales_lines(spark, SMOKE)
    above = [line for line in _plan(lines).splitlines() if "o_orderdate" in line and "Relation" not in line and "Filter" not in line]
    assert len(above) == 1 and "trunc(" in above[0]


def test_a_load_reads_its_tables_in_small_pieces(spark, tmp_path, monkeypatch):
    """A piece of the session's 128 MB of narrow rows is more than a task sorts in memory."""
    spark.range(1 << 18).selectExpr("id", "md5(string(id)) AS s").coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(f"{tmp_path}/t")
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    monkeypatch.setattr(session, "SPLIT_BYTES", 1 << 20)
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")   # else the cores decide
    try:
        with session.sized_for(spark, 1):
            assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() >= 8
        assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == had
