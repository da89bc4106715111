"""A load's tasks follow its input, and what it reads per row is little."""

import pytest

from retailstar import session
from retailstar.operators import quality
from retailstar.plans import dimensions as D
from retailstar.plans import facts, inferred
from retailstar.plans.warehouse import build_warehouse

from tests.conftest import SMOKE


def _conf(spark):
    return {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                                 "spark.sql.maxConcurrentOutputFileWriters")}


def test_partitions_of_a_load_follow_its_input(spark):
    """Not the session's setting alone: 3 GB in 8 partitions spill. The session's own
    settings are back afterwards, also after an error."""
    had = _conf(spark)
    with session.sized_for(spark, 3 << 30):
        assert session.shuffle_partitions(spark) == 384
    assert _conf(spark) == had
    with session.sized_for(spark, 0):
        assert session.shuffle_partitions(spark) == 8
    with pytest.raises(KeyError), session.sized_for(spark, 1 << 60):
        assert session.shuffle_partitions(spark) == session.MOST_PARTITIONS
        raise KeyError
    assert _conf(spark) == had


def test_few_folders_are_written_without_a_sort(spark, tmp_path):
    """Wide rows for two folders are not sorted (and spilled) by folder; every row is written."""
    spark.range(1000).selectExpr("id", "id % 5 = 0 AS part").createOrReplaceTempView("to_write")
    plans = {}
    for how in ("plain", "sized"):
        spark.sql(f"CREATE TABLE t_{how} (id LONG, part BOOLEAN) USING parquet PARTITIONED BY (part) LOCATION '{tmp_path}/{how}'")
        insert = f"INSERT INTO t_{how} SELECT * FROM to_write"
        if how == "sized":
            with session.sized_for(spark, 1):
                plans[how] = spark.sql(f"EXPLAIN {insert}").first()[0]
                spark.sql(insert)
        else:
            plans[how] = spark.sql(f"EXPLAIN {insert}").first()[0]
    assert "Sort [" in plans["plain"] and "Sort [" not in plans["sized"]
    assert spark.table("t_sized").groupBy("part").count().orderBy("part").collect() == [(False, 800), (True, 200)]
    for how in plans:
        spark.sql(f"DROP TABLE t_{how}")


def test_a_build_runs_in_partitions_of_its_input(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(session, "LOAD_BYTES", 1 << 14)
    from retailstar.operators import keys
    made = keys.temporary_table

    def noted(df, name):
        seen.append(session.shuffle_partitions(spark))
        return made(df, name)

    monkeypatch.setattr(keys, "temporary_table", noted)
    wh = build_warehouse(spark, SMOKE)
    assert wh.input_bytes > 100_000 and set(seen) == {-(-wh.input_bytes // (1 << 14))} != {8} and session.shuffle_partitions(spark) == 8
    assert wh.rows["star/fact_sales"] == wh.rows["processed"]


def test_periods_are_parsed_once_per_text(spark):
    """What is parsed comes out of a distinct, it does not go in row by row."""
    sales = spark.createDataFrame([(2001, "Q1 2001")] * 5 + [(2001, " Q1"), (None, "Q2"), (2002, "none")], "year int, quarter string")
    found = D.periods(sales)
    assert [tuple(r) for r in found.collect()] == [(2001, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" in plan and "LogicalRDD" not in plan


def test_fact_keys_come_by_id_and_read_names_once_per_member(spark):
    """The rows of the database's sales meet ids only: no name or pattern per sale."""
    t = {"country": spark.createDataFrame([(1, " peru "), (2, "FIJI")], "id long, name string"),
         "order_method": spark.createDataFrame([(1, "web")], "id long, name string"),
         "retailer_type": spark.createDataFrame([(1, "kiosk")], "id long, name string"),
         "product_line": spark.createDataFrame([(1, "camping")], "id long, name string"),
         "product_type": spark.createDataFrame([(1, "tents", 1)], "id long, name string, product_line_fk long"),
         "product": spark.createDataFrame([(1, "star", 1), (2, "moon", None)], "id long, name string, product_type_fk long"),
         "sales": spark.createDataFrame([(1, 2001, "Q1 2001", 5.0, 1, 0.1, 1, 1, 1, 1), (2, 2001, " Q2", 6.0, 2, 0.2, 2, 1, 2, 1),
                                         (3, 2001, "Q3", 7.0, 3, 0.3, None, 1, 9, 1), (4, None, "Q1 2001", 8.0, 4, 0.4, 1, None, 1, 1)],
                                        "id long, year int, quarter string, revenue double, quantity int, gross_margin double, "
                                        "country_fk long, order_method_fk long, product_fk long, retailer_type_fk long")}
    dims = {"dim_product": D.dim_product(t["product"], t["product_type"], t["product_line"]),
            "dim_country": D.first_versions(D.COUNTRY, spark.createDataFrame([(1, "Peru", 1, "R"), (2, "Fiji", 1, "R")], "country_id long, name string, population long, region string")),
            "dim_retailer": D.first_versions(D.RETAILER, spark.createDataFrame([(1, "Kiosk", 1)], "retailer_id long, name string, speciality_store int")),
            "dim_order_method": D.first_versions(D.ORDER_METHOD, spark.createDataFrame([(1, "Web")], "order_method_id long, name string")),
            "dim_date": spark.createDataFrame([(1, 2001, 1), (2, 2001, 2)], "date_tk int, year int, quarter int")}
    rows = facts.fact_rows(t, dims)
    assert "initcap" not in (plan := rows._jdf.queryExecution().optimizedPlan().toString()) and "regexp" not in plan
    by = facts.lookup_keys(facts.database_sales(t), dims)
    assert sorted(map(str, rows.collect())) == sorted(map(str, by.collect()))
    drop = facts.fact_rows(t, dims, unmatched="drop")
    assert sorted(map(str, drop.collect())) == sorted(map(str, facts.lookup_keys(facts.database_sales(t), dims, "drop").collect()))
    assert rows.count() == 4 and drop.count() == 2 and rows.where("date_tk IS NULL").count() == 2


def test_inferred_names_are_taken_apart(spark, monkeypatch):
    """No distinct over products and all other names at once, which nothing shrinks."""
    seen, made = [], inferred.temporary_table

    def noted(df, name):
        seen.append(set(df.columns))
        return made(df, name)

    monkeypatch.setattr(inferred, "temporary_table", noted)
    sales = spark.createDataFrame([(f"P{i % 30}", "T", "L", f"C{i % 7}", "R", "M", 2001 + i % 3, 1) for i in range(630)],
                                  "product_name string, product_type_name string, product_line_name string, country_name string, "
                                  "retailer_name string, order_method string, year int, quarter int")
    empty = {"dim_product": (D.PRODUCT, "product_id long, product_name string, product_type_name string, product_line_name string"),
             "dim_country": (D.COUNTRY, "country_id long, name string, population long, region string"),
             "dim_retailer": (D.RETAILER, "retailer_id long, name string, speciality_store int"),
             "dim_order_method": (D.ORDER_METHOD, "order_method_id long, name string")}
    dims = {d: D.scd_columns(spark.createDataFrame([], s).selectExpr(f"CAST(NULL AS LONG) AS {spec.key}", "*"), spec.key) for d, (spec, s) in empty.items()}
    dims["dim_date"] = spark.createDataFrame([], "date_tk int, year int, quarter int")
    found = inferred.with_inferred(dims, sales)
    assert {d: df.count() for d, df in found.items()} == {"dim_product": 30, "dim_country": 7, "dim_retailer": 1, "dim_order_method": 1, "dim_date": 3}
    assert seen and not any({"product_name", "country_name"} <= s for s in seen)


def test_orphans_are_counted_by_numbers(spark):
    """Counts per key carry no column name; null keys and repeated parents do not count."""
    child = spark.createDataFrame([(1, 5), (1, None), (9, 6), (9, 5), (None, 7)], "a long, b int")
    one, two = spark.createDataFrame([(1,), (1,), (None,)], "k long"), spark.createDataFrame([(5,)], "k int")
    found = quality.orphans_all(child, {"a": (one, "k"), "b": (two, "k")})
    assert sorted(map(tuple, found.collect())) == [("a", 2), ("b", 2)]
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert quality.orphans_all(child.limit(0), {"a": (one, "k")}).collect() == [("a", 0)]
