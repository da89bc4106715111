import os
import tempfile

from pyspark.sql import types as T

from retailstar.operators import profile, quality
from retailstar.sinks.writers import write_csv
from retailstar.sources.files import read_delimited


def test_bag_difference_and_orphans(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "a int, b string")
    r = quality.bag_difference(a, b).first()
    assert (r["missing_rows"], r["extra_rows"]) == (1, 1)
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1,), (5,), (None,)], "fk long")
    assert quality.orphans(child, "fk", parent, "id").first()[0] == 1


def test_expectations(spark):
    df = spark.range(3)
    assert quality.expect_count(df, 3) == 3
    try:
        quality.expect_count(df, 8, ">=")
        raise AssertionError("expected failure")
    except quality.ExpectationError:
        pass
    quality.expect_columns(df, ["id"])


def test_profile_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "s string, n int")
    nulls = {r["column"]: r["null_count"] for r in profile.null_counts(df).collect()}
    assert nulls == {"s": 1, "n": 1}
    distinct = {r["column"]: r["distinct_count"] for r in profile.distinct_counts(df).collect()}
    assert distinct == {"s": 1, "n": 2}
    vc = {(r["column"], r["value"]): r["count"] for r in profile.value_counts(df).collect()}
    assert vc[("s", "a")] == 2
    assert profile.shape(df).first().asDict() == {"rows": 3, "columns": 2}


def test_csv_missing_tokens_and_types(spark):
    d = tempfile.mkdtemp(prefix="retailstar-csv-")
    path = os.path.join(d, "in.csv")
    with open(path, "w") as f:
        f.write("Retailer country,Year,Revenue\nCanada,2012,10.5\nNA,2013,n/a\nPeru,x,\n")
    schema = T.StructType([T.StructField("retailer_country", T.StringType()),
                           T.StructField("year", T.IntegerType()),
                           T.StructField("revenue", T.DoubleType())])
    df = read_delimited(spark, path, schema)
    assert [tuple(r) for r in df.collect()] == [("Canada", 2012, 10.5), (None, 2013, None),
                                               ("Peru", None, None)]
    out = os.path.join(d, "out")
    write_csv(df, out)
    back = read_delimited(spark, out, schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_csv_quotes_commas_and_line_breaks_round_trip(spark, tmp_path):
    rows = [('Star "X" Lite, 2p', "a\nb"), ("  padded ", 'only "'), ("plain", None), ("NA", "x")]
    df = spark.createDataFrame(rows, "Name string, Note string")
    path = str(tmp_path / "csv")
    write_csv(df, path)
    back = read_delimited(spark, path, df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(
        [r if r[0] != "NA" else (None, "x") for r in rows], key=str)
    # as pandas reads and writes it
    import glob
    import pandas as pd
    got = pd.concat([pd.read_csv(f, keep_default_na=False) for f in glob.glob(f"{path}/*.csv")])
    assert set(got["Name"]) == {r[0] for r in rows}
    one = str(tmp_path / "one.csv")
    pd.DataFrame(rows, columns=["Name", "Note"]).to_csv(one, index=False)
    assert read_delimited(spark, one, df.schema, multi_line=True).count() == 4


def test_csv_header_must_match(spark, tmp_path):
    import pytest
    path = str(tmp_path / "h.csv")
    with open(path, "w") as f:
        f.write("Year,Country\n2012,Peru\n")
    with pytest.raises(ValueError, match="header"):
        read_delimited(spark, path, T.StructType.fromDDL("country string, year int"))


def test_rows_with_a_null_are_dropped(spark):
    from retailstar.plans.preprocess import clean_flat
    cols = ["Retailer country", "Gross margin", "Year"]
    rows = [("USA", 0.5, 1), (None, 0.5, 1), ("UK", None, 1), ("Peru", 0.5, None), ("Chile", 0.1, 2)]
    out = clean_flat(spark.createDataFrame(rows, "c string, g double, y int").toDF(*cols))
    assert out.columns == ["retailer_country", "gross_margin", "year"]
    assert sorted(r.retailer_country for r in out.collect()) == ["Chile", "United States"]


def test_profile_of_an_all_null_column(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", None)], "s string, n int")
    assert {r["column"]: r.distinct_count for r in profile.distinct_counts(df).collect()} == {"s": 2, "n": 0}
    top = profile.top_values(df, 1).collect()
    assert [(r["column"], r.value, r["count"], r["rank"]) for r in top] == [("s", "a", 2, 1)]
    assert [tuple(r) for r in profile.schema_rows(df).orderBy("position").collect()] == [
        (1, "s", "string"), (2, "n", "int")]


def test_orphans_of_several_keys_and_nulls(spark):
    child = spark.createDataFrame([(1, 5), (2, None), (9, 5), (9, 6)], "a long, b int")
    p, q = spark.createDataFrame([(1,), (2,)], "id long"), spark.createDataFrame([(6,), (6,)], "k int")
    out = {r.column_name: r.orphans for r in quality.orphans_all(child, {"a": (p, "id"), "b": (q, "k")}).collect()}
    assert out == {"a": 2, "b": 2}


def test_not_null_violations(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    out = {r.column_name: r.null_rows for r in quality.not_null_violations({"t": (df, ["a", "b"])}).collect()}
    assert out == {"a": 1, "b": 2}


def test_round_trip_has_one_exchange_on_rows_and_no_cross_join(spark, capsys):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    out = quality.roundtrip(a, a.limit(2))
    assert tuple(out.first())[:2] == (3, 2)
    out.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_sql_catalog_and_insert_select(spark, tmp_path):
    from retailstar.sinks import writers
    from retailstar.sources import catalog
    small = catalog.small_table(spark, [("Peru", 33, "Americas")], catalog.COUNTRY_REFERENCE_SCHEMA)
    tables = catalog.merge_sources({"country": small, "gone": None}, {"extra": spark.range(2)})
    assert sorted(tables) == ["country", "extra"]
    assert catalog.register_views(tables, "t_") == ["t_country", "t_extra"]
    assert catalog.run_sql(spark, "SELECT region FROM t_country, t_extra WHERE id = 1").first()[0] == "Americas"
    assert "t_country" in {r.tableName for r in catalog.list_tables(spark).collect()}
    spark.sql(f"CREATE TABLE ins_target (id long) USING parquet LOCATION '{tmp_path}/ins'")
    writers.insert_into(spark.range(3), "ins_target")
    writers.insert_into(spark.range(2), "ins_target")
    assert spark.table("ins_target").count() == 5
    writers.insert_into(spark.range(1), "ins_target", overwrite=True)
    assert spark.table("ins_target").count() == 1
    writers.drop_tables(spark, ["ins_target"])
    assert not spark.catalog.tableExists("ins_target")


def test_append_truncate_and_single_file(spark, tmp_path):
    from retailstar.sinks import writers
    path = str(tmp_path / "fact")
    df = spark.range(10).selectExpr("id", "cast(id % 2 AS int) AS date_tk")
    assert writers.write_parquet(df, path, partition_by=["date_tk"], count=True) == 10
    assert writers.write_parquet(df, path, mode="append", partition_by=["date_tk"], count=True) == 10
    assert spark.read.parquet(path).filter("date_tk = 1").count() == 10
    spark.sql("CREATE TABLE trunc_target (id long) USING parquet")
    writers.insert_into(spark.range(4), "trunc_target")
    writers.truncate_table(spark, "trunc_target")
    assert spark.table("trunc_target").count() == 0
    writers.drop_tables(spark, ["trunc_target"])
    writers.export_single_file(df, str(tmp_path / "one"))
    import glob
    assert len(glob.glob(f"{tmp_path}/one/*.csv")) == 1
    writers.write_format(df, "parquet", compression="gzip", path=str(tmp_path / "any"))
    assert spark.read.parquet(str(tmp_path / "any")).count() == 10
    seen = []
    assert writers.load_all({"b": df, "a": df}, lambda d, n: seen.append(n), ["a", "b"]) == seen == ["a", "b"]
