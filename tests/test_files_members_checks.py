"""Reject channel, own null token, inferred members, sketches, frequent values,
multiset checksums, co-located joins."""
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMOKE
from retailstar.operators import profile, quality
from retailstar.plans import dimensions as D
from retailstar.plans.facts import lookup_keys
from retailstar.plans.inferred import inferred_rows, with_inferred
from retailstar.plans.versions import next_versions
from retailstar.sinks.writers import write_csv
from retailstar.sources import files

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType()),
                       T.StructField("price", T.DecimalType(6, 2))])


def load(spark, tmp_path, text, **kw):
    (tmp_path / "in.csv").write_text(text)
    cells = files.read_cells(spark, str(tmp_path / "in.csv"), SCHEMA.names, multi_line=True)
    files.write_checked(files.checked_cells(cells, SCHEMA, **kw), str(tmp_path / "out"))
    good = sorted((tuple(r) for r in files.good_rows(spark, str(tmp_path / "out"), SCHEMA).collect()), key=repr)
    bad = sorted(((r.column, r.value, r.reason) for r in files.rejected_rows(spark, str(tmp_path / "out"), SCHEMA).collect()), key=repr)
    return good, bad


def test_rejects_say_column_value_and_reason(spark, tmp_path):
    good, bad = load(spark, tmp_path, 'Name,N,Price\na,1,2.50\n"b\nc, ""d""",2,3\ne,x,1\nf,3,99999.00\ng,4\nh,5,6,7\nNA,6,\ni,y,z\n',
                     required=["name"])
    assert [r[:2] for r in good] == [("a", 1), ("b\nc, \"d\"", 2)]
    assert bad == sorted([("n", "x", "not a int"), ("price", "99999.00", "not a decimal(6,2)"), (None, "g,4", "number of cells"),
                          (None, "h,5,6,7", "number of cells"), ("name", None, "missing"), ("n", "y", "not a int"),
                          ("price", "z", "not a decimal(6,2)")], key=repr)


def test_empty_file_and_wrong_header(spark, tmp_path):
    assert load(spark, tmp_path, "name,n,price\n") == ([], [])
    with pytest.raises(ValueError, match="header"):
        load(spark, tmp_path, "name,price,n\na,1,1\n")


def test_own_files_keep_texts_that_look_missing(spark, tmp_path):
    rows = [("None", 1), ("NA", 2), ("", 3), (None, 4), ("a\nb", 5), ('q"', 6), (" x ", 7), ("a\r\nb", 8), ("\\", 9)]
    df = spark.createDataFrame(rows, "name string, n int").repartition(3)
    write_csv(df, str(tmp_path / "own"), null_token=files.NULL_TOKEN)
    cells = files.read_cells(spark, str(tmp_path / "own"), df.columns, multi_line=True, null_token=files.NULL_TOKEN)
    back = files.checked_cells(cells, df.schema, na_tokens=[files.NULL_TOKEN])
    assert back.where(F.size("faults") > 0).count() == 0
    assert {r.n: r.name for r in back.collect()} == {n: t for t, n in rows}


def test_rejects_and_good_rows_are_all_rows(spark):
    import __spark_entry__ as E
    q = E.queries()
    c = q["csv_reject_counts"](spark, SMOKE).first()
    assert c.rows_in == c.good_rows + c.rejected_rows and c.rejected_rows > 0
    names = q["dirty_dim_product"](spark, SMOKE)
    assert not names.where("product_name = 'None'").isEmpty() and not names.where("product_name LIKE '%\n\"large\", Wide'").isEmpty()


def _dims(spark):
    lone = {"dim_product": (D.PRODUCT, [(1, "Tent", "Camping Gear", "Camping")], "product_id long, product_name string, product_type_name string, product_line_name string"),
            "dim_country": (D.COUNTRY, [(1, "Peru", 33, "Americas")], "country_id long, name string, population long, region string"),
            "dim_retailer": (D.RETAILER, [(1, "Golf Shop", 1)], "retailer_id long, name string, speciality_store int"),
            "dim_order_method": (D.ORDER_METHOD, [(1, "Web")], "order_method_id long, name string")}
    dims = {t: D.first_versions(spec, spark.createDataFrame(r, s)) for t, (spec, r, s) in lone.items()}
    return dims | {"dim_date": spark.createDataFrame([(1, 2012, 1)], "date_tk int, year int, quarter int")}


def test_inferred_members_are_filled_by_a_later_load(spark):
    sales = spark.createDataFrame(
        [("Tent", "Camping Gear", "Camping", "Peru", "Golf Shop", "Web", 2012, 1, 1, 1.0, 0.1)] * 2
        + [("Stove", "Cooking", "Camping", "Fiji", "Kiosk", "Fax", 2013, 2, 1, 1.0, 0.1), ("Tent", "Other", "Camping", "Fiji", "Kiosk", "Web", 2012, None, 1, 1.0, 0.1),
           ("Tent", "Camping Gear", "Camping", None, "Kiosk", "Web", 2012, 1, 1, 1.0, 0.1)],
        "product_name string, product_type_name string, product_line_name string, country_name string, retailer_name string, "
        "order_method string, year int, quarter int, quantity long, revenue double, gross_margin double")
    dims = with_inferred(_dims(spark), sales)
    assert sorted(tuple(r) for r in inferred_rows(dims).collect()) == [
        ("dim_country", 2, "Fiji"), ("dim_date", 2, "2013 / 2"), ("dim_order_method", 2, "Fax"),
        ("dim_product", 2, "Stove / Cooking / Camping"), ("dim_product", 3, "Tent / Other / Camping"), ("dim_retailer", 2, "Kiosk")]
    keys = lookup_keys(sales, dims)
    lost = {c: keys.where(F.col(c).isNull()).count() for c in keys.columns if c.endswith("_tk")}
    # only what has no name has no key
    assert lost == {"country_tk": 1, "retailer_tk": 0, "product_tk": 0, "order_method_tk": 0, "date_tk": 1}
    assert with_inferred(dims, sales)["dim_country"].count() == 2
    load = spark.createDataFrame([(9, "Fiji", 1, "Oceania"), (1, "Peru", 34, "Americas")], "country_id long, name string, population long, region string")
    after = next_versions(D.COUNTRY, dims["dim_country"], load, "2020-01-01", overwrite=F.col("inferred"))
    got = {(r.name, r.version): (r.country_tk, r.country_id, r.region) for r in after.collect()}
    assert got == {("Fiji", 1): (2, 9, "Oceania"), ("Peru", 1): (1, 1, "Americas"), ("Peru", 2): (3, 1, "Americas")}


def test_sketches(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("many"), (F.col("id") % 7).alias("few"),
                                     F.lit(None).cast("string").alias("none"), (F.col("id") % 4).alias("day"))
    parts = profile.distinct_sketches(df, ["day"])
    assert parts.count() == 4
    for sketches in (profile.merged_sketches(parts.drop("day")), profile.distinct_sketches(df.drop("day"))):
        got = {r.column: r.distinct_estimate for r in profile.distinct_estimates(sketches).collect()}
        assert abs(got["many"] - 50_000) <= profile.sketch_error() * 50_000 and got["few"] == 7 and got["none"] == 0
    # the only exchange carries sketches to one row
    plan = profile.distinct_sketches(df.drop("day"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange SinglePartition" in plan and "partial_hll_sketch_agg" in plan


@pytest.mark.parametrize("support", [0.3, 0.01, 0.0005])
def test_top_values_are_exact_at_any_support(spark, support):
    rows = [("hot" if i % 3 == 0 else f"v{i % 40}" if i % 3 == 1 else f"u{i}", i % 5, None if i % 2 else "x") for i in range(3_000)]
    rows += [(None, None, None)] * 9
    df = spark.createDataFrame(rows, "a string, b int, `c.d` string").repartition(5)
    got = sorted((r.column, r["rank"], r.value, r["count"]) for r in profile.top_values(df, 4, support).collect())
    want = []
    for k, c in enumerate(df.columns):
        counts = Counter(str(r[k]) for r in rows if r[k] is not None)
        want += [(c, n, v, m) for n, (v, m) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4], 1)]
    assert got == sorted(want)
    assert profile.top_values(df.limit(0), 3).count() == 0


def test_multiset_checksum(spark):
    df = spark.createDataFrame([(i % 50, None if i % 3 else "a", float(i % 4)) for i in range(900)], "i int, s string, f double")
    sums = lambda a, b: tuple(quality.bag_sums(a, b).first())
    assert sums(df, df.repartition(7)) == (900, 900, 0, 0)
    assert sums(df, df.where("i > 0")) == (900, 882, 18, 0)
    assert sums(df, df.unionByName(df.where("i = 1 AND s IS NULL"))) == (900, 912, 0, 12)
    # the same values in other columns, and a null elsewhere
    a = spark.createDataFrame([("x", None), ("y", "z")], "p string, q string")
    b = spark.createDataFrame([(None, "x"), ("z", "y")], "p string, q string")
    assert sums(a, b) == (2, 2, 2, 2) and sums(a.limit(0), b.limit(0)) == (0, 0, 0, 0)
    assert sums(spark.createDataFrame([(0.0,)], "f double"), spark.createDataFrame([(-0.0,)], "f double")) == (1, 1, 0, 0)


def test_colocated_fact_joins_without_a_shuffle(spark):
    from retailstar.plans.reports import REPORTS
    from retailstar.plans.warehouse import colocated, drop_colocated, warehouse_for
    star = warehouse_for(spark, SMOKE).star()
    want = REPORTS["top_products"](star).collect()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = REPORTS["top_products"](colocated(spark, star, "dim_product", "product_tk"))
        plan = report._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("SortMergeJoin"):]
        assert "Exchange" not in join and report.collect() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        drop_colocated(spark)
    assert not [t for t in spark.catalog.listTables() if "_by_product_tk_" in t.name]
