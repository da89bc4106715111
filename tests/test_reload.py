"""Loads after the first: versions, stable keys, lookups at a date, publishing."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailstar.operators.keys import extend_keys, with_stable_keys
from retailstar.operators.quality import ExpectationError
from retailstar.plans import dimensions as D
from retailstar.plans import publish as P
from retailstar.plans.facts import LOOKUPS, lookup_keys
from retailstar.plans.versions import next_versions, valid_at

MEMBERS = "country_id long, name string, population long, region string"


def members(spark, *rows):
    return spark.createDataFrame(list(rows), MEMBERS)


def first(spark, *rows):
    return D.first_versions(D.COUNTRY, members(spark, *rows))


def rows_of(df):
    day = lambda t: None if t is None else t.date().isoformat()
    return sorted(((r.name, r.version, r.country_tk, day(r.date_from), day(r.date_to), r.country_id, r.population, r.region)
                   for r in df.collect()), key=repr)


def test_unchanged_changed_new_and_missing(spark):
    one = first(spark, (1, "Peru", 33, "Americas"), (2, "Chile", 19, "Americas"), (None, "Fiji", 1, "Oceania"), (4, "Cuba", None, "Americas"))
    load = members(spark, (1, "Peru", 33, "Americas"), (2, "Chile", 20, "Americas"), (9, "Fiji", 1, "Oceania"), (5, "Niue", 2, None))
    two = next_versions(D.COUNTRY, one, load, "2020-01-01")
    assert rows_of(two) == sorted([
        ("Peru", 1, 3, "1900-01-01", None, 1, 33, "Americas"),
        ("Chile", 1, 1, "1900-01-01", "2020-01-01", 2, 19, "Americas"), ("Chile", 2, 6, "2020-01-01", None, 2, 20, "Americas"),
        ("Fiji", 1, 4, "1900-01-01", None, 9, 1, "Oceania"),          # a source id that comes later is no change
        ("Cuba", 1, 2, "1900-01-01", None, 4, None, "Americas"),
        ("Niue", 1, 5, "1900-01-01", None, 5, 2, None)], key=repr)
    # the same load again, and the load corrected: no further versions
    assert rows_of(next_versions(D.COUNTRY, two, load, "2020-01-01")) == rows_of(two)
    mended = members(spark, (2, "Chile", 21, "Americas"))
    assert [r[:7] for r in rows_of(next_versions(D.COUNTRY, two, mended, "2020-01-01")) if r[:2] == ("Chile", 2)] == [
        ("Chile", 2, 6, "2020-01-01", None, 2, 21)]
    # null to value is a change, also back
    three = next_versions(D.COUNTRY, two, members(spark, (4, "Cuba", 11, "Americas"), (5, "Niue", 2, None)), "2021-01-01")
    assert [(r[1], r[6]) for r in rows_of(three) if r[0] == "Cuba"] == [(1, None), (2, 11)] and three.count() == 7


def test_missing_members_close_and_come_back(spark):
    one = first(spark, (1, "Peru", 33, "Americas"), (2, "Chile", 19, "Americas"))
    gone = next_versions(D.COUNTRY, one, members(spark, (1, "Peru", 33, "Americas")), "2020-01-01", missing="close")
    assert [(r[1], r[4]) for r in rows_of(gone) if r[0] == "Chile"] == [(1, "2020-01-01")]
    back = next_versions(D.COUNTRY, gone, members(spark, (2, "Chile", 19, "Americas")), "2022-01-01")
    assert [(r[1], r[3], r[4]) for r in rows_of(back) if r[0] == "Chile"] == [(1, "1900-01-01", "2020-01-01"), (2, "2022-01-01", None)]
    assert D.current_rows(back).count() == 2
    with pytest.raises(ValueError):
        next_versions(D.COUNTRY, one, one.select(*D.COUNTRY.members), "2020-01-01", missing="drop")


def test_every_moment_has_one_version(spark):
    one = first(spark, (1, "Peru", 33, "Americas"))
    two = next_versions(D.COUNTRY, one, members(spark, (1, "Peru", 34, "Americas")), "2020-01-01")
    three = next_versions(D.COUNTRY, two, members(spark, (1, "Peru", 35, "Americas")), "2021-06-30")
    for day, population in (("1950-01-01", 33), ("2019-12-31", 33), ("2020-01-01", 34), ("2021-06-29", 34), ("2021-06-30", 35)):
        assert [r.population for r in three.where(valid_at(F.lit(day).cast("timestamp"))).collect()] == [population]


def test_in_place_and_null_keys(spark):
    one = first(spark, (1, "Peru", None, "Unknown"), (None, None, None, "Unknown")).withColumn("inferred", F.col("name").eqNullSafe("Peru"))
    two = next_versions(D.COUNTRY, one, members(spark, (1, "Peru", 33, "Americas"), (None, None, 7, "Unknown")), "2020-01-01",
                        overwrite=F.col("inferred"))
    got = {(r.name, r.version): (r.population, r.inferred) for r in two.collect()}
    # the placeholder is filled, the null name is a member like any other
    assert got == {("Peru", 1): (33, None), (None, 1): (None, False), (None, 2): (7, None)}


def test_loads_that_cannot_be_right_fail(spark):
    one = first(spark, (1, "Peru", 33, "Americas"))
    with pytest.raises(ExpectationError, match="twice"):
        next_versions(D.COUNTRY, one, members(spark, (1, "Peru", 33, "A"), (2, "Peru", 34, "A")), "2020-01-01")
    two = next_versions(D.COUNTRY, one, members(spark, (1, "Peru", 34, "Americas")), "2020-01-01")
    with pytest.raises(ExpectationError, match="older"):
        next_versions(D.COUNTRY, two, members(spark, (1, "Peru", 35, "Americas")), "2019-01-01")


def test_keys_survive(spark):
    old = spark.createDataFrame([(3, "b", 1), (7, "d", 2), (9, None, 5)], "id long, name string, v int")
    new = spark.createDataFrame([("e", 4), ("a", 3), ("b", None), (None, 6)], "name string, v int")
    got = with_stable_keys(old, new, ["name"], ["name"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(3, "b", None), (7, "d", 2), (9, None, 6), (10, "a", 3), (11, "e", 4)], key=repr)
    nothing = with_stable_keys(old.limit(0), new, ["name"], ["name"])
    assert sorted(r.id for r in nothing.collect()) == [1, 2, 3, 4]
    assert extend_keys(old, "id", ["name"]).count() == 3


def test_lookup_at_a_date(spark):
    one = first(spark, (1, "Peru", 33, "Americas"))
    dim = next_versions(D.COUNTRY, one, members(spark, (1, "Peru", 34, "Americas")), "2020-01-01")
    sales = spark.createDataFrame([("Peru", dt.datetime(2019, 12, 31), 1), ("Peru", dt.datetime(2020, 1, 1), 2), ("Peru", None, 3), ("Rome", dt.datetime(2020, 1, 1), 4)],
                                  "country_name string, sold timestamp, quantity long")
    for c in ("retailer_tk", "product_tk", "order_method_tk", "date_tk", "revenue", "gross_margin"):
        sales = sales.withColumn(c, F.lit(1))
    got = lookup_keys(sales, {"dim_country": dim}, at="sold", lookups={"dim_country": LOOKUPS["dim_country"]})
    assert {r.quantity: r.country_tk for r in got.collect()} == {1: 1, 2: 2, 3: None, 4: None}
    now = lookup_keys(sales, {"dim_country": dim}, lookups={"dim_country": LOOKUPS["dim_country"]})
    assert {r.quantity: r.country_tk for r in now.collect()} == {1: 2, 2: 2, 3: 2, 4: None}


def fact(spark, *rows):
    return spark.createDataFrame([(k, c, 1, 1, 1, 1, 1.0, 1, 1.0) for k, c in rows],
                                 "fact_sales_tk long, country_tk long, retailer_tk long, product_tk long, order_method_tk long, "
                                 "date_tk int, revenue double, quantity long, gross_margin double")


def test_refused_loads_leave_the_star(spark, tmp_path):
    store, natural = P.Store(spark, str(tmp_path)), {"dim_country": ("name",)}
    assert store.manifest() == P.Manifest()
    m = store.write(P.Manifest(), "dim_country", first(spark, (1, "Peru", 33, "Americas")))
    m = store.publish(store.write_load(m, "fact_sales", "1", fact(spark, (1, 1), (2, 1)), ["date_tk"]), [P.audit_star(store, natural)])
    assert (m.version, store.versions()) == (1, [1])
    # an orphan, a wrong count, a member twice
    bad = store.write_load(m, "fact_sales", "2", fact(spark, (3, 8)), ["date_tk"])
    twice = store.write(m, "dim_country", store.read(m, "dim_country").unionByName(store.read(m, "dim_country")))
    for candidate, audit in ((bad, P.audit_star(store, natural)), (twice, P.audit_star(store, natural)),
                             (m, P.audit_rows({"fact_sales": (">=", 3)}))):
        with pytest.raises(ExpectationError):
            store.publish(candidate, [audit])
        assert store.versions() == [1] and store.star()["fact_sales"].count() == 2
    # batches: another one, the same once more, shorter and without one of its dates
    two = store.publish(store.write_load(m, "fact_sales", "2", fact(spark, (3, 1), (4, 1)), ["date_tk"]), [P.audit_star(store, natural)])
    again = store.write_load(two, "fact_sales", "2", fact(spark, (3, 1)).withColumn("date_tk", F.lit(2)), ["date_tk"])
    assert store.star()["fact_sales"].count() == 4
    three = store.publish(again, [P.audit_rows({"fact_sales": ("==", 3)})])
    assert sorted((r.fact_sales_tk, r.date_tk) for r in store.star()["fact_sales"].collect()) == [(1, 1), (2, 1), (3, 2)]
    assert store.star(store.manifest(2))["fact_sales"].count() == 4
    # of two loads on the same version one is refused
    with pytest.raises(FileExistsError):
        store.publish(two, [])
    assert store.withdraw() == two and store.star()["fact_sales"].count() == 4
    removed = store.remove_unnamed()
    assert len(removed) == 3 and three.loads["fact_sales"]["2"] in str(removed) and store.star()["fact_sales"].count() == 4


def test_batch_loaded_twice_gives_its_rows_once(spark):
    import __spark_entry__ as E
    from conftest import SMOKE
    q = E.queries()
    attempts = [tuple(r) for r in q["publish_attempts"](spark, SMOKE).collect()]
    assert [a[2] for a in attempts] == [True, False, True, True] and attempts[2][4:] == attempts[3][4:]
    now = q["fact_reload"](spark, SMOKE)
    assert now.select("fact_sales_tk").distinct().count() == now.count() == attempts[3][4]
    # late sales of a re-typed product point to the product as it was
    product = q["scd_dim_product"](spark, SMOKE)
    typed = product.where("version = 2").select("product_name")
    old = product.where("version = 1").join(typed, "product_name").select("product_tk")
    dates = q["reload_dim_date"](spark, SMOKE).where("year < 2002").select("date_tk")
    late = now.where("quantity = 50").join(old, "product_tk").join(dates, "date_tk")
    assert late.count() > 0
    wrong = now.join(product.where("version = 2").select("product_tk"), "product_tk").join(dates, "date_tk")
    assert wrong.count() == 0
