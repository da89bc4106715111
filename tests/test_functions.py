from pyspark.sql import functions as F

from retailstar.functions.hashing import hash_flag, row_hash
from retailstar.functions.numeric import growth_pct
from retailstar.functions.parse import char_at_as_int, first_number, parse_quarter
from retailstar.functions.text import clean_name, normalise_headers, replace_values


def test_clean_name_trims_and_initcaps(spark):
    df = spark.createDataFrame([("  united STATES ",), ("TENT-x",), (None,)], "s string")
    out = [r[0] for r in df.select(clean_name("s")).collect()]
    assert out == ["United States", "Tent-x", None]


def test_parse_quarter_forms(spark):
    df = spark.createDataFrame([("Q1",), (" Q3 2012 ",), ("Q5",), ("",), (None,)], "q string")
    assert [r[0] for r in df.select(parse_quarter("q")).collect()] == [1, 3, None, None, None]


def test_other_quarter_parsers(spark):
    df = spark.createDataFrame([("Q2 2013",), ("x",)], "q string")
    got = df.select(first_number("q"), char_at_as_int("q", 2)).collect()
    assert [tuple(r) for r in got] == [(2, 2), (None, None)]


def test_headers_and_aliases(spark):
    df = spark.createDataFrame([("USA", 1), ("UK", 2), ("USA Today", 3)],
                               "`Retailer country` string, `Year` int")
    df = normalise_headers(replace_values(df, "Retailer country",
                                          {"USA": "United States", "UK": "United Kingdom"}))
    assert df.columns == ["retailer_country", "year"]
    assert [r[0] for r in df.collect()] == ["United States", "United Kingdom", "USA Today"]


def test_growth_null_on_zero_and_first(spark):
    df = spark.createDataFrame([(10.0, None), (10.0, 0.0), (15.0, 10.0)], "c double, p double")
    assert [r[0] for r in df.select(growth_pct("c", "p")).collect()] == [None, None, 50.0]


def test_hash_is_md5_of_joined_text(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n int")
    h = df.select(row_hash("s", "n", seed=3)).first()[0]
    import hashlib
    assert h == hashlib.md5(b"3|a|1").hexdigest()
    assert df.select(hash_flag("s", seed=3)).first()[0] in (0, 1)
