"""The retail data set, derived from the driver's TPC-H-like tables.

The toolkit works on a flat sales file (11 columns). The test tables carry no
retail data, so the flat file is defined over them: one sales line per
lineitem, with the order's priority as order method, the customer's segment
and nation as retailer type and country, and the part's type/brand/name as the
product hierarchy. Measures are decimals so totals are exact in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_name

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Cleaned column names of the flat sales file, in file order.
FLAT_COLUMNS = ["retailer_country", "order_method_type", "retailer_type", "product_line",
                "product_type", "product", "year", "quarter", "revenue", "quantity",
                "gross_margin"]

# Raw headers of the flat file (before the header rule lower-case + '_').
RAW_HEADERS = ["Retailer country", "Order method type", "Retailer type", "Product line",
               "Product type", "Product", "Year", "Quarter", "Revenue", "Quantity",
               "Gross margin"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """S4 on Parquet: name -> lazy DataFrame of every table of the folder."""
    return {n: table(spark, sf_dir, n) for n in (names or TABLES)}


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat sales rows in cleaned column names (the input of every job).

    Order-level attributes are joined first (orders is a quarter of lineitem),
    so lineitem is shuffled once on the order key and once on the part key
    (unless part is small enough to broadcast). lineitem and orders grow
    together, so their join is a shuffle (merge) join at every size; the
    planner's size check decides for customer, nation and part. The nation's name
    comes last, the shuffles carry its key.
    """
    t = lambda n: table(spark, sf_dir, n)
    # sales know the quarter only; its first day repeats where days hardly do
    quarter = F.trunc("o_orderdate", "quarter").alias("o_quarter")
    orders = (t("orders").select("o_orderkey", "o_custkey", quarter, "o_orderpriority")
              .join(t("customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
                    F.col("o_custkey") == F.col("c_custkey")))
    nations = t("nation").select("n_nationkey", "n_name")
    disc = F.col("l_discount").cast("decimal(4,2)")
    # the measures are made before the shuffles: decimals of few digits in place of doubles
    lines = t("lineitem").select(
        "l_orderkey", "l_partkey",
        (F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - disc)).cast("decimal(18,4)").alias("revenue"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.lit(0.5).cast("decimal(4,2)") - F.col("l_tax").cast("decimal(4,2)") - disc)
        .cast("decimal(6,4)").alias("gross_margin"))
    parts = t("part").select("p_partkey", "p_name", "p_brand", "p_type")
    year = F.year("o_quarter")
    return (lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("n_name").alias("retailer_country"),
                F.col("o_orderpriority").alias("order_method_type"),
                F.col("c_mktsegment").alias("retailer_type"),
                F.col("p_type").alias("product_line"),
                F.concat_ws(" ", "p_type", "p_brand").alias("product_type"),
                F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))
                 .alias("product"),
                year.cast("int").alias("year"),
                F.concat(F.lit("Q"), F.quarter("o_quarter").cast("string"), F.lit(" "),
                         year.cast("string")).alias("quarter"),
                "revenue", "quantity", "gross_margin"))


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat file as delivered: raw headers (``Retailer country`` ...)."""
    return sales_lines(spark, sf_dir).toDF(*RAW_HEADERS)


def country_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference table (name, population, region) that replaces the per-row web
    lookup: population = customers of the nation, region = the nation's region.
    Names and regions are in display form (``initcap``)."""
    t = lambda n: table(spark, sf_dir, n)
    pop = t("customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("population"))
    return (t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .join(pop, F.col("n_nationkey") == F.col("c_nationkey"), "left")
            .select(clean_name("n_name").alias("name"),
                    F.coalesce(F.col("population"), F.lit(0)).cast("long").alias("population"),
                    clean_name("r_name").alias("region")))


def dirty_sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat file with faults put in by rule, so that cleaning has work to do:
    two countries by their short names, no margin where the quantity is 13."""
    short = F.when(F.col("Retailer country") == "NATION_1", "USA").when(F.col("Retailer country") == "NATION_2", "UK")
    return (sales_raw(spark, sf_dir)
            .withColumn("Retailer country", F.coalesce(short, F.col("Retailer country")))
            .withColumn("Gross margin", F.when(F.col("Quantity") != 13, F.col("Gross margin"))))


def dirty_file_part(df: DataFrame) -> DataFrame:
    """Faults of the file part only: a country and a retailer type that no other
    source has, padded; no product type and line where the quantity is 7; products
    whose name looks missing, or has a line break, a comma and quotes."""
    typed = F.col("quantity") != 7
    name = F.when(F.col("quantity") == 9, "None").when(F.col("quantity") == 11, F.concat("product", F.lit('\n"large", wide')))
    return df.select(
        F.when(F.col("retailer_country") == "NATION_3", "  atlantis ").otherwise(F.col("retailer_country")).alias("retailer_country"),
        "order_method_type",
        F.when(F.col("retailer_type") == "MACHINERY", "kiosk").otherwise(F.col("retailer_type")).alias("retailer_type"),
        F.when(typed, F.col("product_line")).alias("product_line"),
        F.when(typed, F.col("product_type")).alias("product_type"),
        F.coalesce(name, F.col("product")).alias("product"), *df.columns[6:])


def faulty_cells(df: DataFrame) -> DataFrame:
    """The file part as text with cells that no conversion can read, by rule: revenue,
    year or quantity in words, and a missing margin with a missing product."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    n = F.col("quantity")
    return text.withColumns({
        "revenue": F.when(n == "12", "n.v.").otherwise(F.col("revenue")),
        "year": F.when(n == "22", "MMII").otherwise(F.col("year")),
        "gross_margin": F.when(n == "42", "NA").otherwise(F.col("gross_margin")),
        "product": F.when(n == "42", "").otherwise(F.col("product")),
        "quantity": F.when(n == "32", "many").otherwise(n)})


def second_batch(flat: DataFrame) -> DataFrame:
    """A later delivery, made of the cleaned sales by rule: the lines of 40 pieces and
    more, seven years on; those of 50 pieces are late sales of their own year. Every
    tenth part is re-typed, some are followed by a new part, and a country is new."""
    part = F.regexp_extract("product", "#([0-9]+)$", 1).cast("int")
    year = F.when(F.col("quantity") == 50, F.col("year")).otherwise(F.col("year") + 7)
    return flat.where("quantity >= 40").select(
        F.when(F.col("retailer_country") == "NATION_6", "NOVA").otherwise(F.col("retailer_country")).alias("retailer_country"),
        "order_method_type", "retailer_type", "product_line",
        F.when(part % 10 == 3, F.concat("product_line", F.lit(" Brand#00"))).otherwise(F.col("product_type")).alias("product_type"),
        F.when(part % 25 == 4, F.concat("product", F.lit(" II"))).otherwise(F.col("product")).alias("product"),
        year.alias("year"), F.concat(F.substring("quarter", 1, 3), year.cast("string")).alias("quarter"),
        "revenue", "quantity", "gross_margin")


def second_reference(reference: DataFrame) -> DataFrame:
    """The country reference as it is at the later delivery."""
    return reference.select(
        "name", F.when(F.col("name").endswith("5"), F.col("population") + 1000).otherwise(F.col("population")).alias("population"),
        F.when(F.col("name").endswith("7"), "Oceania").otherwise(F.col("region")).alias("region"))


def dirty_entity(name: str, df: DataFrame) -> DataFrame:
    """Faults of the entity tables: a country without population and region, and
    every tenth product without type."""
    if name == "country":
        known = F.col("name") != "NATION_4"
        return df.select("id", "name", F.when(known, F.col("population")).alias("population"),
                         F.when(known, F.col("region")).alias("region"))
    if name == "product":
        return df.withColumn("product_type_fk", F.when(F.col("id") % 10 != 0, F.col("product_type_fk")))
    return df
