"""The analytic view and the report pack over the star schema.

Every report is one aggregation over the fact joined to the dimensions it
needs. The planner broadcasts a dimension while it is under its threshold; for a
larger one ``warehouse.colocated`` keeps it and the fact in buckets of their key. Sums are exact decimal sums
reported as double; averages are exact sum / count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum, growth_pct, margin_amount, mean, rounded_mean, rounded_sum
from ..operators.joins import lookup_join

STAR_TABLES = ["dim_retailer", "dim_product", "dim_country", "dim_order_method", "dim_date",
               "fact_sales"]


def _join(star: dict[str, DataFrame], *dims: str) -> DataFrame:
    """Fact inner-joined with the named dimensions on their surrogate keys."""
    f = star["fact_sales"]
    keys = {"dim_country": "country_tk", "dim_product": "product_tk", "dim_date": "date_tk",
            "dim_retailer": "retailer_tk", "dim_order_method": "order_method_tk"}
    for d in dims:
        k = keys[d]
        dim = star[d]
        dim = dim.select(*[F.col(c).alias(f"{d}__{c}") if c != k else F.col(c)
                           for c in dim.columns])
        f = lookup_join(f, dim, k, "inner")
    return f


def table_counts(star: dict[str, DataFrame]) -> DataFrame:
    """A1: (table_name, row_count) for every star table, in one job."""
    parts = [star[t].agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in STAR_TABLES]
    return reduce(DataFrame.unionByName, parts)


def sales_by_year(star) -> DataFrame:
    """A2: revenue, quantity and transactions per year."""
    return (_join(star, "dim_date").groupBy(F.col("dim_date__year").alias("year"))
            .agg(exact_sum("revenue").alias("total_revenue"),
                 F.sum("quantity").cast("long").alias("total_quantity"),
                 F.count(F.lit(1)).alias("transactions"))
            .orderBy("year"))


def sales_by_country(star, top: int = 10) -> DataFrame:
    """A3: top countries by revenue with the average sale."""
    return (_join(star, "dim_country")
            .groupBy(F.col("dim_country__name").alias("country"),
                     F.col("dim_country__region").alias("region"))
            .agg(exact_sum("revenue").alias("total_revenue"),
                 rounded_mean("revenue", 2).alias("avg_revenue"))
            .orderBy(F.desc("total_revenue"), "country", "region").limit(top))


def top_products(star, top: int = 10) -> DataFrame:
    """A4: best-selling products by revenue."""
    return (_join(star, "dim_product")
            .groupBy(F.col("dim_product__product_name").alias("product_name"),
                     F.col("dim_product__product_line_name").alias("product_line_name"))
            .agg(F.sum("quantity").cast("long").alias("total_quantity"),
                 exact_sum("revenue").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "product_name", "product_line_name").limit(top))


def sales_by_order_method(star) -> DataFrame:
    """A5: orders, revenue and average value per order method."""
    return (_join(star, "dim_order_method")
            .groupBy(F.col("dim_order_method__name").alias("order_method"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 exact_sum("revenue").alias("total_revenue"),
                 rounded_mean("revenue", 2).alias("avg_value"))
            .orderBy(F.desc("total_revenue"), "order_method"))


def margin_by_line(star) -> DataFrame:
    """Average margin in percent and revenue per product line."""
    return (_join(star, "dim_product")
            .groupBy(F.col("dim_product__product_line_name").alias("product_line"))
            .agg(rounded_mean("gross_margin", 2, scale=100.0).alias("avg_margin_pct"),
                 exact_sum("revenue").alias("total_revenue"))
            .orderBy(F.desc("avg_margin_pct"), "product_line"))


def bi_export(star) -> DataFrame:
    """Country x region x product line x year x quarter for BI tools."""
    return (_join(star, "dim_country", "dim_product", "dim_date")
            .groupBy(F.col("dim_country__name").alias("country"),
                     F.col("dim_country__region").alias("region"),
                     F.col("dim_product__product_line_name").alias("product_line"),
                     F.col("dim_date__year").alias("year"),
                     F.col("dim_date__quarter").alias("quarter"))
            .agg(exact_sum("revenue").alias("total_revenue"),
                 F.sum("quantity").cast("long").alias("total_quantity"),
                 (mean("gross_margin") * 100).alias("avg_margin_pct"))
            .orderBy("country", "year", "quarter", "region", "product_line"))


def sales_analytics(star) -> DataFrame:
    """The denormalised view (13 columns incl. margin_amount)."""
    f = _join(star, "dim_country", "dim_retailer", "dim_product", "dim_order_method", "dim_date")
    return f.select(
        F.col("dim_country__name").alias("country"), F.col("dim_country__region").alias("region"),
        F.col("dim_retailer__name").alias("retailer_type"),
        F.col("dim_product__product_name").alias("product_name"),
        F.col("dim_product__product_type_name").alias("product_type_name"),
        F.col("dim_product__product_line_name").alias("product_line_name"),
        F.col("dim_order_method__name").alias("order_method"),
        F.col("dim_date__year").alias("year"), F.col("dim_date__quarter").alias("quarter"),
        F.col("revenue").cast("double").alias("revenue"), F.col("quantity"),
        F.col("gross_margin").cast("double").alias("gross_margin"),
        margin_amount("revenue", "gross_margin").cast("double").alias("margin_amount"))


def view_country_year(star) -> DataFrame:
    """Revenue by country and year over the view."""
    v = _join(star, "dim_country", "dim_retailer", "dim_product", "dim_order_method", "dim_date")
    return (v.groupBy(F.col("dim_country__name").alias("country"),
                      F.col("dim_date__year").alias("year"))
            .agg(exact_sum("revenue").alias("total_revenue"))
            .orderBy("country", "year"))


def global_stats(star) -> DataFrame:
    """Four (metric, value) rows from a single pass over the fact."""
    one = star["fact_sales"].agg(
        rounded_sum("revenue", 2).alias("total_revenue"),
        F.sum("quantity").cast("double").alias("total_quantity"),
        F.count(F.lit(1)).cast("double").alias("transactions"),
        rounded_mean("revenue", 2).alias("avg_revenue"))
    return one.unpivot([], ["total_revenue", "total_quantity", "transactions", "avg_revenue"],
                       "metric", "value")


def top_countries(star, top: int = 5) -> DataFrame:
    """A10: top countries by revenue with region and quantity."""
    return (_join(star, "dim_country")
            .groupBy(F.col("dim_country__name").alias("country"),
                     F.col("dim_country__region").alias("region"))
            .agg(rounded_sum("revenue", 2).alias("total_revenue"),
                 F.sum("quantity").cast("long").alias("total_quantity"))
            .orderBy(F.desc("total_revenue"), "country", "region").limit(top))


def profitability_by_line(star) -> DataFrame:
    """Revenue and average margin per product line."""
    return (_join(star, "dim_product")
            .groupBy(F.col("dim_product__product_line_name").alias("product_line"))
            .agg(rounded_sum("revenue", 2).alias("revenue"),
                 rounded_mean("gross_margin", 4).alias("avg_margin"))
            .orderBy(F.desc("avg_margin"), "product_line"))


def trend_by_quarter(star) -> DataFrame:
    """Revenue per year and quarter, newest first."""
    return (_join(star, "dim_date")
            .groupBy(F.col("dim_date__year").alias("year"), F.col("dim_date__quarter").alias("quarter"))
            .agg(rounded_sum("revenue", 2).alias("revenue"))
            .orderBy(F.desc("year"), F.desc("quarter")))


def method_by_retailer(star, top: int = 10) -> DataFrame:
    """Transactions and sales per order method x retailer type."""
    return (_join(star, "dim_order_method", "dim_retailer")
            .groupBy(F.col("dim_order_method__name").alias("order_method"),
                     F.col("dim_retailer__name").alias("retailer"))
            .agg(F.count("fact_sales_tk").alias("transactions"),
                 rounded_sum("revenue", 2).alias("sales_value"))
            .orderBy(F.desc("sales_value"), "order_method", "retailer").limit(top))


def country_rank(star) -> DataFrame:
    """Countries ranked by revenue. The window runs on the grouped rows
    (one per country of the dimension), never on the fact."""
    g = (_join(star, "dim_country").groupBy(F.col("dim_country__name").alias("country"))
         .agg(F.sum("revenue").alias("__rev")))
    w = Window.orderBy(F.desc("__rev"))
    return g.select("country", F.col("__rev").cast("double").alias("revenue"),
                    F.rank().over(w).alias("rank"))


def yearly_growth(star) -> DataFrame:
    """Revenue per year, previous year and growth in percent (null for
    the first year and when the previous year is 0)."""
    g = (_join(star, "dim_date").groupBy(F.col("dim_date__year").alias("year"))
         .agg(exact_sum("revenue").alias("revenue")))
    prev = F.lag("revenue").over(Window.orderBy("year"))
    return (g.withColumn("prev_year", prev)
             .withColumn("growth_pct", growth_pct("revenue", "prev_year"))
             .orderBy("year"))


def star_preview(star, n: int = 5) -> DataFrame:
    """O4 preview, ordered by the fact key so it is deterministic."""
    f = _join(star, "dim_retailer", "dim_product", "dim_country", "dim_order_method", "dim_date")
    return (f.orderBy("fact_sales_tk").limit(n).select(
        F.col("fact_sales_tk"),
        F.col("dim_retailer__name").alias("retailer"),
        F.col("dim_product__product_name").alias("product_name"),
        F.col("dim_country__name").alias("country"),
        F.col("dim_order_method__name").alias("order_method"),
        F.col("dim_date__year").alias("year"), F.col("dim_date__quarter").alias("quarter"),
        F.col("revenue").cast("double").alias("revenue"), F.col("quantity"),
        F.col("gross_margin").cast("double").alias("gross_margin")))


REPORTS = {
    "table_counts": table_counts,
    "sales_by_year": sales_by_year,
    "sales_by_country": sales_by_country,
    "top_products": top_products,
    "sales_by_order_method": sales_by_order_method,
    "margin_by_line": margin_by_line,
    "bi_export": bi_export,
    "view_country_year": view_country_year,
    "global_stats": global_stats,
    "top_countries": top_countries,
    "profitability_by_line": profitability_by_line,
    "trend_by_quarter": trend_by_quarter,
    "method_by_retailer": method_by_retailer,
    "country_rank": country_rank,
    "yearly_growth": yearly_growth,
    "sales_analytics": sales_analytics,
    "star_preview": star_preview,
}
