"""The flat file -> seven relational tables (the source "database").

Entities get ids numbered in name order; sales rows point to them through
joins with deduplicated (name, id) maps. Products are mapped by (product,
product type), since a product name alone is not unique.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from ..functions.text import clean_name
from ..operators.dedup import distinct_rows, survivor
from ..operators.joins import lookup_join
from ..operators.keys import add_surrogate_key, dense_number, map_ids, numbered_with_total, placed
from ..session import at_once, temporary_table
from .dimensions import unique_names
from .hierarchy import unfold

SPECIALITY_STORES = 3   # retailer types flagged as speciality stores
SPECIALITY_SEED = 7


def country_table(flat: DataFrame, reference: DataFrame) -> DataFrame:
    """country(id, name, population, region); names missing from the reference
    get population 0 and region 'Unknown'."""
    names = distinct_rows(flat.select(F.col("retailer_country").alias("name")))
    ref = unique_names(reference).select(F.col("name").alias("__ref_name"), "population", "region")
    enriched = lookup_join(names, ref, clean_name("name") == F.col("__ref_name"), "left")
    enriched = enriched.select(
        "name",
        F.coalesce(F.col("population"), F.lit(0)).cast("long").alias("population"),
        F.coalesce(F.col("region"), F.lit("Unknown")).alias("region"))
    return add_surrogate_key(enriched, ["name"], "id")


def name_table(flat: DataFrame, column: str) -> DataFrame:
    """(id, name) for a plain entity column (order method, product line)."""
    names = distinct_rows(flat.select(F.col(column).alias("name")))
    return add_surrogate_key(names, ["name"], "id")


def retailer_type_table(flat: DataFrame, k: int = SPECIALITY_STORES,
                        seed: int = SPECIALITY_SEED) -> DataFrame:
    """retailer_type(id, name, speciality_store): exactly ``k`` types flagged,
    chosen by a seeded hash (a bounded top-k, not a sort of all rows)."""
    base = name_table(flat, "retailer_type")
    chosen = (base.select("name", row_hash("name", seed=seed).alias("__h"))
              .orderBy("__h", "name").limit(k).select("name", F.lit(1).alias("__flag")))
    out = base.join(F.broadcast(chosen), "name", "left")   # k rows
    return out.select("id", "name",
                      F.coalesce(F.col("__flag"), F.lit(0)).cast("int").alias("speciality_store"))


def product_type_table(flat: DataFrame, product_line: DataFrame) -> DataFrame:
    """product_type(id, name, product_line_fk): one row per type name."""
    pairs = distinct_rows(flat.select(F.col("product_type").alias("name"),
                                      F.col("product_line").alias("line")))
    one = survivor(pairs, ["name"], [F.col("line")])
    mapped = map_ids(one, product_line, ["line"], ["name"], "id", "product_line_fk")
    return add_surrogate_key(mapped.select("name", "product_line_fk"), ["name"], "id")


def product_table(flat: DataFrame, product_type: DataFrame) -> DataFrame:
    """product(id, name, product_type_fk): one row per (product, type)."""
    pairs = distinct_rows(flat.select(F.col("product").alias("name"),
                                      F.col("product_type").alias("type_name")))
    mapped = map_ids(pairs, product_type, ["type_name"], ["name"], "id", "product_type_fk")
    return add_surrogate_key(mapped, ["name", "type_name"], "id").select(
        "id", "name", "product_type_fk")


BUYER = ["retailer_country", "order_method_type", "retailer_type"]
PRODUCT = ["product_line", "product_type", "product"]
PERIOD = ["year", "quarter"]


def type_conflicts(flat: DataFrame) -> DataFrame:
    """(product_type, lines): types found under more than one product line. The
    type table keeps the alphabetically first line; these are the rows to look at."""
    return (flat.groupBy("product_type").agg(F.count_distinct("product_line").cast("long").alias("lines"))
            .filter(F.col("lines") > 1))


def different_names(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different ``BUYER`` and ``PRODUCT`` names, each written once: two distincts
    that shrink the sales map-side, where one over all six names would hardly."""
    buyers, products = at_once(flat.sparkSession, [
        lambda: temporary_table(distinct_rows(flat, BUYER), "buyers")[0],
        lambda: temporary_table(distinct_rows(flat, PRODUCT), "products")[0]])
    return buyers, products


def normalize_entities(flat: DataFrame, reference: DataFrame, write=None,
                       names: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The six entity tables, taken from the different names (``different_names``).

    ``write(df, name)`` stores a table and returns it read back, so the next one
    joins a written table; without it they are handed on as they are. Tables that do
    not refer to each other are made side by side.
    """
    write = write or (lambda df, name: df)
    buyers, products = names or different_names(flat)

    def product_tables() -> dict[str, DataFrame]:
        out = {"product_line": write(name_table(products, "product_line"), "product_line")}
        out["product_type"] = write(product_type_table(products, out["product_line"]), "product_type")
        return out | {"product": write(product_table(products, out["product_type"]), "product")}

    found = at_once(flat.sparkSession, [
        product_tables,
        lambda: {"country": write(country_table(buyers, reference), "country")},
        lambda: {"order_method": write(name_table(buyers, "order_method_type"), "order_method")},
        lambda: {"retailer_type": write(retailer_type_table(buyers), "retailer_type")}])
    return reduce(lambda a, b: a | b, found)


def normalize_sales(flat: DataFrame, entities: dict[str, DataFrame],
                    names: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """sales(id, year, quarter, revenue, quantity, gross_margin, country_fk,
    order_method_fk, product_fk, retailer_type_fk); ids follow the order of
    all flat columns.

    The different names are put in order and mapped to ids first; the sales then
    carry two places in that order instead of six texts, so what is joined, sorted
    and written on the way to their ids is narrow. Where they meet the products and
    where they are sorted, a place stands for their year and quarter too."""
    known, different = names or different_names(flat)

    def placed_buyers() -> DataFrame:
        buyers = known
        for column, table, out in zip(BUYER, ("country", "order_method", "retailer_type"),
                                      ("country_fk", "order_method_fk", "retailer_type_fk")):
            buyers = map_ids(buyers, entities[table], [column], ["name"], "id", out)
        return temporary_table(dense_number(buyers, BUYER, "buyer"), "buyers-placed")[0]

    def placed_products() -> tuple[DataFrame, DataFrame]:
        types, _ = temporary_table(dense_number(distinct_rows(different, PRODUCT[:2]), PRODUCT[:2], "type_place"), "types-placed")
        # product map keyed by (product name, product type name)
        prod = unfold(entities, "product").select("id", "product", "product_type")
        products = placed(map_ids(different, prod, ["product", "product_type"], ["product", "product_type"], "id", "product_fk"),
                          types, PRODUCT[:2])
        return types, temporary_table(dense_number(products, ["type_place", "product"], "product_place"), "products-placed")[0]

    def placed_periods() -> tuple[DataFrame, int]:
        ordered, n = numbered_with_total(distinct_rows(flat, PERIOD), PERIOD, "period")
        return temporary_table(ordered, "sales-periods")[0], n

    (types, products), buyers, (periods, n) = at_once(flat.sparkSession, [placed_products, placed_buyers, placed_periods])

    rest = [c for c in flat.columns if c not in BUYER + PRODUCT]
    s = placed(placed(flat, buyers.select(*BUYER, "buyer"), BUYER), types, PRODUCT[:2])
    s = placed(placed(s, periods, PERIOD), products, ["type_place", "product"])
    s = placed(s, periods, ["period"]).select("buyer", "product_place", *rest, "product_fk")
    numbered = dense_number(s, ["buyer", "product_place", *rest], "id", together=PERIOD, places=(periods, n))
    return placed(numbered, buyers.drop(*BUYER), ["buyer"]).select(
        "id", "year", "quarter", "revenue", "quantity", "gross_margin",
        "country_fk", "order_method_fk", "product_fk", "retailer_type_fk")


def denormalize(tables: dict[str, DataFrame]) -> DataFrame:
    """The seven tables joined back to the flat layout (inner joins), with
    the sales id kept for ordering."""
    rows = unfold(tables, "sales", "inner")
    return rows.select(F.col("id").alias("sales_id"), F.col("country").alias("retailer_country"),
                       F.col("order_method").alias("order_method_type"), "retailer_type", "product_line",
                       "product_type", "product", "year", "quarter", "revenue", "quantity", "gross_margin")
