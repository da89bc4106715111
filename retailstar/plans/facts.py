"""The sales fact from database sales and the file part.

Both branches are brought to the same names (all four names cleaned in both,
products fall back to 'Unknown Type'/'Misc Line' like the dimension), then
looked up in the current version of every dimension: product on all three
names (a name alone is not unique and would multiply rows), country, retailer
and order method on name, date on (year, quarter). ``unmatched='keep'``
keeps a sales row with a null key; ``'drop'`` removes it (inner lookups).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import char_at_as_int, parse_quarter
from ..functions.text import clean_name
from ..operators.dedup import distinct_rows
from ..operators.joins import lookup_join
from ..operators.keys import dense_number
from ..session import at_once, temporary_table
from .dimensions import MISC_LINE, PRODUCT, UNKNOWN_TYPE, current_rows
from .hierarchy import unfold

FACT_COLUMNS = ["fact_sales_tk", "country_tk", "retailer_tk", "product_tk", "order_method_tk",
                "date_tk", "revenue", "quantity", "gross_margin"]


def database_sales(tables: dict[str, DataFrame]) -> DataFrame:
    """Sales rows of the database with names instead of foreign keys."""
    return _sales(unfold(tables, "sales"), product="product", product_type="product_type",
                  product_line="product_line", country="country", retailer="retailer_type",
                  method="order_method")


def _sales(rows: DataFrame, *, product: str, product_type: str, product_line: str, country: str,
           retailer: str, method: str) -> DataFrame:
    """Both branches in one layout; the arguments name the source's columns."""
    return rows.select(*_product_names(product, product_type, product_line), *_other_columns(country, retailer, method))


def _product_names(product: str, product_type: str, product_line: str) -> list:
    return [clean_name(product).alias("product_name"),
            F.coalesce(clean_name(product_type), F.lit(UNKNOWN_TYPE)).alias("product_type_name"),
            F.coalesce(clean_name(product_line), F.lit(MISC_LINE)).alias("product_line_name")]


def _other_columns(country: str, retailer: str, method: str) -> list:
    return [clean_name(country).alias("country_name"),
            clean_name(retailer).alias("retailer_name"),
            clean_name(method).alias("order_method"),
            *_period(),
            F.col("quantity").cast("long").alias("quantity"), "revenue", "gross_margin"]


def _period() -> list:
    return [F.col("year").cast("int").alias("year"), parse_quarter("quarter").alias("quarter")]


def file_sales(file_part: DataFrame) -> DataFrame:
    """Sales rows of the file part in the same layout."""
    return _sales(file_part, product="product", product_type="product_type", product_line="product_line",
                  country="retailer_country", retailer="retailer_type", method="order_method_type")


def fact_rows(tables: dict[str, DataFrame], dims: dict[str, DataFrame],
              file_part: DataFrame | None = None, unmatched: str = "keep") -> DataFrame:
    """Fact rows without the fact key (what every report needs).

    The database's sales find their members' keys by id and their date by the quarter's
    text: names, which make wide rows, and patterns are read once per member and not
    once per sale."""
    s = _by_source_id(tables, dims, unmatched)
    if file_part is not None:
        s = s.unionByName(lookup_keys(file_sales(file_part), dims, unmatched))
    return s


def fact_rows_over_time(tables: dict[str, DataFrame], dims: dict[str, DataFrame], lookups: dict,
                        unmatched: str = "keep") -> DataFrame:
    """``fact_rows`` of the database's sales with the version of every member that was
    valid on the first day of the sale's quarter (J7), found by ``lookups``."""
    return _by_source_id(tables, dims, unmatched, lookups, at="sold")


def _by_source_id(tables: dict[str, DataFrame], dims: dict[str, DataFrame], unmatched: str,
                  lookups: dict | None = None, at: str | None = None) -> DataFrame:
    """Fact rows of the database's sales. What is looked up is written first, so the
    planner knows its size. With ``at``, the column that the first day of a sale's
    quarter gets, a member comes with all its versions, of which the sale finds its own."""
    how, sales, lookups = {"keep": "left", "drop": "inner"}[unmatched], tables["sales"], lookups or LOOKUPS

    over = ["__from", "__to"] if at else []

    def members(key: str) -> DataFrame:
        dim, parent = MEMBERS[key]
        named = unfold(tables, parent).select(F.col("id").alias("__id"), *_member_names(parent))
        found = _with_key(named, dims[dim], lookups[dim], how, all_versions=bool(at))
        return temporary_table(found.select("__id", lookups[dim][0], *over), f"{parent}-keys")[0]

    def dates() -> DataFrame:
        when = distinct_rows(tables["sales"], ["year", "quarter"]).select(
            F.col("year").alias("__y"), F.col("quarter").alias("__q"), *_period())
        day = [F.make_date("year", F.col("quarter") * 3 - 2, F.lit(1)).cast("timestamp").alias(at)] if at else []
        found = _with_key(when, dims["dim_date"], lookups["dim_date"], how).select("__y", "__q", "date_tk", *day)
        return temporary_table(found, "date-keys")[0]

    def by_id(sales: DataFrame, key: str) -> DataFrame:
        on = F.col(key) == F.col("__id")
        return lookup_join(sales, known[key], on & _valid(at) if at else on, how).drop(key, "__id", *over)

    when, *found = at_once(sales.sparkSession, [dates, *[lambda key=key: members(key) for key in MEMBERS]])
    known = dict(zip(MEMBERS, found))
    on = (F.col("year") == F.col("__y")) & (F.col("quarter") == F.col("__q"))
    sales = lookup_join(sales, when, on, how).drop("id", "year", "quarter", "__y", "__q")
    # the products last: the rows that meet them have keys in place of the other columns
    return reduce(by_id, MEMBERS, sales).select(
        *FACT_COLUMNS[1:6], F.col("revenue"), F.col("quantity").cast("long").alias("quantity"), "gross_margin")


#: dimension -> (surrogate key, {its column: the sales row's column})
LOOKUPS = {
    "dim_country": ("country_tk", {"name": "country_name"}),
    "dim_retailer": ("retailer_tk", {"name": "retailer_name"}),
    "dim_order_method": ("order_method_tk", {"name": "order_method"}),
    "dim_date": ("date_tk", {"year": "year", "quarter": "quarter"}),
    # the large one last: the rows that meet it have keys in place of the other names
    "dim_product": ("product_tk", {c: c for c in PRODUCT.business}),
}
#: sales foreign key -> (dimension, its table)
MEMBERS = {"country_fk": ("dim_country", "country"), "retailer_type_fk": ("dim_retailer", "retailer_type"),
           "order_method_fk": ("dim_order_method", "order_method"), "product_fk": ("dim_product", "product")}


def _member_names(parent: str) -> list:
    """The names that a member of a table is looked up by, under the sales row's columns."""
    if parent == "product":
        return _product_names("product", "product_type", "product_line")
    named = {"country": "country_name", "retailer_type": "retailer_name", "order_method": "order_method"}
    return [clean_name(parent).alias(named[parent])]


def lookup_keys(s: DataFrame, dims: dict[str, DataFrame], unmatched: str = "keep",
                at: str | None = None, lookups: dict | None = None) -> DataFrame:
    """Sales rows in name layout -> dimension keys and measures.

    Without ``at`` a member's current version is looked up, with it the version that
    was valid at that column's moment (J7)."""
    how = {"keep": "left", "drop": "inner"}[unmatched]
    for dim, lookup in (lookups or LOOKUPS).items():
        s = _with_key(s, dims[dim], lookup, how, at)
    return s.select(*FACT_COLUMNS[1:])


def _valid(at: str) -> Column:
    """The looked up version was valid at the moment ``at``."""
    return (F.col("__from") <= F.col(at)) & (F.col("__to").isNull() | (F.col(at) < F.col("__to")))


def _with_key(s: DataFrame, rows: DataFrame, lookup: tuple[str, dict], how: str, at: str | None = None,
              all_versions: bool = False) -> DataFrame:
    """``s`` with the key of a dimension's ``rows``; of all versions with ``__from`` and ``__to``."""
    tk, names = lookup
    versioned = "date_from" in rows.columns
    if versioned and at is None and not all_versions:
        rows = current_rows(rows)
    over = [F.col("date_from").alias("__from"), F.col("date_to").alias("__to")] if versioned and (at or all_versions) else []
    found = rows.select(tk, *[F.col(c).alias(f"__{c}") for c in names], *over)
    on = reduce(lambda a, b: a & b, [F.col(mine) == F.col(f"__{c}") for c, mine in names.items()])
    if over and at:
        on = on & _valid(at)
    kept = [tk, *(["__from", "__to"] if all_versions else [])]
    return lookup_join(s, found, on, how).drop(*[c for c in found.columns if c not in kept])


FACT_KEY_ORDER = ["product_tk", "country_tk", "retailer_tk", "date_tk", "order_method_tk",
                  "revenue", "quantity", "gross_margin"]


def number_fact(rows: DataFrame) -> DataFrame:
    """Fact rows with their key, in the order of all other columns. The four keys of
    small dimensions come in few combinations."""
    keyed = dense_number(rows, FACT_KEY_ORDER, "fact_sales_tk", together=FACT_KEY_ORDER[1:5])
    return keyed.select(*FACT_COLUMNS)


def fact_sales(tables: dict[str, DataFrame], dims: dict[str, DataFrame],
               file_part: DataFrame | None = None, unmatched: str = "keep") -> DataFrame:
    """Fact rows numbered by (product, country, retailer, date, order method
    keys, then the measures) with the distributed numbering (W2)."""
    return number_fact(fact_rows(tables, dims, file_part, unmatched))


#: sales foreign key -> (dimension, its column of source ids, its surrogate key)
SOURCE_IDS = {
    "country_fk": ("dim_country", "country_id", "country_tk"),
    "retailer_type_fk": ("dim_retailer", "retailer_id", "retailer_tk"),
    "product_fk": ("dim_product", "product_id", "product_tk"),
    "order_method_fk": ("dim_order_method", "order_method_id", "order_method_tk"),
}


def fact_by_source_id(sales: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Database sales looked up by the ids their dimensions were built from;
    the quarter is the second character of its text (X5). Rows without a match in
    the current version of every dimension are dropped."""
    rows = sales.withColumn("date_quarter", char_at_as_int("quarter", 2))
    for key, (dim, source, tk) in SOURCE_IDS.items():
        ids = current_rows(dims[dim]).select(F.col(source).alias(f"{tk}__source"), tk)
        rows = lookup_join(rows, ids, F.col(key) == F.col(f"{tk}__source"), "inner")
    dates = dims["dim_date"].select("date_tk", F.col("year").alias("d_year"), F.col("quarter").alias("d_quarter"))
    rows = lookup_join(rows, dates, (F.col("year") == F.col("d_year")) & (F.col("date_quarter") == F.col("d_quarter")),
                       "inner")
    return rows.select(F.col("id").alias("sales_id"), *FACT_COLUMNS[1:6], "revenue",
                       F.col("quantity").cast("long").alias("quantity"), "gross_margin")
