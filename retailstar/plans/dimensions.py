"""Conformed dimensions from the database tables and the file part.

Each dimension unions the database rows with the names found in the file
part, keeps one row per business key (the database row wins, then the lowest
id), numbers the rows into a surrogate key and adds the version columns of an
initial load (version 1, valid from VALID_FROM, open end). Later loads take the
``*_members`` (rows without keys) to ``versions.next_versions``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_flag
from ..functions.parse import parse_quarter
from ..functions.text import clean_name
from ..operators.dedup import distinct_rows, survivor
from ..operators.joins import lookup_join
from ..operators.keys import add_surrogate_key
from ..session import temporary_table
from .hierarchy import unfold

# Validity interval of an initial dimension load, in the session's
# time zone. The open end is stored as null by default (VALID_TO is accepted as
# "current" as well), and the texts of a product without type.
VALID_FROM = "1900-01-01 00:00:00"
VALID_TO = "9999-12-31 00:00:00"
UNKNOWN_TYPE = "Unknown Type"
MISC_LINE = "Misc Line"
UNKNOWN_REGION = "Unknown"
NEW_RETAILER_SEED = 11   # file-only retailer types: speciality flag ~40 %


def moment(value) -> Column:
    """A timestamp literal; text is read in the session's time zone, like the data."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def scd_columns(df: DataFrame, key: str, load_ts=None, open_end=None) -> DataFrame:
    """Insert version, date_from, date_to after the surrogate key.

    ``date_from`` is VALID_FROM unless a load timestamp is passed (one value for
    the whole load: text, a datetime, or a column such as
    ``F.current_timestamp()``); ``date_to`` is null (open) unless ``open_end``
    (e.g. VALID_TO) is given."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, F.lit(1).alias("version"),
                     moment(VALID_FROM if load_ts is None else load_ts).alias("date_from"),
                     moment(open_end).alias("date_to"), *rest)


def current_rows(dim: DataFrame) -> DataFrame:
    """the current version of each row (open end or the HIGH date)."""
    return dim.filter(F.col("date_to").isNull() | (F.col("date_to") == moment(VALID_TO)))


def unique_names(reference: DataFrame) -> DataFrame:
    """The country reference with clean names, one row each (the smallest by
    population and region, so reruns agree)."""
    clean = reference.select(clean_name("name").alias("name"), F.col("population").cast("long").alias("population"),
                             F.col("region")).filter(F.col("name").isNotNull())
    return survivor(clean, ["name"], [F.col("population").isNull(), F.col("region").isNull()])


@dataclass(frozen=True)
class Dimension:
    """A dimension's surrogate key, the id its database rows come with, the business
    key, the columns told about a member, and the order of a first load's keys."""

    key: str
    source_id: str
    business: tuple[str, ...]
    told: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    @property
    def members(self) -> list[str]:
        return [self.source_id, *self.business, *self.told]

    @property
    def columns(self) -> list[str]:
        return [self.key, "version", "date_from", "date_to", *self.members]


PRODUCT = Dimension("product_tk", "product_id", ("product_name", "product_type_name", "product_line_name"),
                    order=("product_line_name", "product_type_name", "product_name"))
COUNTRY = Dimension("country_tk", "country_id", ("name",), ("population", "region"), order=("region", "name"))
RETAILER = Dimension("retailer_tk", "retailer_id", ("name",), ("speciality_store",), order=("name",))
ORDER_METHOD = Dimension("order_method_tk", "order_method_id", ("name",), order=("name",))


def conform(dim: Dimension, known: DataFrame, named: DataFrame | None) -> DataFrame:
    """One row per business key out of database rows (with ids) and the rows of
    another source (any of the other columns; what it lacks is null). The database
    row wins, then the lowest id."""
    rows = known.select(F.col("id").cast("long").alias(dim.source_id), *dim.members[1:])
    if named is not None:
        rows = rows.unionByName(distinct_rows(named), allowMissingColumns=True)
    found_id = F.col(dim.source_id)
    return survivor(rows, list(dim.business), [found_id.isNull(), F.coalesce(found_id, F.lit(0))])


def first_versions(dim: Dimension, members: DataFrame, **version) -> DataFrame:
    """A first load: keys in the dimension's order, version columns (see ``scd_columns``)."""
    keyed = add_surrogate_key(members, list(dim.order), dim.key)
    return scd_columns(keyed, dim.key, **version).select(*dim.columns)


def product_members(product: DataFrame, product_type: DataFrame, product_line: DataFrame,
                    file_part: DataFrame | None = None) -> DataFrame:
    """Products with the names above them; one without type gets the default texts."""
    levels = ("product", "product_type", "product_line")

    def named(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*more, *[clean_name(c).alias(f"{c}_name") for c in levels]).fillna(
            {"product_type_name": UNKNOWN_TYPE, "product_line_name": MISC_LINE})

    known = unfold({"product": product, "product_type": product_type, "product_line": product_line}, "product")
    return conform(PRODUCT, named(known, "id"), None if file_part is None else named(file_part))


def country_members(country: DataFrame, file_part: DataFrame | None = None,
                    reference: DataFrame | None = None) -> DataFrame:
    """Countries; population and region that are missing come from the reference,
    a name that it lacks gets region 'Unknown'."""
    known = country.select("id", clean_name("name").alias("name"), F.col("population").cast("long").alias("population"),
                           clean_name("region").alias("region"))
    one = conform(COUNTRY, known, None if file_part is None else file_part.select(
        clean_name("retailer_country").alias("name")))
    facts = {c: [F.col(c)] for c in COUNTRY.told}
    if reference is not None:
        ref = unique_names(reference).select(*[F.col(c).alias(f"ref_{c}") for c in ("name", *COUNTRY.told)])
        one = lookup_join(one, ref, F.col("name") == F.col("ref_name"), "left")
        facts = {c: [*have, F.col(f"ref_{c}")] for c, have in facts.items()}
    facts["region"].append(F.lit(UNKNOWN_REGION))
    return one.select(COUNTRY.source_id, "name", *[F.coalesce(*have).alias(c) for c, have in facts.items()])


def retailer_members(retailer_type: DataFrame, file_part: DataFrame | None = None) -> DataFrame:
    """Retailer types; one that only the file has gets a seeded speciality flag."""
    known = retailer_type.select("id", clean_name("name").alias("name"),
                                 F.col("speciality_store").cast("int").alias("speciality_store"))
    named = None
    if file_part is not None:
        named = file_part.select(clean_name("retailer_type").alias("name")).withColumn(
            "speciality_store", hash_flag("name", seed=NEW_RETAILER_SEED).cast("int"))
    return conform(RETAILER, known, named)


def method_members(order_method: DataFrame, file_part: DataFrame | None = None) -> DataFrame:
    """Order methods."""
    return conform(ORDER_METHOD, order_method.select("id", clean_name("name").alias("name")),
                   None if file_part is None else file_part.select(clean_name("order_method_type").alias("name")))


def dim_product(product: DataFrame, product_type: DataFrame, product_line: DataFrame,
                file_part: DataFrame | None = None, **version) -> DataFrame:
    """N2, key order line, type, name."""
    return first_versions(PRODUCT, product_members(product, product_type, product_line, file_part), **version)


def dim_country(country: DataFrame, file_part: DataFrame | None = None,
                reference: DataFrame | None = None, **version) -> DataFrame:
    """N3, key order region, name."""
    return first_versions(COUNTRY, country_members(country, file_part, reference), **version)


def dim_retailer(retailer_type: DataFrame, file_part: DataFrame | None = None, **version) -> DataFrame:
    """N4, key order name."""
    return first_versions(RETAILER, retailer_members(retailer_type, file_part), **version)


def dim_order_method(order_method: DataFrame, file_part: DataFrame | None = None, **version) -> DataFrame:
    """N5, key order name."""
    return first_versions(ORDER_METHOD, method_members(order_method, file_part), **version)


def _periods(df: DataFrame) -> DataFrame:
    """The periods of the different (year, quarter) texts. These are written, else the
    planner would parse the text of every row."""
    texts, _ = temporary_table(distinct_rows(df, ["year", "quarter"]), "periods")
    p = texts.select(F.col("year").cast("int").alias("year"),
                  parse_quarter("quarter").alias("quarter"))
    return p.filter(F.col("year").isNotNull() & F.col("quarter").isNotNull())


def periods(sales: DataFrame, file_part: DataFrame | None = None) -> DataFrame:
    """The different (year, quarter) of both sources."""
    rows = _periods(sales)
    if file_part is not None:
        rows = rows.unionByName(_periods(file_part))
    return distinct_rows(rows)


def dim_date(sales: DataFrame, file_part: DataFrame | None = None) -> DataFrame:
    """N6 (date_tk, year, quarter): distinct parsed periods, key order year,
    quarter; rows whose quarter does not parse are left out."""
    return add_surrogate_key(periods(sales, file_part), ["year", "quarter"], "date_tk", out_type="int")
