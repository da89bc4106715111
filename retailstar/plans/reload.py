"""A second load and any later one (N1, N8, N9 over time; W1, J7, J12, K3, P7).

A batch of cleaned sales arrives. The entity tables keep the ids of what they
know (their former version is the registry) and number what is new after the
largest; the sales go behind the former sales. The dimensions get versions at the
load's moment, the calendar new quarters. The batch's fact rows look up the
version that was valid when the sale was made, so a late sale of a re-typed
product points to the product as it was. Everything is written beside what is
published and becomes current together, after the audit. A batch that is loaded
again takes its own place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_name
from ..operators.dedup import distinct_rows, survivor
from ..operators.joins import lookup_join
from ..operators.keys import map_ids, with_stable_keys
from ..session import at_once, release_temporary
from . import dimensions as D
from .facts import FACT_COLUMNS, LOOKUPS, fact_rows_over_time, number_fact
from .normalize import BUYER, different_names, normalize_sales
from .publish import Manifest, Store, audit_rows, audit_star
from .versions import next_versions
from .warehouse import DB_TABLES, Warehouse

#: what a member is known by over time; a product keeps its name when its type changes
NATURAL_KEYS = {"dim_product": ("product_name",), "dim_country": ("name",), "dim_retailer": ("name",),
                "dim_order_method": ("name",), "dim_date": ("year", "quarter")}
SPECS = {"dim_product": D.PRODUCT, "dim_country": D.COUNTRY, "dim_retailer": D.RETAILER, "dim_order_method": D.ORDER_METHOD}
LOOKUPS_OVER_TIME = LOOKUPS | {"dim_product": ("product_tk", {"product_name": "product_name"})}


def first_load(store: Store, wh: Warehouse, batch: str = "1") -> Manifest:
    """The loaded warehouse as the store's first batch, audited and published."""
    db, star = wh.database(), wh.star()
    none = Manifest()
    tables = {name: db[name] for name in DB_TABLES[:-1]} | {name: star[name] for name in NATURAL_KEYS}
    # the warehouse's files hold one date each, so a task has few dates without a shuffle
    parts = at_once(store.spark, [
        lambda: store.write_load(none, "fact_sales", batch, star["fact_sales"], ["date_tk"]),
        lambda: store.write_load(none, "sales", batch, db["sales"]),
        *[lambda name=name, df=df: store.write(none, name, df) for name, df in tables.items()]])
    m = _joined(none, parts)
    return store.publish(m, [audit_star(store, NATURAL_KEYS)])


def _entities(store: Store, m: Manifest, different: tuple[DataFrame, DataFrame], reference: DataFrame) -> Manifest:
    """The six entity tables after the batch with these names: known ids stay."""
    buyers, names = different

    def names_of(column: str) -> DataFrame:
        return distinct_rows((buyers if column in BUYER else names).select(F.col(column).alias("name")))

    def put(m: Manifest, table: str, incoming: DataFrame) -> Manifest:
        return store.write(m, table, with_stable_keys(store.read(m, table), incoming, ["name"], ["name"]))

    def country() -> Manifest:
        ref = D.unique_names(reference).select(F.col("name").alias("ref_name"), "population", "region")
        countries = lookup_join(names_of("retailer_country"), ref, clean_name("name") == F.col("ref_name"), "left")
        return put(m, "country", countries.select("name", F.coalesce("population", F.lit(0)).alias("population"),
                                                  F.coalesce("region", F.lit(D.UNKNOWN_REGION)).alias("region")))

    def retailer_type() -> Manifest:
        # a known type keeps its flag, a new one is not a speciality store
        flags = store.read(m, "retailer_type").select(F.col("name").alias("had"), "speciality_store")
        types = lookup_join(names_of("retailer_type"), flags, F.col("name") == F.col("had"), "left")
        return put(m, "retailer_type", types.select("name", F.coalesce("speciality_store", F.lit(0)).cast("int").alias("speciality_store")))

    def product_tables() -> Manifest:
        out = put(m, "product_line", names_of("product_line"))
        lines = survivor(distinct_rows(names.select(F.col("product_type").alias("name"), "product_line")), ["name"], [F.col("product_line")])
        out = put(out, "product_type", map_ids(lines, store.read(out, "product_line"), ["product_line"], ["name"], "id",
                                               "product_line_fk").select("name", "product_line_fk"))
        typed = survivor(distinct_rows(names.select(F.col("product").alias("name"), "product_type")), ["name"], [F.col("product_type")])
        return put(out, "product", map_ids(typed, store.read(out, "product_type"), ["product_type"], ["name"], "id",
                                           "product_type_fk").select("name", "product_type_fk"))

    return _joined(m, at_once(store.spark, [product_tables, country, retailer_type,
                                            lambda: put(m, "order_method", names_of("order_method_type"))]))


def _joined(m: Manifest, parts: list[Manifest]) -> Manifest:
    """``m`` with what each of the candidates made of it has written anew."""
    return reduce(lambda a, b: a.with_new(m, b), parts, m)


def _after(df: DataFrame, key: str, former: DataFrame | None) -> DataFrame:
    """Keys 1, 2, ... moved behind the largest of the former rows."""
    last = 0 if former is None else former.agg(F.max(key)).first()[0] or 0
    return df.withColumn(key, F.col(key) + F.lit(last)) if last else df


def _batch(store: Store, m: Manifest, batch: str) -> DataFrame:
    return store.spark.read.parquet(f"{store.root}/sales/load={m.loads['sales'][batch]}")


def load_batch(store: Store, flat: DataFrame, reference: DataFrame, batch: str, load_ts: str) -> Manifest:
    """Load cleaned sales as ``batch``; the candidate to publish."""
    m = store.manifest()
    different = different_names(flat)
    m = _entities(store, m, different, reference)
    entities = {t: store.read(m, t) for t in DB_TABLES[:-1]}
    former = store.read_loads(m, "sales", without=batch)

    def sales_and_dates() -> Manifest:
        out = store.write_load(m, "sales", batch, _after(normalize_sales(flat, entities, different), "id", former))
        return store.write(out, "dim_date", with_stable_keys(store.read(out, "dim_date"), D.periods(_batch(store, out, batch)),
                                                             ["year", "quarter"], ["year", "quarter"], "date_tk"))

    members = {"dim_product": D.product_members(entities["product"], entities["product_type"], entities["product_line"]),
               "dim_country": D.country_members(entities["country"], None, reference),
               "dim_retailer": D.retailer_members(entities["retailer_type"]),
               "dim_order_method": D.method_members(entities["order_method"])}

    def versions(name: str) -> Manifest:
        return store.write(m, name, next_versions(SPECS[name], store.read(m, name), members[name], load_ts, key=NATURAL_KEYS[name]))

    m = _joined(m, at_once(store.spark, [sales_and_dates, *[lambda name=name: versions(name) for name in SPECS]]))
    sales = _batch(store, m, batch)
    dims = {t: store.read(m, t) for t in NATURAL_KEYS}
    # a sale is dated by the first day of its quarter
    found = fact_rows_over_time(entities | {"sales": sales}, dims, LOOKUPS_OVER_TIME)
    fact = _after(number_fact(found), "fact_sales_tk", store.read_loads(m, "fact_sales", without=batch)).select(*FACT_COLUMNS)
    m = store.write_load(m, "fact_sales", batch, fact.hint("rebalance", "date_tk"), ["date_tk"])
    release_temporary(store.spark)
    return m


def publish_load(store: Store, candidate: Manifest, expect: dict[str, tuple[str, int]] | None = None) -> Manifest:
    """Audit a candidate and make it current; an ExpectationError leaves the old star."""
    return store.publish(candidate, [audit_rows(expect or {}), audit_star(store, NATURAL_KEYS)])


def kept_keys(before: dict[str, DataFrame], after: dict[str, DataFrame], keys: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """(table_name, keys_before, keys_kept, keys_new): per table, how many keys still
    stand for the same business key after a load, and how many are new.
    ``keys``: table -> (key column, business columns)."""
    parts = []
    for name, (key, by) in keys.items():
        old = before[name].select(F.col(key).alias("k"), F.to_json(F.struct(*by)).alias("b"), F.lit(1).alias("o"), F.lit(0).alias("n"))
        new = after[name].select(F.col(key).alias("k"), F.to_json(F.struct(*by)).alias("b"), F.lit(0).alias("o"), F.lit(1).alias("n"))
        per = old.unionByName(new).groupBy("k", "b").agg(F.max("o").alias("o"), F.max("n").alias("n"))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
        parts.append(per.agg(total("o").alias("keys_before"), total(F.col("o") * F.col("n")).alias("keys_kept"),
                             total((1 - F.col("o")) * F.col("n")).alias("keys_new")).select(
            F.lit(name).alias("table_name"), "keys_before", "keys_kept", "keys_new"))
    return reduce(DataFrame.unionByName, parts)
