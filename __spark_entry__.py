"""

Every query reads the driver's tables under ``sf_dir``. Queries on the
warehouse (normalised tables, dimensions, fact, reports, checks) share one
build per application and ``sf_dir``: the ETL runs once, writing each stage to
the shared checkpoint folder, and the queries read the loaded tables - the way
the reports of a warehouse read what the load wrote.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

# the package lives next to this file; make it importable from any cwd
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailstar.operators import profile, quality
from retailstar.functions.parse import first_number, parse_quarter
from retailstar.operators.dedup import distinct_rows, duplicate_count
from retailstar.plans import reload
from retailstar.plans.facts import database_sales, fact_by_source_id, file_sales, lookup_keys, number_fact
from retailstar.plans.hierarchy import FOREIGN_KEYS, comma_join_sql
from retailstar.plans.inferred import inferred_rows, with_inferred
from retailstar.plans.normalize import denormalize, type_conflicts
from retailstar.plans.preprocess import clean_flat
from retailstar.plans.publish import Store
from retailstar.plans.reports import REPORTS
from retailstar.plans.warehouse import CSV_ROWS, DB_TABLES, DIM_TABLES, REQUIRED_COLUMNS, build_dimensions, colocated, warehouse_for
from retailstar.session import at_once, scratch_path, sized_for, stored_table
from retailstar.sinks.writers import create_view, insert_into, write_csv
from retailstar.sources.catalog import list_tables, merge_sources, register_views, run_sql, small_table
from retailstar.sources.files import checked_cells, read_cells, read_csv_inferred, rejected_rows, write_checked
from retailstar.sources.testdata import (country_reference, dirty_entity, dirty_file_part, dirty_sales_raw,
                                         faulty_cells, load_tables, sales_raw, second_batch, second_reference)
from retailstar.sql_oracle import oracle_sql as _oracle_sql

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top 5 countries by revenue (report A10) on sf0.001."""
    return REPORTS["top_countries"](warehouse_for(spark, SMOKE_DIR).star())


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_flat(sales_raw(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned rows as the build has written them."""
    return warehouse_for(spark, sf_dir).processed().drop("part")


def _profile_sketch(spark, sf_dir) -> DataFrame:
    """Sketches per country, merged, next to the exact counts: is every estimate
    within the sketch's error?"""
    rows = _cleaned(spark, sf_dir)
    parts = profile.distinct_sketches(rows.withColumn("part", F.col("retailer_country")), ["part"])
    found = profile.distinct_estimates(profile.merged_sketches(parts.drop("part"))).withColumnRenamed("column", "c")
    exact = profile.distinct_counts(rows)
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= profile.sketch_error() * F.col("distinct_count")
    return exact.join(found, F.col("column") == F.col("c")).select("column", "distinct_count", near.alias("within_error"))


_COLOCATED: dict[tuple, dict[str, DataFrame]] = {}


def _top_products_colocated(spark, sf_dir) -> DataFrame:
    """A4 on a fact and a product dimension that are bucketed by the product key."""
    wh = warehouse_for(spark, sf_dir)
    if (key := (spark.sparkContext.applicationId, wh.root)) not in _COLOCATED:
        _COLOCATED[key] = colocated(spark, wh.star(), "dim_product", "product_tk")
    return REPORTS["top_products"](_COLOCATED[key])


def _star(spark, sf_dir):
    return warehouse_for(spark, sf_dir).star()


def _db(spark, sf_dir):
    return warehouse_for(spark, sf_dir).database()


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _key_uniqueness(spark, sf_dir) -> DataFrame:
    star, db = _star(spark, sf_dir), _db(spark, sf_dir)
    checks = [
        ("dim_product", star["dim_product"], ["product_tk"]),
        ("dim_product", star["dim_product"], ["product_name", "product_type_name", "product_line_name"]),
        ("dim_country", star["dim_country"], ["country_tk"]),
        ("dim_country", star["dim_country"], ["name"]),
        ("dim_retailer", star["dim_retailer"], ["retailer_tk"]),
        ("dim_retailer", star["dim_retailer"], ["name"]),
        ("dim_order_method", star["dim_order_method"], ["order_method_tk"]),
        ("dim_order_method", star["dim_order_method"], ["name"]),
        ("dim_date", star["dim_date"], ["date_tk"]),
        ("dim_date", star["dim_date"], ["year", "quarter"]),
        ("fact_sales", star["fact_sales"], ["fact_sales_tk"]),
        ("country", db["country"], ["name"]),
        ("product_type", db["product_type"], ["name"]),
        ("sales", db["sales"], ["id"]),
    ]
    return _union([quality.duplicate_keys(df, key).select(
        F.lit(t).alias("table_name"), F.lit(",".join(key)).alias("key_columns"), "duplicate_keys")
        for t, df, key in checks])


def _fk_orphans(spark, sf_dir) -> DataFrame:
    star, db = _star(spark, sf_dir), _db(spark, sf_dir)
    fact_keys = {f"{d}_tk": (star[f"dim_{d}"], f"{d}_tk")
                 for d in ("country", "retailer", "product", "order_method", "date")}
    checks = {"fact_sales": (star["fact_sales"], fact_keys)}
    for child, keys in FOREIGN_KEYS.items():
        checks[child] = (db[child], {k: (db[parent], "id") for k, parent in keys.items()})
    return _union([quality.orphans_all(df, keys).select(F.lit(t).alias("table_name"), "column_name", "orphans")
                   for t, (df, keys) in checks.items()])


def _not_null(spark, sf_dir) -> DataFrame:
    db = _db(spark, sf_dir)
    return quality.not_null_violations({t: (db[t], cols) for t, cols in REQUIRED_COLUMNS.items()})


def _sql_import_check(spark, sf_dir) -> DataFrame:
    """The import check as SQL text over registered views."""
    register_views(_db(spark, sf_dir), "db_")
    text = comma_join_sql("sales", "db_", ["id", "year", "quarter", "revenue", "quantity", "gross_margin"])
    return run_sql(spark, text).withColumnsRenamed(
        {"id": "sales_id", "country": "retailer_country", "order_method": "order_method_type"})


def _sql_view_country_year(spark, sf_dir) -> DataFrame:
    """Revenue by country and year as SQL text over the analytic view."""
    create_view(REPORTS["sales_analytics"](_star(spark, sf_dir)), "sales_analytics")
    return run_sql(spark, "SELECT country, year, CAST(sum(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS total_revenue "
                          "FROM sales_analytics GROUP BY country, year ORDER BY country, year")


def _fact_inner(spark, sf_dir) -> DataFrame:
    """The database's sales looked up by source id in the current dimension rows
    (inner, J7), inserted into a catalog table under the shared folder (K5)."""
    # one table per build, whatever the number of calls
    star, table = _star(spark, sf_dir), f"fact_inner_{warehouse_for(spark, sf_dir).root.rpartition('-')[2]}"
    rows = fact_by_source_id(_db(spark, sf_dir)["sales"], star)
    columns = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{scratch_path(spark, table)}'")
    insert_into(rows, table, overwrite=True)
    return spark.table(table)


def _dirty(spark, sf_dir):
    return warehouse_for(spark, sf_dir, "dirty", raw=dirty_sales_raw(spark, sf_dir),
                         change_file=dirty_file_part, change_db=dirty_entity)


_RELOADED: dict[tuple, tuple[Store, list]] = {}


def _reloaded(spark, sf_dir) -> tuple[Store, list]:
    """The warehouse as a store's first load, then a later delivery: refused by a
    wrong expectation, published, and loaded once more. The store, and per attempt
    what became of it."""
    wh = warehouse_for(spark, sf_dir)
    if (key := (spark.sparkContext.applicationId, wh.root)) not in _RELOADED:
        store, attempts = Store(spark, scratch_path(spark, "store")), []

        def tell(what: str, accepted: bool) -> None:
            m = store.manifest()
            attempts.append((len(attempts) + 1, what, accepted, m.version,
                             sum(m.rows[f"fact_sales/{b}"] for b in m.loads["fact_sales"]), m.rows["dim_product"]))

        with sized_for(spark, wh.input_bytes):
            # the build has written the cleaned rows; the batch is read several times
            _, later = at_once(spark, [lambda: reload.first_load(store, wh),
                                       lambda: stored_table(second_batch(_cleaned(spark, sf_dir)), "second-batch")])
            tell("first load", True)
            batch = later, second_reference(wh.reference()), "2", "2002-01-01"
            candidate = reload.load_batch(store, *batch)
            try:
                reload.publish_load(store, candidate, {"dim_country": ("==", 21)})
                tell("second load, wrong count expected", True)
            except quality.ExpectationError:
                tell("second load, wrong count expected", False)
            reload.publish_load(store, candidate)
            tell("second load", True)
            reload.publish_load(store, reload.load_batch(store, *batch))
            tell("second load again", True)
        _RELOADED[key] = store, attempts
    return _RELOADED[key]


def _publish_attempts(spark, sf_dir) -> DataFrame:
    return spark.createDataFrame(_reloaded(spark, sf_dir)[1], "attempt int, load string, accepted boolean, "
                                 "current_version int, fact_rows long, dim_product_rows long")


def _reload_keys(spark, sf_dir) -> DataFrame:
    store = _reloaded(spark, sf_dir)[0]
    first, now = store.manifest(1), store.manifest()
    keys = {t: ("id", ["name"]) for t in DB_TABLES[:-1]} | {"dim_date": ("date_tk", ["year", "quarter"])}
    keys |= {t: (spec.key, [*reload.NATURAL_KEYS[t], "version"]) for t, spec in reload.SPECS.items()}
    return reload.kept_keys({t: store.read(first, t) for t in keys}, {t: store.read(now, t) for t in keys}, keys)


_INFERRED: dict[tuple, tuple[DataFrame, dict]] = {}


def _inferred(spark, sf_dir) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All sales of the faulty build, and dimensions of its database alone with a
    placeholder for every member that only the file has."""
    wh = _dirty(spark, sf_dir)
    if (key := (spark.sparkContext.applicationId, wh.root)) not in _INFERRED:
        sales = database_sales(wh.database()).unionByName(file_sales(wh.file_part()))
        with sized_for(spark, wh.input_bytes):
            found = with_inferred(build_dimensions(wh.database(), None, wh.reference()), sales)
            _INFERRED[key] = sales, {t: stored_table(df, f"inferred-{t}") for t, df in found.items()}
    return _INFERRED[key]


def _fact_inferred(spark, sf_dir) -> DataFrame:
    sales, dims = _inferred(spark, sf_dir)
    return number_fact(lookup_keys(sales, dims))


_REJECTS: dict[tuple, tuple[str, StructType]] = {}


def _checked(spark, sf_dir) -> tuple[str, StructType]:
    """The file part delivered with unreadable cells, read into good rows and rejects."""
    wh = warehouse_for(spark, sf_dir)
    if (key := (spark.sparkContext.applicationId, wh.root)) not in _REJECTS:
        schema, text, path = wh.flat_schema(), scratch_path(spark, "faulty-csv"), scratch_path(spark, "checked")
        write_csv(faulty_cells(wh.file_part()), text, compression="gzip", rows_per_file=CSV_ROWS)
        cells = read_cells(spark, text, schema.names, multi_line=True)
        with sized_for(spark, wh.input_bytes):
            write_checked(checked_cells(cells, schema, required=schema.names), path)
        _REJECTS[key] = path, schema
    return _REJECTS[key]


def _csv_rejects(spark, sf_dir) -> DataFrame:
    return rejected_rows(spark, *_checked(spark, sf_dir)).select(
        "column", "value", "reason", F.concat_ws("|", F.transform("raw", lambda c: F.coalesce(c, F.lit("")))).alias("raw"))


def _csv_reject_counts(spark, sf_dir) -> DataFrame:
    bad = (F.col("rejected") == "true").cast("long")
    return spark.read.parquet(_checked(spark, sf_dir)[0]).agg(
        F.count(F.lit(1)).alias("rows_in"), F.sum(1 - bad).alias("good_rows"), F.sum(bad).alias("rejected_rows"))


def _source_catalog(spark, sf_dir) -> DataFrame:
    """The registered source tables by ``SHOW TABLES``, with their kind and rows."""
    tables = merge_sources(load_tables(spark, sf_dir), {"country_reference": country_reference(spark, sf_dir), "web": None})
    register_views(tables, "source_")
    kinds = small_table(spark, [("lineitem", "lines"), ("orders", "lines")], StructType().add("t", "string").add("kind", "string"))
    counts = _union([spark.table(f"source_{t}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("c"), "rows") for t in tables])
    shown = list_tables(spark).where(F.col("tableName").startswith("source_")).select(
        F.substring("tableName", len("source_") + 1, 99).alias("table_name"))
    return shown.join(counts, F.col("table_name") == F.col("c")).join(kinds, F.col("table_name") == F.col("t"), "left").select(
        "table_name", F.coalesce("kind", F.lit("names")).alias("kind"), "rows")


def _quarter_numbers(spark, sf_dir) -> DataFrame:
    """Both quarter parsers side by side on the different quarter texts."""
    return distinct_rows(_flat(spark, sf_dir), ["quarter"]).select(
        "quarter", parse_quarter("quarter").alias("by_pattern"), first_number("quarter").alias("first_number"))


def _fact_unmatched(spark, sf_dir) -> DataFrame:
    f = _star(spark, sf_dir)["fact_sales"]
    miss = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in
                                       ["country_tk", "retailer_tk", "product_tk",
                                        "order_method_tk", "date_tk"]])
    return f.agg(F.count(F.lit(1)).alias("fact_rows"),
                 F.coalesce(F.sum(miss.cast("long")), F.lit(0)).cast("long").alias("unmatched_rows"))


def _roundtrip(spark, sf_dir) -> DataFrame:
    wh = warehouse_for(spark, sf_dir)
    return quality.roundtrip(wh.database_part(), denormalize(wh.database()))


def _llm_queries() -> tuple[dict, dict]:
    """Queries and oracle SQL of the optional subpackage; none if it is not there."""
    try:
        import corpus_pipeline
        from retailstar.llm.queries import ORACLE_SQL, QUERIES
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "retailstar.llm", "retailstar.llm.queries"):
            raise
        return {}, {}
    oracle = dict(ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        oracle["pipeline"] = corpus_pipeline.ORACLE_SQL
    return QUERIES | {"pipeline": corpus_pipeline.run}, oracle


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # Lab 1/2: cleaning, profiling, split
        "sales_flat": _flat,
        "split_80_20": lambda s, d: warehouse_for(s, d).processed(),
        "split_sizes": lambda s, d: warehouse_for(s, d).processed().groupBy("part").agg(
            F.count(F.lit(1)).alias("rows")),
        "duplicate_rows": lambda s, d: duplicate_count(_cleaned(s, d)),
        "profile_shape": lambda s, d: profile.shape(_cleaned(s, d)),
        "profile_nulls": lambda s, d: profile.null_counts(_cleaned(s, d)),
        "profile_distinct": lambda s, d: profile.distinct_counts(_cleaned(s, d)),
        "profile_value_counts": lambda s, d: profile.value_counts(_cleaned(s, d)),
        "profile_top_values": lambda s, d: profile.top_values(_cleaned(s, d), 3),
        "profile_sketch": _profile_sketch,
        "country_reference": country_reference,
        # the file part, written and read as delimited text
        "csv_file_part": lambda s, d: warehouse_for(s, d).file_part(),
        "csv_inferred": lambda s, d: read_csv_inferred(s, f"{warehouse_for(s, d).root}/file_csv"),
        # Lab 2: normalised tables and the import checks
        "import_check": lambda s, d: denormalize(_db(s, d)),
        "sales_page": lambda s, d: denormalize(_db(s, d)).orderBy("sales_id").limit(100),
        "roundtrip_check": _roundtrip,
        # checks
        "key_uniqueness": _key_uniqueness,
        "fk_orphans": _fk_orphans,
        "fact_unmatched": _fact_unmatched,
        "not_null_violations": _not_null,
        "type_conflicts": lambda s, d: type_conflicts(_flat(s, d)),
        # SQL text over registered views, insert-select
        "sql_import_check": _sql_import_check,
        "sql_view_country_year": _sql_view_country_year,
        "fact_inner": _fact_inner,
        # the same build over a flat file with faults put in by rule
        "dirty_clean": lambda s, d: clean_flat(dirty_sales_raw(s, d)),
        "dirty_dim_country": lambda s, d: _dirty(s, d).star()["dim_country"],
        "dirty_dim_product": lambda s, d: _dirty(s, d).star()["dim_product"],
        "dirty_dim_retailer": lambda s, d: _dirty(s, d).star()["dim_retailer"],
        "dirty_fact": lambda s, d: _dirty(s, d).star()["fact_sales"],
        "top_products_colocated": _top_products_colocated,
        # members that only the file has, as placeholders; rejects; the source registry
        "fact_inferred": _fact_inferred,
        "inferred_members": lambda s, d: inferred_rows(_inferred(s, d)[1]),
        "csv_rejects": _csv_rejects,
        "csv_reject_counts": _csv_reject_counts,
        "dirty_file_part": lambda s, d: _dirty(s, d).file_part(),
        "source_catalog": _source_catalog,
        "quarter_numbers": _quarter_numbers,
        # a later delivery into the published star: versions, stable keys, batches, audits
        "scd_dim_product": lambda s, d: _reloaded(s, d)[0].star()["dim_product"],
        "scd_dim_country": lambda s, d: _reloaded(s, d)[0].star()["dim_country"],
        "reload_dim_date": lambda s, d: _reloaded(s, d)[0].star()["dim_date"],
        "reload_db_product": lambda s, d: _reloaded(s, d)[0].read(_reloaded(s, d)[0].manifest(), "product"),
        "reload_keys": _reload_keys,
        "fact_reload": lambda s, d: _reloaded(s, d)[0].star()["fact_sales"],
        "publish_attempts": _publish_attempts,
    }
    for t in DB_TABLES:
        q[f"db_{t}"] = (lambda name: lambda s, d: _db(s, d)[name])(t)
    for t in DIM_TABLES + ["fact_sales"]:
        q[t] = (lambda name: lambda s, d: _star(s, d)[name])(t)
    for name, fn in REPORTS.items():
        q[name] = (lambda f: lambda s, d: f(_star(s, d)))(fn)
    return q | _llm_queries()[0]


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql() | _llm_queries()[1]
    return {k: sql[k] for k in queries() if k in sql}
