"""The end-to-end build, staged through written tables.

Stages, each reading what the previous one wrote (so a lost executor only
costs the running stage, and no plan is recomputed by later stages):

1. ``processed``  - the cleaned flat file with its 80:20 label, partitioned by
   the label;
2. ``file_csv``   - the file part as delimited text; ``file_rows`` - its cells,
   converted once into good rows, which the later stages read, and rejects;
3. ``reference``  - the country reference table;
4. ``db/*``       - the seven normalised tables built from the database part,
   each written before the next one joins it;
5. ``star/dim_*`` - the five dimensions (database tables + file part);
6. ``star/fact_sales``, partitioned by ``date_tk``.

What a stage needed only for itself (rows to number, numbered rows) is deleted
when the stage is written. A dimension with a repeated business key fails the
build: its sales would multiply.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import at_once, delete_path, release_temporary, scratch_path, shuffle_partitions, sized_for, table_state
from ..sinks.writers import write_csv, write_parquet
from ..sources.files import NULL_TOKEN, checked_cells, good_rows, read_cells, rejected_rows, write_checked
from ..sources.testdata import TABLES, country_reference, sales_raw
from .dimensions import dim_country, dim_date, dim_order_method, dim_product, dim_retailer
from .facts import FACT_COLUMNS, fact_sales
from .normalize import different_names, normalize_entities, normalize_sales
from .preprocess import preprocess
from ..operators.quality import _OPS, ExpectationError, duplicate_keys

DB_TABLES = ["country", "order_method", "retailer_type", "product_line", "product_type",
             "product", "sales"]
DIM_TABLES = ["dim_product", "dim_country", "dim_retailer", "dim_order_method", "dim_date"]
#: columns of the normalised tables that must not be null
REQUIRED_COLUMNS = {
    "country": ["name", "population", "region"], "order_method": ["name"],
    "retailer_type": ["name", "speciality_store"], "product_line": ["name"], "product_type": ["name"],
    "sales": ["year", "quarter", "revenue", "quantity", "gross_margin"],
}
BUSINESS_KEYS = {
    "dim_product": ["product_name", "product_type_name", "product_line_name"],
    "dim_country": ["name"], "dim_retailer": ["name"], "dim_order_method": ["name"],
    "dim_date": ["year", "quarter"],
}


#: rows of one delimited file, which one task reads
CSV_ROWS = 1_000_000


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    timings: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)      # rows written per table, observed in the write
    input_bytes: int = 0                          # of the tables it was built from

    def write(self, df: DataFrame, rel: str, **kw) -> None:
        self.rows[rel] = write_parquet(df, f"{self.root}/{rel}", count=True, **kw)

    def read(self, rel: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{rel}")

    def processed(self) -> DataFrame:
        return self.read("processed")

    def file_part(self) -> DataFrame:
        """The good rows of the file part's delimited file, with the flat schema."""
        return good_rows(self.spark, f"{self.root}/file_rows", self.flat_schema())

    def rejects(self) -> DataFrame:
        """The file part's bad cells: (column, value, reason, raw)."""
        return rejected_rows(self.spark, f"{self.root}/file_rows", self.flat_schema())

    def flat_schema(self) -> StructType:
        return self.processed().drop("part").schema

    def database_part(self) -> DataFrame:
        return self.processed().filter(F.col("part") == "database").drop("part")

    def reference(self) -> DataFrame:
        return self.read("reference")

    def database(self) -> dict[str, DataFrame]:
        return {t: self.read(f"db/{t}") for t in DB_TABLES}

    def star(self) -> dict[str, DataFrame]:
        out = {t: self.read(f"star/{t}") for t in DIM_TABLES}
        out["fact_sales"] = self.read("star/fact_sales").select(*FACT_COLUMNS)
        return out


def colocated(spark: SparkSession, star: dict[str, DataFrame], dim: str, key: str,
              buckets: int | None = None) -> dict[str, DataFrame]:
    """The star with its fact and one large dimension written in buckets of
    their join key, sorted, so that they meet without a shuffle however large the
    dimension is. ``drop_colocated`` removes the two tables.

    Buckets follow the session's shuffle partitions unless given; both tables have
    the same number, which is what makes the join local."""
    n, out = buckets or shuffle_partitions(spark), dict(star)
    for t in (dim, "fact_sales"):
        table = f"{t}_by_{key}_{uuid.uuid4().hex[:12]}"
        (star[t].repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", scratch_path(spark, table))
         .saveAsTable(table))
        out[t] = spark.table(table)
    return out


def drop_colocated(spark: SparkSession) -> None:
    """Remove the tables of ``colocated`` from the catalog, with their files."""
    for t in spark.catalog.listTables():
        if re.fullmatch(r"\w+_by_\w+_tk_[0-9a-f]{12}", t.name):
            path = spark.sql(f"DESCRIBE EXTENDED {t.name}").where("col_name = 'Location'").first()["data_type"]
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
            delete_path(spark, path)


def build_dimensions(db: dict[str, DataFrame], file_part: DataFrame | None,
                     reference: DataFrame | None, **version) -> dict[str, DataFrame]:
    """N8 (dimension part): the five dimensions, numbered side by side."""
    steps = {
        "dim_product": lambda: dim_product(db["product"], db["product_type"], db["product_line"],
                                           file_part, **version),
        "dim_country": lambda: dim_country(db["country"], file_part, reference, **version),
        "dim_retailer": lambda: dim_retailer(db["retailer_type"], file_part, **version),
        "dim_order_method": lambda: dim_order_method(db["order_method"], file_part, **version),
        "dim_date": lambda: dim_date(db["sales"], file_part),
    }
    return dict(zip(steps, at_once(db["sales"].sparkSession, list(steps.values()))))


def check_business_keys(dims: dict[str, DataFrame]) -> None:
    """Raise if a dimension holds a business key twice (one job for all)."""
    parts = [duplicate_keys(dims[d], key).select(F.lit(d).alias("d"), "duplicate_keys")
             for d, key in BUSINESS_KEYS.items() if d in dims]
    bad = [r["d"] for r in reduce(DataFrame.unionByName, parts).collect() if r["duplicate_keys"]]
    if bad:
        raise ExpectationError(f"repeated business key in {', '.join(bad)}")


def build_warehouse(spark: SparkSession, sf_dir: str, root: str | None = None,
                    frac: float = 0.2, seed: int = 1, unmatched: str = "keep",
                    expect: dict[str, tuple[str, int]] | None = None,
                    load_ts=None, open_end=None, raw: DataFrame | None = None,
                    change_file=None, change_db=None) -> Warehouse:
    """Extract, preprocess, normalise, build and load the star schema.

    ``expect`` maps a table ('star/fact_sales', 'star/dim_country', ...) to
    (op, count), e.g. ``{'star/dim_country': ('==', 21)}``; the counts come
    from the writes themselves (Q1 without extra jobs). ``load_ts``/``open_end``
    go to every dimension. ``raw`` replaces the flat file of ``sf_dir``;
    ``change_file(df)`` and ``change_db(name, df)`` change the file part and the
    entity tables before they are written (late corrections, test data)."""
    import time
    wh = Warehouse(spark, root or scratch_path(spark, "warehouse"),
                   input_bytes=sum(size for size, _ in _state(spark, sf_dir)))

    def stage(name, fn):
        t0 = time.perf_counter()
        with sized_for(spark, wh.input_bytes):
            fn()
        release_temporary(spark)
        wh.timings[name] = round(time.perf_counter() - t0, 3)

    def processed():
        pre = preprocess(sales_raw(spark, sf_dir) if raw is None else raw, frac=frac, seed=seed)
        wh.write(pre.labelled, "processed", partition_by=["part"])
        part = wh.processed().filter(F.col("part") == "file").drop("part")
        write_csv(part if change_file is None else change_file(part), f"{wh.root}/file_csv", null_token=NULL_TOKEN,
                  compression="gzip", rows_per_file=CSV_ROWS)
        # the job's own file: line breaks may stand in cells, and its null is no pandas token
        cells = read_cells(spark, f"{wh.root}/file_csv", part.columns, multi_line=True, null_token=NULL_TOKEN)
        write_checked(checked_cells(cells, part.schema, na_tokens=[NULL_TOKEN]), f"{wh.root}/file_rows")
    stage("processed", processed)
    stage("reference", lambda: wh.write(country_reference(spark, sf_dir), "reference"))

    def normalise():
        flat = wh.database_part()

        def write(df: DataFrame, name: str) -> DataFrame:
            wh.write(df if change_db is None else change_db(name, df), f"db/{name}")
            return wh.read(f"db/{name}")

        names = different_names(flat)
        entities = normalize_entities(flat, wh.reference(), write, names)
        wh.write(normalize_sales(flat, entities, names), "db/sales")
    stage("database", normalise)

    def dims():
        made = build_dimensions(wh.database(), wh.file_part(), wh.reference(), load_ts=load_ts, open_end=open_end)
        at_once(spark, [lambda name=name, df=df: wh.write(df, f"star/{name}") for name, df in made.items()])
        check_business_keys({t: wh.read(f"star/{t}") for t in DIM_TABLES})
    stage("dimensions", dims)

    def fact():
        star = {t: wh.read(f"star/{t}") for t in DIM_TABLES}
        rows = fact_sales(wh.database(), star, wh.file_part(), unmatched)
        # few files per date: rows of a date go together, a large date is split
        wh.write(rows.hint("rebalance", "date_tk"), "star/fact_sales", partition_by=["date_tk"])
    stage("fact", fact)
    for rel, (op, n) in (expect or {}).items():
        got = wh.rows.get(rel)
        if got is None or not _OPS[op](got, n):
            raise ExpectationError(f"{rel}: {got} rows, expected {op} {n}")
    return wh


def _state(spark: SparkSession, sf_dir: str) -> tuple[tuple[int, int], ...]:
    return tuple(table_state(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TABLES)


_BUILT: dict[tuple, Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str, kind: str = "", **kw) -> Warehouse:
    """The warehouse of ``sf_dir`` built once per application and state of its
    tables (the ETL runs, then reports read the loaded tables); rewritten tables
    have other sizes or times and are built anew. ``kind`` names a variant."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind, _state(spark, sf_dir))
    if key not in _BUILT:
        _BUILT[key] = build_warehouse(spark, sf_dir, **kw)
    return _BUILT[key]
