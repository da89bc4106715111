"""The foreign keys of the normalised tables, and rows with names in their place.

One map serves the joins along the keys (J1, J2, J6, J11) and the reference
checks (Q6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join

#: child table -> {foreign key column: parent table}; parents have id and name
FOREIGN_KEYS = {
    "product_type": {"product_line_fk": "product_line"},
    "product": {"product_type_fk": "product_type"},
    "sales": {"country_fk": "country", "order_method_fk": "order_method",
              "product_fk": "product", "retailer_type_fk": "retailer_type"},
}


def ancestors(table: str) -> list[str]:
    """The entities whose names ``unfold`` adds to a row of ``table``."""
    out: list[str] = []
    for parent in FOREIGN_KEYS.get(table, {}).values():
        out += [parent, *ancestors(parent)]
    return out


def unfold(tables: dict[str, DataFrame], table: str, how: str = "left") -> DataFrame:
    """Rows of ``table`` with a column per entity above, holding its name, instead
    of foreign keys; the table's own name gets the table's name.

    A foreign key that the rows lack is left out. Parents are unfolded before the child meets them, so the large table takes
    one lookup per key, however deep the hierarchy is.
    """
    rows = tables[table]
    if "name" in rows.columns:
        rows = rows.withColumnRenamed("name", table)
    for key, parent in FOREIGN_KEYS.get(table, {}).items():
        if key not in rows.columns:
            continue
        above = unfold(tables, parent, how).select(
            F.col("id").alias(f"{key}__id"), parent, *ancestors(parent))
        rows = lookup_join(rows, above, F.col(key) == F.col(f"{key}__id"), how).drop(key, f"{key}__id")
    return rows


def comma_join_sql(table: str, prefix: str, columns: list[str]) -> str:
    """The same rows as ``unfold(..., 'inner')`` as SQL text, a comma join
    over views named ``prefix`` + table, with ``columns`` of the table itself."""
    names = ancestors(table)
    select = [f"{table}.{c}" for c in columns] + [f"{n}.name AS {n}" for n in names]
    where = [f"{child}.{key} = {parent}.id" for child in [table, *names]
             for key, parent in FOREIGN_KEYS.get(child, {}).items()]
    sources = ", ".join(f"{prefix}{t} {t}" for t in [table, *names])
    return f"SELECT {', '.join(select)} FROM {sources} WHERE {' AND '.join(where)}"
