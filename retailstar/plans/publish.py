"""Publishing a star after its audit (K3, K6, K7, Q1).

A store is a folder. A load writes its tables into folders of its own; nothing
that a reader sees is touched. What is current is said by manifests, small files
numbered upwards: the highest one names the folder of every table and, for tables
that grow by loads, the folder of every batch. ``publish`` audits the candidate
and only then puts the next manifest in place (written beside, then renamed; a
number that exists already fails, so of two loads at once one is refused). A
failed audit leaves the old star as it was; a batch that is loaded again takes the
place of its former folder, so its rows are there once; ``withdraw`` goes back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import _OPS, ExpectationError, duplicate_keys, orphans_all
from ..session import delete_path, file_names, read_small, write_small
from ..sinks.writers import write_parquet
from .facts import FACT_COLUMNS

_MANIFESTS = "published"


@dataclass(frozen=True)
class Manifest:
    """What a published version consists of: a folder per table, and per growing
    table a folder per batch. ``rows``: rows written per table, or per table and batch."""

    version: int = 0
    tables: dict = field(default_factory=dict)
    loads: dict = field(default_factory=dict)
    rows: dict = field(default_factory=dict)

    def with_table(self, name: str, folder: str, rows: int) -> Manifest:
        return replace(self, tables=self.tables | {name: folder}, rows=self.rows | {name: rows})

    def with_load(self, name: str, batch: str, folder: str, rows: int) -> Manifest:
        return replace(self, loads=self.loads | {name: self.loads.get(name, {}) | {batch: folder}},
                       rows=self.rows | {f"{name}/{batch}": rows})

    def with_new(self, before: Manifest, other: Manifest) -> Manifest:
        """This manifest with what ``other`` names and ``before``, from which both were
        made, did not."""
        def new(was: dict, now: dict) -> dict:
            return {k: v for k, v in now.items() if was.get(k) != v}

        loads = {t: self.loads.get(t, {}) | new(before.loads.get(t, {}), b) for t, b in other.loads.items()}
        # rows follow their folders: a table written anew may have as many rows as before
        return replace(self, tables=self.tables | new(before.tables, other.tables), loads=self.loads | loads,
                       rows=self.rows | new(before.rows, other.rows))


class Store:
    """Tables below ``root``, read through the current manifest."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in file_names(self.spark, f"{self.root}/{_MANIFESTS}") if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> Manifest:
        """The current manifest (an empty one before the first), or a former one."""
        have = self.versions()
        if version is None and not have:
            return Manifest()
        n = have[-1] if version is None else version
        return Manifest(**json.loads(read_small(self.spark, f"{self.root}/{_MANIFESTS}/{n:08d}.json")))

    def write(self, candidate: Manifest, name: str, df: DataFrame) -> Manifest:
        """A table in a folder of its own; the candidate with it."""
        folder = f"{name}-{uuid.uuid4().hex[:12]}"
        return candidate.with_table(name, folder, write_parquet(df, f"{self.root}/{folder}", count=True))

    def write_load(self, candidate: Manifest, name: str, batch: str, df: DataFrame,
                   partition_by: list[str] | None = None) -> Manifest:
        """A batch of a growing table: ``name/load=<folder>``. The batch's former
        folder is no longer named by the candidate."""
        folder = f"{batch}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/{name}/load={folder}"
        return candidate.with_load(name, batch, folder, write_parquet(df, path, count=True, partition_by=partition_by))

    def read(self, manifest: Manifest, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{manifest.tables[name]}")

    def read_loads(self, manifest: Manifest, name: str, without: str | None = None) -> DataFrame | None:
        """All batches that the manifest names, by partition pruning in one scan."""
        folders = [f for b, f in manifest.loads.get(name, {}).items() if b != without]
        if not folders:
            return None
        return self.spark.read.parquet(f"{self.root}/{name}").where(F.col("load").isin(folders)).drop("load")

    def star(self, manifest: Manifest | None = None) -> dict[str, DataFrame]:
        """The dimensions and the fact of a manifest (default: the current one)."""
        m = manifest or self.manifest()
        out = {t: self.read(m, t) for t in m.tables if t.startswith("dim_")}
        return out | {"fact_sales": self.read_loads(m, "fact_sales").select(*FACT_COLUMNS)}

    def publish(self, candidate: Manifest, audits: list[Callable[[Manifest], None]]) -> Manifest:
        """Run the audits (each raises on a fault), then make the candidate current."""
        for audit in audits:
            audit(candidate)
        new = replace(candidate, version=candidate.version + 1)
        write_small(self.spark, f"{self.root}/{_MANIFESTS}/{new.version:08d}.json", json.dumps(new.__dict__))
        return new

    def withdraw(self) -> Manifest:
        """Take the current manifest back; the one before is current again."""
        delete_path(self.spark, f"{self.root}/{_MANIFESTS}/{self.versions()[-1]:08d}.json")
        return self.manifest()

    def remove_unnamed(self) -> list[str]:
        """Delete table and batch folders that no manifest names (refused or replaced
        loads). Not while a load is running."""
        named = [self.manifest(v) for v in self.versions()]
        tables = {f for m in named for f in m.tables.values()}
        growing = {t for m in named for t in m.loads}
        old = [f for f in file_names(self.spark, self.root) if f not in tables | growing | {_MANIFESTS}]
        for t in growing:
            keep = {f"load={f}" for m in named for f in m.loads.get(t, {}).values()}
            old += [f"{t}/{f}" for f in file_names(self.spark, f"{self.root}/{t}") if f not in keep and f.startswith("load=")]
        for f in old:
            delete_path(self.spark, f"{self.root}/{f}")
        return old


def audit_star(store: Store, natural: dict[str, tuple[str, ...]]) -> Callable[[Manifest], None]:
    """Surrogate keys and versions are unique, a member has at most one open version,
    the fact's keys have parents: two jobs over the candidate."""
    def audit(candidate: Manifest) -> None:
        star, parts = store.star(candidate), []
        for name, by in natural.items():
            dim = star[name]
            checks = [(dim, [dim.columns[0]])]
            if "version" in dim.columns:
                checks += [(dim, [*by, "version"]), (dim.where(F.col("date_to").isNull()), list(by))]
            parts += [duplicate_keys(rows, key).select(F.lit(f"{name}({','.join(key)})").alias("what"),
                                                       F.col("duplicate_keys").alias("n")) for rows, key in checks]
        keys = {star[d].columns[0]: (star[d], star[d].columns[0]) for d in natural}
        lost = orphans_all(star["fact_sales"], keys).select(F.concat(F.lit("orphans "), "column_name").alias("what"),
                                                            F.col("orphans").alias("n"))
        found = reduce(DataFrame.unionByName, [*parts, lost]).where("n > 0").collect()
        if found:
            raise ExpectationError("; ".join(f"{r['what']}: {r['n']}" for r in found))
    return audit


def audit_rows(expect: dict[str, tuple[str, int]]) -> Callable[[Manifest], None]:
    """Q1 on the rows that the writes have counted: {table: (op, count)}, a growing
    table by all its batches."""
    def audit(candidate: Manifest) -> None:
        for name, (op, n) in expect.items():
            got = candidate.rows.get(name)
            if got is None:
                got = sum(candidate.rows[f"{name}/{b}"] for b in candidate.loads.get(name, {}))
            if not _OPS[op](got, n):
                raise ExpectationError(f"{name}: {got} rows, expected {op} {n}")
    return audit
