"""Publishing versions behind one pointer, with a backup, and rolling back to it.

Every version is a table of its own that is never changed. What is served is a view over one of them, which also names, as
its properties, the version before it and the last one rolled back. So one statement replaces one entry of the catalog,
and with it the served version and its backup together: readers find the old rows or the new ones, and a query that has
begun goes on reading its version's files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

#: Properties of the served view: its version, the one before, and the one last rolled back.
SERVED, BACKUP, ERROR = "registry.version", "registry.backup", "registry.error"


@dataclass(frozen=True)
class Tables:
    """The states of one published table. ``served``, ``backup`` and ``error`` are views over versions."""

    served: str

    @property
    def stage(self) -> str:
        return f"{self.served}_stage"

    @property
    def new(self) -> str:
        return f"{self.served}_tmp"

    @property
    def backup(self) -> str:
        return f"{self.served}_bkp"

    @property
    def error(self) -> str:
        return f"{self.served}_error"

    def version(self, number: int) -> str:
        return f"{self.served}_v{number}"


def versions(spark: SparkSession, tables: Tables) -> dict[str, str]:
    """The versions that are in use, by property."""
    if not _is_view(spark, tables.served):
        return {}
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {tables.served}").collect()}
    return {key: kept[key] for key in (SERVED, BACKUP, ERROR) if key in kept}


def chunks_of(version: str) -> str:
    """The table with the records of a version that its rows cannot hold; versions without such records have none."""
    return f"{version}_chunks"


def served_chunks(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """The chunks beside the served version, if it has any. They follow the one pointer, in a rollback, too."""
    served = versions(spark, tables).get(SERVED)
    return spark.table(chunks_of(served)) if served and spark.catalog.tableExists(chunks_of(served)) else None


def next_version(spark: SparkSession, tables: Tables) -> str:
    """The table that the next version is to be written to. What a failed run left there is not in use."""
    used = [int(name.rpartition("_v")[2]) for name in versions(spark, tables).values()]
    return tables.version(max(used, default=0) + 1)


def publish(spark: SparkSession, tables: Tables, version: str | None = None) -> None:
    """Serve ``version`` (by default the table ``new``, which becomes one); what was served is the backup.

    The backup before it, versions that failed runs left and the staging table go. A served *table*, as an older
    release kept it, becomes the first version; only then is nothing served for a moment.
    """
    _require(spark, version or tables.new)
    if spark.catalog.tableExists(tables.served) and not _is_view(spark, tables.served):
        first = tables.version(0)
        spark.sql(f"ALTER TABLE {tables.served} RENAME TO {first}")
        _point(spark, tables.served, {SERVED: first})
    if version is None:
        version = next_version(spark, tables)
        _drop(spark, version)
        spark.sql(f"ALTER TABLE {tables.new} RENAME TO {version}")
    before = versions(spark, tables)
    if before.get(SERVED) == version:
        raise ValueError(f"{version} is served already")
    now = {SERVED: version}
    if SERVED in before:
        now[BACKUP] = before[SERVED]
    if before.get(ERROR, version) != version:
        now[ERROR] = before[ERROR]
    _point(spark, tables.served, now)
    _follow(spark, tables)
    _drop(spark, tables.stage)
    _clean(spark, tables)


def rollback(spark: SparkSession, tables: Tables) -> None:
    """Serve the backup; what was served is kept as ``error``. Refused, with nothing touched, without a backup."""
    before = versions(spark, tables)
    if BACKUP not in before:
        raise LookupError(f"there is no table {tables.backup}")
    _require(spark, before[BACKUP])
    _point(spark, tables.served, {SERVED: before[BACKUP], ERROR: before[SERVED]})
    _follow(spark, tables)


def _point(spark: SparkSession, view: str, kept: dict[str, str]) -> None:
    """Replace the view by one over the version ``kept[SERVED]``: one change of the catalog."""
    properties = ", ".join(f"'{key}' = '{value}'" for key, value in kept.items())
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({properties}) AS SELECT * FROM {kept[SERVED]}")


def _follow(spark: SparkSession, tables: Tables) -> None:
    """Views over the backup and the error, after the served view's properties. A run that ended before this changes nothing
    but these two names; the next one mends them."""
    used = versions(spark, tables)
    for view, state in ((tables.backup, BACKUP), (tables.error, ERROR)):
        if spark.catalog.tableExists(view) and not _is_view(spark, view):
            _drop(spark, view)
        if state in used:
            _point(spark, view, {SERVED: used[state]})
        else:
            spark.sql(f"DROP VIEW IF EXISTS {view}")


def _clean(spark: SparkSession, tables: Tables) -> None:
    """Drop the versions that nothing names any more."""
    database, _, name = tables.served.rpartition(".")
    used = {v.rpartition(".")[2] for v in versions(spark, tables).values()}
    for table in spark.catalog.listTables(database or None):
        known = re.fullmatch(rf"({re.escape(name)}_v\d+)({chunks_of('')})?", table.name)
        if known and known[1] not in used and not table.isTemporary:
            _drop(spark, f"{database}.{table.name}" if database else table.name)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _require(spark: SparkSession, table: str) -> None:
    if not spark.catalog.tableExists(table):
        raise LookupError(f"there is no table {table}")


def _drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
