"""Gold tables that readers always find whole.

A build goes to a new folder, which becomes a catalog table of its own; one statement then points the
table's name, a view, to it. Days of a table stored by day are replaced by writing them to a new folder
and switching the location of each day's partition, one statement a day. Nothing that a reader may
hold is overwritten: the build before the current one stays until the next.

Marks that a build has reached, such as the last batch of its input, are properties of its table, so
an update knows where to go on. They live as long as the catalog does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from silverbrook import settings
from silverbrook.streaming import folders, sinks

MARK = "mark."


class Published:
    """Tables of one catalog database, their folders under one root."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark, self.database, self.root = spark, database, root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def _properties(self, name: str) -> dict[str, str]:
        if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return {}
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.database}.{name}").collect()
        return {r["key"]: r["value"] for r in rows}

    def build_of(self, name: str) -> str | None:
        """The build that a name stands for now."""
        return self._properties(name).get("build")

    def _table(self, name: str, build: str) -> str:
        return f"{self.database}.{name}__{build}"

    def marks(self, name: str) -> dict[str, str]:
        """What the current build has reached; empty without one."""
        build = self.build_of(name)
        found = self._properties(f"{name}__{build}") if build else {}
        return {k.removeprefix(MARK): v for k, v in found.items() if k.startswith(MARK)}

    def _set_marks(self, name: str, build: str, marks: dict[str, str]) -> None:
        if marks:
            pairs = ", ".join(f"'{MARK}{k}' = '{v}'" for k, v in marks.items())
            self.spark.sql(f"ALTER TABLE {self._table(name, build)} SET TBLPROPERTIES ({pairs})")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def build(
        self, name: str, rows: DataFrame, by: str | None = None,
        check: Callable[[DataFrame], object] | None = None, marks: dict[str, str] | None = None,
    ) -> int:
        """Replace a whole table, stored by the day column ``by`` if given; returns the rows written.

        A build that fails, in writing or in its check, leaves the name as it was.
        """
        build, before = uuid.uuid4().hex[:12], self.build_of(name)
        folder, table = f"{self.root}/{name}/{build}", self._table(name, build)
        records = sinks.overwrite_partitioned(rows, folder, by) if by else sinks.overwrite(
            folders.moved(rows, settings.WRITING), folder)
        if check:
            check(self.spark.read.schema(rows.schema).parquet(folder))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        parted = f"PARTITIONED BY (`{by}`) " if by else ""
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parted}LOCATION '{folder}'")
        if by:
            self.spark.sql(f"MSCK REPAIR TABLE {table}")
        self._set_marks(name, build, marks or {})
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.database}.{name} TBLPROPERTIES ('build' = '{build}') AS "
            f"SELECT {', '.join(f'`{f.name}`' for f in rows.schema)} FROM {table}")
        self._sweep(name, {build, before})
        return records

    def replace_days(
        self, name: str, rows: DataFrame, by: str, days: list[str], marks: dict[str, str] | None = None,
    ) -> int:
        """Replace whole days, given as texts, by the rows of them; days without rows go.

        Marks are set last: an update that fails half-way has replaced whole days, and is done again.
        """
        build = self.build_of(name)
        table, folder = self._table(name, build), f"{self.root}/{name}/{build}-days/{uuid.uuid4().hex[:12]}"
        records = sinks.overwrite_partitioned(rows, folder, by) if days else 0
        written = {found.removeprefix(f"{by}=") for found in folders.subfolders(self.spark, folder) if "=" in found}
        if not written <= set(days):
            raise ValueError(f"{name}: rows of days that are not to be replaced")
        known = {r[0].removeprefix(f"{by}=") for r in self.spark.sql(f"SHOW PARTITIONS {table}").collect()} if days else set()
        for day in sorted(written):
            change = "PARTITION ({0}) SET LOCATION '{1}'" if day in known else "ADD PARTITION ({0}) LOCATION '{1}'"
            self.spark.sql(f"ALTER TABLE {table} " + change.format(f"`{by}` = '{day}'", f"{folder}/{by}={day}"))
        for day in sorted((set(days) - written) & known):
            self.spark.sql(f"ALTER TABLE {table} DROP PARTITION (`{by}` = '{day}')")
        self._set_marks(name, build, marks or {})
        return records

    def _sweep(self, name: str, kept: set[str | None]) -> None:
        """Drop tables and folders of builds that neither the name nor a reader of the last build needs."""
        for row in self.spark.sql(f"SHOW TABLES IN {self.database} LIKE '{name}__*'").collect():
            build = row["tableName"].removeprefix(f"{name}__")
            if build in kept or row["tableName"] == build:
                continue
            self.spark.sql(f"DROP TABLE {self.database}.{row['tableName']}")
            for found in (build, f"{build}-days"):
                folders.delete(self.spark, f"{self.root}/{name}/{found}")
