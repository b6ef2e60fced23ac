"""A warehouse published as a whole: new versions of its tables become visible at once, or not at all.

Under the warehouse's folder, ``versions/<version>/<table>`` holds the tables as they are written and
``published/<number>`` names a version with its tables. Writing and checking a version touches nothing that a
reader sees. One rename puts the next number's file in its place; from then on the new version is the warehouse.
What follows only carries that out: catalog tables are pointed to the version, or its folders moved to
``<table>``. A load that is stopped before the rename leaves the old warehouse; one that is stopped after it is
carried out by ``recover``, which every load and ``read`` respects. One loader at a time; two that race for a
number meet at the rename, and the second fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from starwash.sources.files import delete, exists, move, names_in, read_text, write_text
from starwash.sources.tables import counted_write, qualified

DIGITS = 12


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    #: table name: its columns as DDL
    tables: Mapping[str, str]
    rows: Mapping[str, int]


class Warehouse:
    """Tables under ``root``; with ``database`` they are catalog tables of it, else folders ``<root>/<table>``.

    ``keep`` older versions stay, so that queries that still read them can end.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None, keep: int = 1) -> None:
        self.spark, self.root, self.database, self.keep = spark, root.rstrip("/"), database, keep

    @property
    def _catalog(self) -> bool:
        return self.database is not None

    def _marker(self, number: int) -> str:
        return f"{self.root}/published/{number:0{DIGITS}d}"

    def _numbers(self) -> list[int]:
        return [int(n) for n in names_in(self.spark, f"{self.root}/published") if n.isdigit()]

    def _version(self, number: int) -> Version:
        return Version(number=number, **json.loads(read_text(self.spark, self._marker(number))))

    def current(self) -> Version | None:
        numbers = self._numbers()
        return self._version(max(numbers)) if numbers else None

    def _folder(self, version: Version, table: str) -> str:
        return f"{self.root}/versions/{version.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        """A table of the current version, also while a switch is not carried out yet."""
        version = self.current()
        if version is None or table not in version.tables:
            raise LookupError(f"{self.root} publishes no table {table}")
        own = self._folder(version, table)
        path = own if self._catalog or exists(self.spark, own) else f"{self.root}/{table}"
        return self.spark.read.schema(version.tables[table]).parquet(path)

    def publish(
        self,
        tables: Mapping[str, DataFrame],
        check: Callable[[Mapping[str, DataFrame]], None] | None = None,
        schemas: Mapping[str, str] | None = None,
        cluster_by: Mapping[str, str] | None = None,
    ) -> dict[str, int]:
        """Write a new version of the whole warehouse, check what was written, switch; rows per table.

        ``check`` sees the written tables and raises to stop the load. ``schemas`` casts tables to columns given as
        DDL; ``cluster_by`` names a column by whose ranges a table's files are cut.
        """
        self.recover()
        version = self.write(tables, schemas, cluster_by)
        if check:
            check({name: self.spark.read.schema(ddl).parquet(self._folder(version, name)) for name, ddl in version.tables.items()})
        self.switch(version)
        self.recover()
        return dict(version.rows)

    def write(
        self, tables: Mapping[str, DataFrame], schemas: Mapping[str, str] | None = None, cluster_by: Mapping[str, str] | None = None
    ) -> Version:
        """Write a version that no reader sees yet."""
        old = self.current()
        number, rows, ddl = 1 + (old.number if old else 0), {}, {}
        folder = f"{number:0{DIGITS}d}-{uuid.uuid4().hex}"
        for name, df in tables.items():
            if name in (schemas or {}):
                fields = T.StructType.fromDDL(schemas[name]).fields
                df = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields])
            path = f"{self.root}/versions/{folder}/{name}"
            rows[name] = counted_write(df, (cluster_by or {}).get(name), lambda out, path=path: out.parquet(path))
            ddl[name] = df.schema.toDDL()
        return Version(number, folder, ddl, rows)

    def switch(self, version: Version) -> None:
        """The one rename that makes ``version`` the warehouse."""
        draft = f"{self.root}/drafts/{version.folder}"
        write_text(self.spark, draft, json.dumps({"folder": version.folder, "tables": version.tables, "rows": version.rows}))
        move(self.spark, draft, self._marker(version.number))

    def recover(self) -> None:
        """Carry out the last switch and delete what no published version needs. Running it again changes nothing."""
        version = self.current()
        if version:
            for table, ddl in version.tables.items():
                self._attach(version, table, ddl) if self._catalog else self._move_in(version, table)
        self._clean(version)

    def _attach(self, version: Version, table: str, ddl: str) -> None:
        """Point the catalog table to the version's folder; an older table of that name makes way."""
        name, folder, spark = qualified(table, self.database), self._folder(version, table), self.spark
        if spark.catalog.tableExists(name):
            described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name in ('Location', 'Type')").collect()
            known = {r.col_name: r.data_type for r in described}
            if known.get("Location", "").rstrip("/").endswith(f"/versions/{version.folder}/{table}"):
                return
            if known.get("Type") == "EXTERNAL" and spark.table(name).schema == T.StructType.fromDDL(ddl):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
                return
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{folder}'")

    def _move_in(self, version: Version, table: str) -> None:
        """Move the version's folder to ``<root>/<table>``, what is there to the version's ``replaced`` folder."""
        new, here = self._folder(version, table), f"{self.root}/{table}"
        if not exists(self.spark, new):
            return  # moved before
        if exists(self.spark, here):
            move(self.spark, here, f"{self.root}/replaced/{version.folder}/{table}")
        move(self.spark, new, here)
        self.spark.catalog.refreshByPath(here)

    def _clean(self, version: Version | None) -> None:
        numbers = sorted(self._numbers())[-1 - self.keep :]
        kept = {self._version(n).folder for n in numbers}
        for place in ("versions", "replaced", "drafts"):
            for name in names_in(self.spark, f"{self.root}/{place}"):
                if name not in kept or (place == "replaced" and name != version.folder):
                    delete(self.spark, f"{self.root}/{place}/{name}")
        for number in self._numbers():
            if number not in numbers:
                delete(self.spark, self._marker(number))


def warehouse_of(spark: SparkSession, database: str | None = None) -> Warehouse:
    """The warehouse of a database, with its versions in the database's own folder."""
    name = database or spark.catalog.currentDatabase()
    return Warehouse(spark, f"{spark.catalog.getDatabase(name).locationUri.rstrip('/')}/starwash", name)
