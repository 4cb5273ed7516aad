"""Names that outlive a job: external tables and SQL views in the session catalog
(SNK-3).

A database holds an external table for each bronze and gold table and a view for
each staging and silver model.  Views are SQL text (``plans.view_sql``), so any
session that shares the catalog reads them by name, plans through them down to
the bronze scans, and sees what has been loaded by then.

The catalog's entries point at the newest version of a versioned table
(``sinks.versions``): the location of a whole table, or the location of each day.
``sync`` moves those pointers after a load; a table's property holds the version
it points at, so only the days that changed are moved.

How long the catalog lives is the cluster's choice (``spark.sql.catalogImplementation``;
with a metastore it outlives the application).  The definitions are also kept in
the shared folder, under ``<root>/_catalog``, so a session whose catalog does not
know them gets the same names back with ``attach``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from kollektiv.sinks import versions

_VERSION = "kollektiv.version"
_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _day(by: str, day: str) -> str:
    return f"PARTITION ({quoted(by)} = {'null' if day == _NULL_DAY else _text(day)})"


class Database:
    """External tables and views of one database, kept under ``root`` as well."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name, self.store = spark, name, f"{root.rstrip('/')}/_catalog"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}")

    def definitions(self) -> dict:
        found = versions.current(self.spark, self.store) or {}
        return {"tables": dict(found.get("tables", {})), "views": dict(found.get("views", {}))}

    def define(self, tables: dict[str, dict], views: dict[str, str]) -> None:
        """Adds to the kept definitions; nothing is written where they already say so."""
        def merged(base: dict | None) -> dict | None:
            before = {k: dict((base or {}).get(k, {})) for k in ("tables", "views")}
            after = {"tables": before["tables"] | tables, "views": before["views"] | views}
            return None if base and before == after else after
        versions._commit(self.spark, self.store, merged)  # noqa: SLF001
        store = versions.Store(self.spark, self.store)
        for n in versions.version_numbers(store)[versions.KEEP_VERSIONS:]:
            store.delete(f"{versions.MANIFESTS}/{n:020d}.json")

    def table(self, name: str, path: str, schema: T.StructType, by: str | None = None) -> None:
        """An external table over the table at ``path``, partitioned by ``by``."""
        self._point(name, path, schema, by)
        self.define({name: {"path": path, "schema": schema.jsonValue(), "by": by}}, {})

    def view(self, name: str, sql: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(self.name, name)} AS {sql}")
        self.define({}, {name: sql})

    def sync(self, *names: str) -> None:
        """Points tables (all by default) at the newest version of their data."""
        known = self.definitions()["tables"]
        for name in names or known:
            d = known[name]
            self._point(name, d["path"], T.StructType.fromJson(d["schema"]), d["by"])

    def attach(self) -> list[str]:
        """Every kept definition, in this session's catalog; their names."""
        known = self.definitions()
        self.sync()
        for name, sql in known["views"].items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {quoted(self.name, name)} AS {sql}")
        return [*known["tables"], *known["views"]]

    def _property(self, table: str) -> int | None:
        found = [r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == _VERSION]
        return int(found[0]) if found else None

    def _point(self, name: str, path: str, schema: T.StructType, by: str | None) -> None:
        spark, table = self.spark, quoted(self.name, name)
        newest = versions.current(spark, path)
        there = spark.catalog.tableExists(f"{self.name}.{name}")
        if there and [(f.name, f.dataType) for f in spark.table(table).schema] != [(f.name, f.dataType) for f in schema]:
            spark.sql(f"DROP TABLE {table}")                # external: only the entry goes
            there = False
        if not there:
            at = f"{path.rstrip('/')}/{newest['folders']['']}" if newest and not newest["by"] else path.rstrip("/")
            parts = f" PARTITIONED BY ({quoted(by)})" if by else ""
            versions.Store(spark, path).fs.mkdirs(versions.Store(spark, path).path())
            spark.sql(f"CREATE TABLE {table} ({_columns(schema)}) USING parquet{parts} LOCATION {_text(at)}")
        if newest is None:
            if by:
                spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
            spark.sql(f"REFRESH TABLE {table}")
            return
        pointed = self._property(table) if there else None
        if pointed == newest["version"]:
            return
        if by:
            self._point_days(table, path, by, pointed, newest)
        elif there:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(versions.locations(newest, path)[''])}")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_VERSION}' = '{newest['version']}')")
        spark.sql(f"REFRESH TABLE {table}")

    def _point_days(self, table: str, path: str, by: str, pointed: int | None, newest: dict) -> None:
        spark, at = self.spark, versions.locations(newest, path)
        try:
            before = versions.current(spark, path, pointed) if pointed is not None else None
        except ValueError:                                  # that version is gone
            before = None
        if before is None:
            # what the entry has is not known: every day is looked at
            held = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
            before = {"folders": dict.fromkeys(held, "")}
        added, moved, ended = versions.changed_days(before, newest)
        for i in range(0, len(added), 500):
            days = " ".join(f"{_day(by, d)} LOCATION {_text(at[d])}" for d in added[i:i + 500])
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {days}")
        for d in moved:
            spark.sql(f"ALTER TABLE {table} {_day(by, d)} SET LOCATION {_text(at[d])}")
        for d in ended:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_day(by, d)}")
