"""Register tables in the Spark catalog (create or replace).

External Parquet tables over the table paths.  A table that is there with the
same columns is only pointed at its path, so it's never absent; one whose
columns changed is dropped and created again, which for an external table
touches no file.  A managed table of the name owns its files: it's refused.
Partitioned tables get their partitions recovered, otherwise they read as empty.

``register_stored`` registers tables of a ``TableStore`` at their newest
version: with the recorded schema, so that columns that only some files have
are there, and with the folder of each partition.  A table that gained columns
gets them by ``ALTER TABLE ADD COLUMNS``; partitions are added, moved to their
new folder or dropped as the version has them.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

from reelhouse.plans.tables import TableStore

# The gold tables the serving layer sees.
SNAPSHOT_PARTITIONS = [("is_current", "boolean"), ("closed_run", "string")]
GOLD_PARTITIONS = {t: SNAPSHOT_PARTITIONS for t in (
    "snap_mart_movie_analytics", "snap_mart_user_behavior", "snap_mart_genre_performance")}
GOLD_TABLES = ["mart_movie_analytics", "mart_user_behavior", "mart_genre_performance",
               "snap_mart_movie_analytics", "snap_mart_user_behavior",
               "snap_mart_genre_performance"]


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_tables(spark: SparkSession, database: str, tables: dict[str, str],
                    partitioned: dict[str, list[tuple[str, str]]] | None = None) -> list[str]:
    """Create ``database`` if needed and point each table at its path.

    ``partitioned`` gives, per table, its partition columns with their SQL
    types (directory values would otherwise be inferred, e.g. a boolean as
    a string); the data columns come from the files' schema.
    """
    partitioned = partitioned or {}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    done = []
    for name, path in tables.items():
        full = f"{_ident(database)}.{_ident(name)}"
        there = spark.catalog.tableExists(full)
        if there and spark.catalog.getTable(full).tableType != "EXTERNAL":
            raise ValueError(f"{full} is a managed table or a view; it isn't replaced")
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        parts = partitioned.get(name)
        if parts:
            part_names = [c for c, _ in parts]
            data = [f for f in spark.read.parquet(path).schema.fields if f.name not in part_names]
            cols = [f"{_ident(f.name)} {f.dataType.simpleString()}" for f in data]
            cols += [f"{_ident(c)} {t}" for c, t in parts]
            made = (f"CREATE TABLE {full} ({', '.join(cols)}) USING parquet "
                    f"PARTITIONED BY ({', '.join(_ident(c) for c in part_names)}) LOCATION '{location}'")
            wanted = [(f.name, f.dataType.simpleString()) for f in data] + list(parts)
        else:
            made = f"CREATE TABLE {full} USING parquet LOCATION '{location}'"
            wanted = spark.read.parquet(path).dtypes
        if there and spark.table(full).dtypes == wanted:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{location}'")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            spark.sql(made)
        if parts:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        spark.catalog.refreshTable(full)
        done.append(name)
    return done


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(part: str) -> str:
    """The PARTITION clause of a partition's relative folder."""
    values = (p.partition("=")[::2] for p in part.split("/"))
    return ", ".join(f"{_ident(k)}={'NULL' if v == '__HIVE_DEFAULT_PARTITION__' else _literal(unquote(v))}" for k, v in values)


def register_stored(spark: SparkSession, database: str, store: TableStore, names: list[str],
                    partitioned: dict[str, list[tuple[str, str]]] | None = None) -> list[str]:
    """Register the newest version of each stored table (create or replace).

    ``partitioned`` gives the SQL types under which partition columns are
    served, where they aren't the recorded ones (a history's ``is_current``).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    for name in names:
        store.compact(name)  # one folder a partition
        schema, folders = store.locations(name)
        full = f"{_ident(database)}.{_ident(name)}"
        there = spark.catalog.tableExists(full)
        if there and spark.catalog.getTable(full).tableType != "EXTERNAL":
            raise ValueError(f"{full} is a managed table or a view; it isn't replaced")
        parts = [p.partition("=")[0] for p in next(iter(folders), "").split("/") if p] or [c for c, _ in (partitioned or {}).get(name, [])]
        types = {f.name: f.dataType.simpleString() for f in schema.fields} | dict((partitioned or {}).get(name, []))
        data = [f.name for f in schema.fields if f.name not in parts]
        wanted = {c: types[c] for c in [*data, *parts]}
        location = store.path(name) if parts else next(iter(folders.values()))
        old = dict(spark.table(full).dtypes) if there else {}
        old_parts = [c.name for c in spark.catalog.listColumns(full) if c.isPartition] if there else []
        same = there and old_parts == parts and all(wanted.get(c) == t for c, t in old.items())
        if same:
            if added := [c for c in data if c not in old]:
                spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'{_ident(c)} {wanted[c]}' for c in added)})")
            spark.sql(f"ALTER TABLE {full} SET LOCATION {_literal(location)}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            columns = ", ".join(f"{_ident(c)} {t}" for c, t in wanted.items())
            by = f" PARTITIONED BY ({', '.join(map(_ident, parts))})" if parts else ""
            spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet{by} LOCATION {_literal(location)}")
        if parts:
            _sync_partitions(spark, full, folders, registered=same)
        spark.catalog.refreshTable(full)
    return list(names)


def _sync_partitions(spark: SparkSession, full: str, folders: dict[str, str], registered: bool) -> None:
    """Make the catalog's partitions those of ``folders`` (relative folder to location)."""
    known = [r[0] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()] if registered else []
    for part in known:
        if part not in folders:
            spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION ({_spec(part)})")
    for part, folder in folders.items():
        if part in known:
            spark.sql(f"ALTER TABLE {full} PARTITION ({_spec(part)}) SET LOCATION {_literal(folder)}")
    if new := [(p, f) for p, f in folders.items() if p not in known]:
        clauses = " ".join(f"PARTITION ({_spec(p)}) LOCATION {_literal(f)}" for p, f in new)
        spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS {clauses}")
