"""B1, B2, B3 (writer), B4 (writer), B5–B9: tables on shared storage.

Layout under one root::

    <root>/bronze/<source>
    <root>/silver/staging/stg_*
    <root>/silver/intermediate/{dim_*, fact_*}      fact_ratings partitioned by year
    <root>/gold/marts/{movie_analytics, user_behavior, genre_performance}
    <root>/gold/snapshots/snap_mart_*
    <root>/_notes/<table>/<version>.json

A table's Parquet files lie in folders of the writes that made them,
``<table>/_commit=<id>/[partition=value/...]``, and are never moved or changed.
A version of a table is a note: which folders make up each partition (without
which of their files, if a merge replaced some), the schema with every column
the table ever got, and its row counts.

A write is published by its note alone, in one step.  Before, nobody sees any
of it; after, all of it with its schema and counts.  A driver that dies leaves
files that no version names.  The note takes the next version's name only if
nobody has: of two writers that began at one version the second is refused
(``WriteConflict``) and its caller reads again.  Readers hold the files of the
version they began with, and change nothing.  ``vacuum`` removes, after a time,
what no longer belongs to the newest version.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reelhouse.operators import scd2 as scd2_ops
from reelhouse.operators import upsert as upsert_ops
from reelhouse.plans.files import Folders, stage
from reelhouse.session import ensure_session_defaults

# Where each table lives below the root.
LAYERS = {
    "stg_movies": "silver/staging", "stg_links": "silver/staging",
    "stg_ratings": "silver/staging", "stg_tags": "silver/staging",
    "dim_movies": "silver/intermediate", "dim_users": "silver/intermediate",
    "fact_ratings": "silver/intermediate", "fact_tags": "silver/intermediate",
    "fact_movie_genre_ratings": "silver/intermediate",
    "rollup_movies": "silver/intermediate", "rollup_users": "silver/intermediate",
    "rollup_genre_raters": "silver/intermediate", "rollup_user_genres": "silver/intermediate",
    "mart_movie_analytics": "gold/marts", "mart_user_behavior": "gold/marts",
    "mart_genre_performance": "gold/marts",
    "snap_mart_movie_analytics": "gold/snapshots", "snap_mart_user_behavior": "gold/snapshots",
    "snap_mart_genre_performance": "gold/snapshots",
}
FOLDERS = {t: t.removeprefix("mart_") for t in LAYERS if t.startswith("mart_")}
# The marts' folders, and partition columns.
PARTITIONED = {t: "year" for t in LAYERS if t == "fact_ratings" or t.startswith("rollup_")}
# Staging tables whose rows are written in order of time, so that row groups can be skipped.
CLUSTERED = {"stg_ratings": "created_at", "stg_tags": "created_at"}
# SCD2 histories are partitioned by is_current and the run that closed a row.
CLOSED_RUN = "closed_run"
COMMIT = "_commit"
#: A merge rewrites all of a partition's files once this share of them is to go.
REWRITE = 0.5


class WriteConflict(RuntimeError):
    """Another write was published since this one read the table."""


def run_label(ts: datetime) -> str:
    """Partition label of a snapshot run, e.g. ``20250101T000000Z``."""
    ts = _utc(ts)
    return ts.strftime("%Y%m%dT%H%M%S") + (f"{ts.microsecond:06d}" if ts.microsecond else "") + "Z"


def _utc(ts: datetime) -> datetime:
    return ts.replace(tzinfo=timezone.utc) if ts.tzinfo is None else ts.astimezone(timezone.utc)


def _label_time(label: str) -> datetime:
    """The clock in a run's label."""
    day, micros = re.match(r"(\d{8}T\d{6})(\d{6})?Z", label).groups()
    return datetime.strptime(day, "%Y%m%dT%H%M%S").replace(microsecond=int(micros or 0), tzinfo=timezone.utc)


@dataclass
class LoadReport:
    """What a materialisation reports."""
    table: str
    path: str
    row_count: int
    schema: str
    extra: dict = field(default_factory=dict)

    def as_dict(self) -> dict:
        return {"table": self.table, "path": self.path, "row_count": self.row_count,
                "schema": self.schema, **self.extra}


@dataclass
class Version:
    """A published state of a table.

    ``parts`` maps each partition's relative folder ("" for a table without)
    to ``in``, the writes whose files make it up, and ``gone``, the names of
    those of their files that don't belong to it any more.
    """
    number: int
    schema: StructType
    parts: dict[str, dict]
    row_count: int
    more: dict = field(default_factory=dict)

    def note(self) -> dict:
        return {"schema": json.loads(self.schema.json()), "parts": self.parts, "row_count": self.row_count, **self.more}


class TableStore:
    """Parquet tables under ``root`` (shared storage on a cluster)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = ensure_session_defaults(spark)
        self.root = root.rstrip("/")
        self.folders = Folders(spark)

    # -- versions ----------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{LAYERS.get(name, 'bronze')}/{FOLDERS.get(name, name)}"

    def _notes(self, name: str) -> str:
        return f"{self.root}/_notes/{name}"

    def version(self, name: str) -> Version | None:
        """The newest published version."""
        found = [n for n in self.folders.names(self._notes(name)) if re.fullmatch(r"\d+\.json", n)]
        if not found:
            return None
        note = self.folders.read_note(f"{self._notes(name)}/{found[-1]}")
        schema, parts, n = StructType.fromJson(note.pop("schema")), note.pop("parts"), note.pop("row_count")
        return Version(int(found[-1].removesuffix(".json")), schema, parts, n, note)

    def _publish(self, name: str, base: Version | None, schema: StructType, parts: dict[str, dict], row_count: int, **more) -> Version:
        new = Version(base.number + 1 if base else 1, schema, parts, row_count, more)
        if not self.folders.put_once(f"{self._notes(name)}/{new.number:012d}.json", new.note()):
            raise WriteConflict(f"{name}: version {new.number} was published by another write")
        return new

    def _folder(self, name: str, commit: str, part: str) -> str:
        return f"{self.path(name)}/{COMMIT}={commit}/{part}".rstrip("/")

    def _files(self, name: str, part: str, state: dict) -> dict[str, str]:
        """Name and path of a partition's files."""
        gone = set(state["gone"])
        return {f: f"{self._folder(name, c, part)}/{f}" for c in state["in"]
                for f in self.folders.data_files(self._folder(name, c, part)) if f not in gone}

    def _load(self, name: str, v: Version, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], v.schema)
        read = StructType([*v.schema.fields, StructField(COMMIT, StringType())])
        return self.spark.read.schema(read).option("basePath", self.path(name)).parquet(*paths)

    def rows(self, name: str, v: Version, parts: list[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its partitions."""
        paths = []
        for part in v.parts if parts is None else parts:
            state = v.parts[part]
            paths += list(self._files(name, part, state).values()) if state["gone"] else [self._folder(name, c, part) for c in state["in"]]
        return self._load(name, v, paths).select(*v.schema.names)

    def _write(self, name: str, df: DataFrame, by: list[str], *counts) -> tuple[str, list[str], dict]:
        """Write ``df`` to a folder of its own: (its id, its partitions, what was counted)."""
        commit, seen = uuid.uuid4().hex, Observation()
        folder = self._folder(name, commit, "")
        counts = [F.count(F.lit(1)).alias("n"), *counts]
        (df.observe(seen, *counts).write.partitionBy(*by) if by else df.observe(seen, *counts).write).parquet(folder)
        parts = [""]
        for _ in by:
            parts = [f"{p}/{n}".lstrip("/") for p in parts for n in self.folders.names(f"{folder}/{p}") if "=" in n]
        return commit, parts, seen.get

    def _adopt(self, name: str) -> Version | None:
        """The newest version; files of another program become one first."""
        v = self.version(name)
        if v is None and self.folders.has_data(self.path(name)):
            df = self.spark.read.option("mergeSchema", True).parquet(self.path(name))
            commit, parts, seen = self._write(name, df, self._by(name))
            v = self._publish(name, None, df.schema, {p: {"in": [commit], "gone": []} for p in parts}, int(seen["n"]))
        return v

    def _by(self, name: str) -> list[str]:
        return ["is_current", CLOSED_RUN] if self._is_snapshot(name) else [PARTITIONED[name]] if name in PARTITIONED else []

    # -- B5 / B7 ---------------------------------------------------------------
    def exists(self, name: str) -> bool:
        """Is there a published version, or data of another program?"""
        return self.version(name) is not None or self.folders.has_data(self.path(name))

    def _stored(self, name: str) -> DataFrame:
        v = self.version(name)
        if v is None:  # written by another program: every file's columns
            return self.spark.read.option("mergeSchema", True).parquet(self.path(name))
        return self.rows(name, v)

    def read(self, name: str) -> DataFrame:
        """The newest version (partition columns restored, evolved columns included)."""
        return self.read_history(name) if self._is_snapshot(name) else self._stored(name)

    def locations(self, name: str) -> tuple[StructType, dict[str, str]]:
        """The newest version's schema and the one folder of each partition; ``compact`` first if it has several."""
        v = self._adopt(name)
        if v is None:
            raise ValueError(f"{name}: no such table")
        if spread := [p for p, s in v.parts.items() if len(s["in"]) != 1 or s["gone"]]:
            raise ValueError(f"{name}: {spread[:5]} are not one folder each")
        return v.schema, {p: self._folder(name, s["in"][0], p) for p, s in v.parts.items()}

    # -- B1 / B2 / B6 ------------------------------------------------------------
    def full_refresh(self, name: str, df: DataFrame) -> LoadReport:
        """B1/B2: replace a table and report its row count, in one job.

        Staging tables keep their schema (B2): a changed one is refused.  A
        partitioned table's rows are rebalanced by partition, so that the files
        follow the data's size, not tasks x partitions.  Staged ratings and tags
        are written in order of time: a row group covers a short time, and a
        filter on years skips the others by their statistics.
        """
        base = self.version(name)
        if name.startswith("stg_") and base and _kinds(base.schema) != _kinds(df.schema):
            raise ValueError(f"{name}: schema differs from the stored table's")
        by = self._by(name)
        if order := CLUSTERED.get(name):
            df = df.repartitionByRange(order).sortWithinPartitions(order)
        commit, parts, seen = self._write(name, df.hint("rebalance", *by) if by else df, by)
        n = int(seen["n"])
        self._publish(name, base, df.schema, {p: {"in": [commit], "gone": []} for p in parts}, n)
        return LoadReport(name, self.path(name), n, schema_text(df))

    def append(self, name: str, df: DataFrame) -> LoadReport:
        """Add rows; a table that isn't there is created, a changed schema refused."""
        base = self._adopt(name)
        if base is None:
            return self.full_refresh(name, df)
        if _kinds(base.schema) != _kinds(df.schema):
            raise ValueError(f"{name}: schema differs from the stored table's")
        by = self._by(name)
        commit, parts, seen = self._write(name, df.hint("rebalance", *by) if by else df, by)
        n = int(seen["n"])
        self._publish(name, base, base.schema, _with(base.parts, commit, parts), base.row_count + n, **base.more)
        return LoadReport(name, self.path(name), base.row_count + n, schema_text(df), {"rows_touched": n})

    def replace_partitions(self, name: str, df: DataFrame, parts: list[str], **more) -> LoadReport:
        """Replace the partitions ``parts`` (relative folders) by the rows of ``df``, which are all theirs."""
        base, by = self._adopt(name), self._by(name)
        before = [p for p in parts if base and p in base.parts]
        gone = self.rows(name, base, before).count() if before else 0  # from the footers
        commit, made, seen = self._write(name, df.hint("rebalance", *by), by)
        if beyond := [p for p in made if p not in parts]:
            raise ValueError(f"{name}: rows of {beyond[:5]}, which aren't among the partitions replaced")
        total = (base.row_count if base else 0) - gone + int(seen["n"])
        kept = {p: s for p, s in base.parts.items() if p not in parts} if base else {}
        self._publish(name, base, df.schema, _with(kept, commit, made), total, **{**(base.more if base else {}), **more})
        return LoadReport(name, self.path(name), total, schema_text(df), {"rows_touched": int(seen["n"])})

    def compact(self, name: str) -> None:
        """Rewrite the partitions that lie in several folders or lost files, each into one folder."""
        v = self._adopt(name)
        spread = [p for p, s in v.parts.items() if len(s["in"]) != 1 or s["gone"]]
        if spread:
            by = self._by(name)
            rows = self.rows(name, v, spread)
            commit, parts, _ = self._write(name, rows.hint("rebalance", *by) if by else rows, by)
            kept = {p: s for p, s in v.parts.items() if p not in spread}
            self._publish(name, v, v.schema, _with(kept, commit, parts), v.row_count, **v.more)

    def vacuum(self, name: str, older_than: timedelta = timedelta(days=7)) -> list[str]:
        """Remove writes that the newest version doesn't name and older notes, once they're that old.

        What a reader of an older version, or a write that isn't published yet,
        may take longer than that would be lost.
        """
        v, gone = self.version(name), []
        if v is None:
            return gone
        held = {f"{COMMIT}={c}" for s in v.parts.values() for c in s["in"]}
        there = [f"{self.path(name)}/{n}" for n in self.folders.names(self.path(name)) if n.startswith(f"{COMMIT}=") and n not in held]
        notes = [f"{self._notes(name)}/{n}" for n in self.folders.names(self._notes(name)) if n != f"{v.number:012d}.json"]
        for path in there + notes:
            if self.folders.age(path) >= older_than.total_seconds():
                self.folders.remove(path)
                gone.append(path)
        return gone

    # -- B3 / B9 ---------------------------------------------------------------
    def merge_upsert(self, name: str, updates: DataFrame,
                     keys=upsert_ops.FACT_RATINGS_KEYS, years=None,
                     validate: bool = True) -> LoadReport:
        """Upsert ``updates`` into the year-partitioned table ``name``.

        ``year`` is a function of the key ``created_at`` (UTC pinned), so a
        match can only happen inside one year partition: only the partitions
        that the updates have rows in (a NULL year's too) are looked at, and of
        these only the files that hold a matching key are rewritten; rows that
        match none are new files.  Once half of a partition's files are to go,
        all of them are rewritten, so that few names are kept as gone.  The
        updates are evaluated once, into the shared checkpoint folder, which is
        emptied again after the commit.  The first load writes everything
        without de-duplication.  Updates equal in every column count as one
        where they match; different ones of a key that is there replace its rows
        if they are as many, and are refused otherwise.
        ``years`` names the partitions the caller means
        to touch; updates outside them are refused.
        """
        part, base = PARTITIONED.get(name, "year"), self._adopt(name)
        if base is None:
            report = self.full_refresh(name, updates)
            report.extra["rows_touched"] = report.row_count
            return report
        staged, where, touched = stage(updates, self.root)
        try:
            found = [r[0] for r in staged.select(part).distinct().collect()]  # as many as calendar years
            if years is not None and (beyond := [y for y in found if y not in set(years)]):
                raise ValueError(f"{name}: updates have rows of {sorted(beyond, key=str)}, which aren't among the years given")
            folders = {f"{part}={'__HIVE_DEFAULT_PARTITION__' if y is None else y}": y for y in found}
            there = {p: self._files(name, p, base.parts[p]) for p in folders if p in base.parts}
            hit = self._files_with(name, base, there, staged, list(keys))
            for p, files in there.items():
                before = sum(len(self.folders.data_files(self._folder(name, c, p))) for c in base.parts[p]["in"])
                if hit.get(p) and len(hit[p]) + before - len(files) >= REWRITE * before:
                    hit[p] = set(files)
            target = self._load(name, base, [there[p][f] for p, names in hit.items() for f in names]).select(*base.schema.names)
            alike, whole = self._repeated(target, staged, keys) if validate else (False, False)
            before = target.count()  # from the footers of the files touched
            merged = upsert_ops.upsert(target, staged, keys, alike, whole)
            merged = merged.select(*[c for c in merged.columns if c != part], part)
            commit, made, seen = self._write(name, merged.hint("rebalance", part), [part])
            after, parts = int(seen["n"]), {p: dict(s) for p, s in base.parts.items()}
            for p, names in hit.items():
                parts[p] = self._without(name, p, parts[p], names)
            total = base.row_count - before + after
            self._publish(name, base, merged.schema, _with(parts, commit, made), total, **base.more)
        finally:
            self.folders.remove(where)
        return LoadReport(name, self.path(name), total, schema_text(updates),
                          {"rows_touched": touched, "rows_in_rewritten_files": after,
                           "files_rewritten": sum(map(len, hit.values())),
                           "partitions": sorted(found, key=lambda y: (y is None, y))})

    def _files_with(self, name: str, v: Version, there: dict[str, dict[str, str]], updates: DataFrame, keys: list[str]) -> dict[str, set[str]]:
        """Per partition the names of the files that hold a key of the updates (at most the files there are)."""
        paths = [f for files in there.values() for f in files.values()]
        if not paths:
            return {}
        part = next(iter(there)).partition("=")[0]
        rows = self._load(name, v, paths).select(*keys, F.col(part).alias("__part"), F.col("_metadata.file_name").alias("__file"))
        hits = rows.join(updates.select(*keys), keys, "left_semi").select("__part", "__file").distinct().collect()
        out: dict[str, set[str]] = {}
        for value, file in hits:
            out.setdefault(f"{part}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}", set()).add(file)
        return out

    def _without(self, name: str, part: str, state: dict, names: set[str]) -> dict:
        """A partition's state once the files ``names`` are gone; writes without a file left are dropped."""
        gone, out = set(state["gone"]) | names, {"in": [], "gone": []}
        for c in state["in"]:
            files = self.folders.data_files(self._folder(name, c, part))
            if left := gone.intersection(files):
                if len(left) == len(files):
                    continue
                out["gone"] += sorted(left)
            out["in"].append(c)
        return out

    @staticmethod
    def _repeated(target: DataFrame, updates: DataFrame, keys) -> tuple[bool, bool]:
        """Do the updates repeat a key, and do they differ in one?  Where it's open which of them a target row gets they are refused."""
        keys = list(keys)
        # Cheap pass first: without duplicate keys among the updates no target
        # row can be matched twice.
        dup = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        if dup.isEmpty():
            return False, False
        differing = upsert_ops.differing_keys(updates, keys)
        if differing.isEmpty():
            return True, False
        bad = upsert_ops.open_keys(target, updates, differing, keys).select(*keys)
        if first := bad.take(5):
            raise ValueError("MERGE: a target row is matched by more than one update row; "
                             "first keys: " + str([tuple(r) for r in first]))
        return True, True

    # -- B4 --------------------------------------------------------------------
    def _is_snapshot(self, name: str) -> bool:
        return LAYERS.get(name) == "gold/snapshots"

    def read_history(self, name: str, current_only: bool = False) -> DataFrame:
        """An SCD2 history in its contract form (mart columns + valid_from,
        valid_to, is_current).  ``current_only`` reads one partition."""
        v = self.version(name)
        if v is None:
            df = self._stored(name)
            df = df.filter(F.col("is_current") == F.lit("true")) if current_only else df
        else:
            df = self.rows(name, v, [p for p in v.parts if not current_only or p.startswith("is_current=true")])
        return _contract(df)

    def snapshot(self, name: str, source: DataFrame, key: str, check_cols: list[str],
                 effective_ts: datetime | None = None) -> LoadReport:
        """Merge ``source`` into the SCD2 history table ``name``.

        The history is stored partitioned by ``(is_current, closed_run)``:
        current rows live in one partition, and the versions a run closes go to
        a partition of that run alone; its label is the run's clock and a random
        part, so no run, not even one with the same clock and a corrected
        source, ever replaces closed versions.  A run reads and replaces the
        current partition and adds its closed one: the cost follows the current
        rows and the changes, never the accumulated history.  A key that the
        source repeats is refused where a current row has it, as MERGE would
        refuse it.

        A run whose clock lies before the last one's is fitted in where it
        belongs (``scd2.late_merge``), as if the runs had come in order; it also
        reads and replaces what was closed after its clock.  A clock that an
        earlier run had, other than the last, is refused.
        """
        effective_ts = _utc(effective_ts or datetime.now(timezone.utc))
        tag = uuid.uuid4().hex[:8]
        base = self._adopt(name)
        clocks = sorted({*map(datetime.fromisoformat, base.more.get("runs", []))}) if base else []
        late = bool(clocks) and effective_ts < clocks[-1]
        if late and effective_ts in clocks:
            raise ValueError(f"{name}: a run of {effective_ts} is there, and later ones are")
        staged, where, _ = stage(source, self.root)
        try:
            replaced: list[str] = []
            if base is None:
                merged = scd2_ops.scd2_merge(None, staged, key, check_cols, effective_ts)
            else:
                replaced = [p for p in base.parts if _is_open(p) or late and _label_time(_closed_label(p)) > effective_ts]
                held = _contract(self.rows(name, base, replaced))
                current = held.filter("is_current")
                scd2_ops.assert_single_source_rows(current, staged, key)
                if late:
                    after = next(c for c in clocks if c > effective_ts)
                    merged = scd2_ops.late_merge(held, staged, key, check_cols, effective_ts, after)
                else:
                    merged = scd2_ops.scd2_merge(held, staged, key, check_cols, effective_ts)
            label = F.concat(F.date_format("valid_to", "yyyyMMdd'T'HHmmss"),
                             F.when(F.date_format("valid_to", "SSSSSS") != "000000", F.date_format("valid_to", "SSSSSS")).otherwise(""),
                             F.lit(f"Z-{tag}"))
            merged = merged.withColumn(CLOSED_RUN, F.when(~F.col("is_current"), label))
            commit, made, seen = self._write(name, merged, ["is_current", CLOSED_RUN], F.count_if(F.col("is_current")).alias("current"),
                                             F.count_if(F.col("valid_to") == F.lit(effective_ts)).alias("closed"))
            n, now = int(seen["n"]), int(seen["current"])
            before = self.rows(name, base, replaced).count() if replaced else 0  # from the footers
            total = (base.row_count if base else 0) - before + n
            kept = {p: s for p, s in base.parts.items() if p not in replaced} if base else {}
            schema = StructType([StructField(f.name, StringType() if f.name == "is_current" else f.dataType)
                                 for f in merged.schema.fields])
            self._publish(name, base, schema, _with(kept, commit, made), total, current_row_count=now,
                          runs=[c.isoformat() for c in sorted({*clocks, effective_ts})])
        finally:
            self.folders.remove(where)
        return LoadReport(name, self.path(name), total, schema_text(source),
                          {"current_row_count": now, "closed_this_run": int(seen["closed"]), "run": f"{run_label(effective_ts)}-{tag}"})


def _contract(history: DataFrame) -> DataFrame:
    return history.withColumn("is_current", F.col("is_current").cast("boolean")).drop(CLOSED_RUN)


def _is_open(part: str) -> bool:
    return part.startswith("is_current=true")


def _closed_label(part: str) -> str:
    return part.partition(f"{CLOSED_RUN}=")[2]


def _with(parts: dict[str, dict], commit: str, made: list[str]) -> dict[str, dict]:
    """``parts`` and the partitions that a write made."""
    out = {p: dict(s) for p, s in parts.items()}
    for p in made:
        state = out.get(p, {"in": [], "gone": []})
        out[p] = {"in": [*state["in"], commit], "gone": state["gone"]}
    return {p: s for p, s in out.items() if s["in"]}


def _kinds(schema: StructType) -> list[tuple[str, str]]:
    return sorted((f.name, f.dataType.simpleString()) for f in schema.fields)


def schema_text(df: DataFrame) -> str:
    return df.schema.simpleString()
