"""Snapshot tables on stock Parquet: immutable version folders, one pointer, a commit log.

A commit writes folder v<n+1> in full and then moves the table's LOCATION to it, which is the only step that readers
see. The log entry follows; a log that lags behind the pointer is recoverable, a pointer to a missing folder isn't. A
writer that finds the pointer moved since it read the table fails. One writer at a time is assumed beyond that.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterline.operators.sync import apply_changes, change_counts, plan_changes
from quarterline.schema import require_columns
from quarterline.sources import files

MARKER = "quarterline.snapshot"
_LOCK_SECONDS = 86_400
# Fixed value: what deletes may be derived from.
_SNAPSHOT = "persisted full snapshot table"


@dataclass(frozen=True)
class Commit:
    version: int
    operation: str
    inserted_rows: int
    updated_rows: int
    deleted_rows: int
    final_rows: int


def _details(spark: SparkSession, name: str, or_none: bool = False) -> dict[str, str] | None:
    """What the catalog says of a relation; None, if asked for, where it can't be looked up."""
    try:
        rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name}).collect()
    except Exception:
        if or_none:
            return None
        raise
    return {r["col_name"]: r["data_type"] for r in rows}


def _location(spark: SparkSession, name: str) -> str:
    return _details(spark, name)["Location"]


def guard_snapshot_table(spark: SparkSession, name: str, what: str) -> None:
    """ValueError unless the name is a table that this store manages; fails closed.

    Only tables that the store made carry its marker, so that is the one question; the answer for anything else says
    what was found instead.
    """
    found = _details(spark, name, or_none=True)
    if found is None:
        raise ValueError(f"{what}: {name} can't be looked up, so it isn't known to be a {_SNAPSHOT}")
    if f"{MARKER}=" not in found.get("Table Properties", ""):
        what_it_is = found.get("Type") or "temporary view"
        raise ValueError(f"{what}: {name} is no {_SNAPSHOT} of this store but a {what_it_is.lower()} ({found.get('Provider', 'no provider')})")


def read_table(spark: SparkSession, name: str, required, what: str) -> DataFrame:
    if not spark.catalog.tableExists(name):
        raise ValueError(f"{what} table does not exist: {name}")
    df = spark.table(name)
    require_columns(df.columns, required, f"{what} is missing required columns")
    return df


def _root(location: str) -> str:
    return location.rstrip("/").rpartition("/")[0]


def version(spark: SparkSession, name: str) -> int:
    return int(re.search(r"/v(\d+)/?$", _location(spark, name))[1])


def history(spark: SparkSession, name: str) -> list[Commit]:
    """Commits that reached the table, oldest first. A version whose log entry is missing isn't listed."""
    root, now = _root(_location(spark, name)), version(spark, name)
    entries = [n for n in files.names(spark, f"{root}/_log") if n.endswith(".json")]
    known = (Commit(**json.loads(files.read_text(spark, f"{root}/_log/{n}"))["commit"]) for n in entries)
    return sorted((c for c in known if c.version <= now), key=lambda c: c.version)


def read_version(spark: SparkSession, name: str, at: int) -> DataFrame:
    return spark.read.schema(spark.table(name).schema).parquet(f"{_root(_location(spark, name))}/v{at:08d}")


def _log(spark: SparkSession, root: str, commit: Commit) -> None:
    entry = json.dumps({"commit": commit.__dict__, "at": time.time()})
    files.write_text(spark, f"{root}/_log/{commit.version:08d}.json", entry)


def _rows(spark: SparkSession, path: str, schema) -> int:
    """Counted from the files that were written, not from the plan that wrote them."""
    return spark.read.schema(schema).parquet(path).count()


def _create(spark: SparkSession, name: str, source: DataFrame) -> Commit:
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = f"{base}/_snapshots/{re.sub(r'[^A-Za-z0-9_.]', '', name)}-{time.time_ns():x}"
    source.write.parquet(f"{root}/v00000001")
    rows = _rows(spark, f"{root}/v00000001", source.schema)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:name) ({columns}) USING parquet LOCATION '{root}/v00000001' TBLPROPERTIES ('{MARKER}' = '1')", args={"name": name}
    )
    commit = Commit(1, "CREATE", rows, 0, 0, rows)
    _log(spark, root, commit)
    return commit


def observed(observation: Observation) -> dict[str, int]:
    """Counts of an observation after its action. A part of a plan that turns out to be empty while it runs is dropped
    together with what observes it, and then there is nothing to tell."""
    try:
        return {k: v or 0 for k, v in observation.get.items()}
    except Py4JJavaError:
        return {}


def synchronize(spark: SparkSession, name: str, source: DataFrame, keys, material, delete_missing: bool) -> Commit:
    """Bring the table to the plan of plan_changes; creates it where it is absent.

    One action writes the new version and counts its changes. If nothing changed, the new folder is thrown away and
    the version stays.
    """
    if not spark.catalog.tableExists(name):
        return _create(spark, name, source)
    before = _location(spark, name)
    root, old, seen = _root(before), version(spark, name), Observation("changes")
    target = spark.table(name)
    plan = plan_changes(target, source, keys, material, delete_missing).observe(seen, F.count("*").alias("rows"), *change_counts())
    new = f"{root}/v{old + 1:08d}"
    files.delete(spark, new)  # left by a writer that died before its commit
    apply_changes(plan).write.parquet(new)
    counts = dict.fromkeys(("inserted_rows", "updated_rows", "deleted_rows"), 0) | observed(seen)
    counts.pop("rows", None)
    if not any(counts.values()):
        files.delete(spark, new)
        return Commit(old, "NONE", 0, 0, 0, _rows(spark, before, target.schema))
    if _location(spark, name) != before:
        files.delete(spark, new)
        raise RuntimeError(f"{name} was changed by another writer")
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET LOCATION '{new}'", args={"name": name})
    spark.catalog.refreshTable(name)
    commit = Commit(old + 1, "SYNC" if delete_missing else "UPSERT", final_rows=_rows(spark, new, target.schema), **counts)
    _log(spark, root, commit)
    return commit


def drop(spark: SparkSession, name: str) -> None:
    """The table and all its versions; nothing if it isn't there."""
    if spark.catalog.tableExists(name):
        root = _root(_location(spark, name))
        spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": name})
        files.delete(spark, root)


@contextmanager
def exclusive(spark: SparkSession, name: str) -> Iterator[None]:
    """One run at a time: RuntimeError while another holds the name. A lock left by a run that died is deleted by hand
    or, after a day, by the next run."""
    path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_locks/{re.sub(r'[^A-Za-z0-9_.]', '', name)}"
    if files.exists(spark, path) and time.time() - float(files.read_text(spark, path)) > _LOCK_SECONDS:
        files.delete(spark, path)
    if not files.write_text(spark, path, str(time.time())):
        raise RuntimeError(f"another run is at work on {name} ({path})")
    try:
        yield
    finally:
        files.delete(spark, path)


def vacuum(spark: SparkSession, name: str, keep: int = 2) -> list[str]:
    """Delete all but the newest versions; returns the folders that went."""
    root, now = _root(_location(spark, name)), version(spark, name)
    old = [n for n in files.names(spark, root) if re.fullmatch(r"v\d{8}", n) and not now - keep < int(n[1:]) <= now]
    for n in old:
        files.delete(spark, f"{root}/{n}")
    return old
