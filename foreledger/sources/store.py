"""Partitioned Parquet tables whose every load is published at once, by a manifest.

A load writes its rows into new folders, one per partition value it touches, and
then publishes one manifest that names the folders of all partitions. Readers
resolve through the newest manifest, so during and after a failed load they see the
old state whole; what a failed load left behind is named by no manifest. Files are never
changed, so a load may read the very table it replaces. Two loads that start from the
same manifest cannot both publish: the second one fails with `ConcurrentLoad`.

A manifest also keeps, per partition, the number of rows and the least and greatest
value of each date and time column, taken from the load's own rows. Watermarks and the
choice of partitions come from there, without reading data.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD = "_fl_load"  # the folder level of a load, below the partition value
_MANIFESTS = "_manifests"
_KEEP = 10
_TIMES = (T.TimestampNTZType, T.TimestampType, T.DateType)


class ConcurrentLoad(RuntimeError):
    """Another load has published since this one read the table's state."""


class SchemaChanged(ValueError):
    """Raised under the `fail` policy when a load would change the table's columns."""


@dataclass(frozen=True)
class Part:
    """The folder of one partition value, and what is known of its rows."""

    folder: str
    rows: int
    low: dict[str, str]
    high: dict[str, str]


@dataclass(frozen=True)
class Snapshot:
    """One published state of a table. `parts` is keyed by partition value as text."""

    version: int
    schema: T.StructType
    by: str | None
    parts: dict[str, Part]
    # version of the table this one was derived from, where a load says so
    source_version: int | None = None

    def newest(self, column: str) -> dt.datetime | dt.date | None:
        """Greatest value of a date or time column."""
        found = [p.high[column] for p in self.parts.values() if p.high.get(column)]
        return _value(max(found), self.schema[column].dataType) if found else None

    def changed_since(self, older: Snapshot | None) -> list[str]:
        """Partition values whose rows are not those of `older`."""
        before = older.parts if older else {}
        keys = self.parts.keys() | before.keys()
        return sorted(k for k in keys if self.parts.get(k) != before.get(k))


def _value(text: str, kind: T.DataType) -> dt.datetime | dt.date:
    return dt.date.fromisoformat(text) if isinstance(kind, T.DateType) else dt.datetime.fromisoformat(text)


class _Files:
    """The few file operations of a driver, through the file system of the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(conf)
        # qualified, so that a path without scheme means the same file system
        self.root = self.fs.makeQualified(self.root)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name) if name else self.root

    def names(self, folder: str) -> list[str]:
        where = self.at(folder)
        return [f.getPath().getName() for f in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """Write a file under its name only when whole, and only if there is none yet."""
        own = self.at(f"{_MANIFESTS}/.{uuid.uuid4().hex}")
        out = self.fs.create(own)
        out.write(bytearray(text.encode()))
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 0)
        try:
            self.context.rename(own, self.at(name), options)
        except Exception as error:
            self.fs.delete(own, False)
            if "FileAlreadyExists" in str(error):
                raise ConcurrentLoad(f"{self.at(name)} is there already") from error
            raise

    def drop(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _versions(files: _Files) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names(_MANIFESTS) if n.endswith(".json"))


def _load(files: _Files, version: int) -> Snapshot:
    held = json.loads(files.read(f"{_MANIFESTS}/{version:010d}.json"))
    parts = {k: Part(**p) for k, p in held["parts"].items()}
    schema = T.StructType.fromJson(held["schema"])
    return Snapshot(version, schema, held["by"], parts, held["source_version"])


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest published state of a table, or that of `version`; None if there is none."""
    files = _Files(spark, path)
    there = _versions(files)
    if not there or (version is not None and version not in there):
        return None
    return _load(files, there[-1] if version is None else version)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been published there."""
    return bool(_versions(_Files(spark, path)))


def read_snapshot(
    spark: SparkSession, path: str, state: Snapshot, only: list[str] | None = None
) -> DataFrame:
    """The rows of a state, or of its partitions `only`."""
    chosen = state.parts.values() if only is None else [state.parts[k] for k in only if k in state.parts]
    if not chosen:
        return spark.createDataFrame([], state.schema)
    folders = [f"{path.rstrip('/')}/{p.folder}" for p in chosen]
    rows = spark.read.schema(state.schema).option("basePath", path).parquet(*folders)
    return rows.select(*state.schema.names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as last published."""
    state = snapshot(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_snapshot(spark, path, state)


def newest_partitions(state: Snapshot, limit: int) -> list[str]:
    """As many partitions, the newest first, as hold `limit` rows; their order is that of the text."""
    chosen, rows = [], 0
    for key in sorted((k for k in state.parts if k != "__null__"), reverse=True):
        if rows >= limit:
            break
        chosen.append(key)
        rows += state.parts[key].rows
    return chosen if rows >= limit else list(state.parts)


def read_newest(spark: SparkSession, path: str, order: str, limit: int) -> DataFrame:
    """The last `limit` rows of a table partitioned by the day of `order`, newest first.

    Only the partitions that can hold them are read, by the row counts of the manifest.
    """
    state = snapshot(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    rows = read_snapshot(spark, path, state, newest_partitions(state, limit))
    return rows.orderBy(F.col(order).desc()).limit(limit)


def spread_by(df: DataFrame, by: str) -> DataFrame:
    """Few files per partition value, without one task for a hot value: AQE splits it."""
    return df.hint("rebalance", by)


def _write(df: DataFrame, path: str, by: str | None, audit=None) -> dict[str, Part]:
    """Write the rows into folders of their own and describe them.

    An `operators.audit.Audit` counts its tests in the same pass, and may stop the load here.
    """
    load = f"l{uuid.uuid4().hex}"
    out = spread_by(df, by) if by else df
    if audit:
        out = audit.watch(out)
    layout = [by, LOAD] if by else [LOAD]
    out.withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(*layout).parquet(path)
    if audit:
        audit.settle(df.sparkSession)

    files = _Files(df.sparkSession, path)
    if not files.fs.globStatus(files.at(f"{by}=*/{LOAD}={load}" if by else f"{LOAD}={load}")):
        return {}
    pattern = f"{path.rstrip('/')}/" + (f"{by}=*/" if by else "") + f"{LOAD}={load}"
    written = df.sparkSession.read.schema(df.schema).option("basePath", path).parquet(pattern)
    times = [f.name for f in df.schema if isinstance(f.dataType, _TIMES)]
    file = F.col("_metadata.file_path")
    folder = F.min(F.regexp_replace(file, "/[^/]*$", "")).alias("folder")
    bounds = [
        pick(F.col(c)).cast("string").alias(f"{name}_{k}")
        for k, c in enumerate(times)
        for name, pick in (("low", F.min), ("high", F.max))
    ]
    key = F.col(by).cast("string").alias("key") if by else F.lit("").alias("key")
    found = written.groupBy(key).agg(folder, F.count(F.lit(1)).alias("rows"), *bounds)
    parts = {}
    for row in found.collect():  # a row per partition value
        levels = row["folder"].split("/")[-len(layout) :]
        low, high = ({c: row[f"{n}_{k}"] for k, c in enumerate(times)} for n in ("low", "high"))
        parts[row["key"] if row["key"] is not None else "__null__"] = Part(
            "/".join(levels), row["rows"], low, high
        )
    return parts


def _publish(
    spark: SparkSession, path: str, before: Snapshot | None, schema, by, parts, source_version
) -> Snapshot:
    files = _Files(spark, path)
    version = before.version + 1 if before else 1
    body = {
        "schema": schema.jsonValue(),
        "by": by,
        "parts": {k: vars(p) for k, p in sorted(parts.items())},
        "source_version": source_version,
    }
    files.put_new(f"{_MANIFESTS}/{version:010d}.json", json.dumps(body))
    return Snapshot(version, schema, by, parts, source_version)


def rebuild(
    df: DataFrame,
    path: str,
    by: str | None = None,
    source_version: int | None = None,
    audit=None,
) -> Snapshot:
    """Full refresh: publish these rows as the whole table."""
    spark = df.sparkSession
    before = snapshot(spark, path)
    return _publish(spark, path, before, df.schema, by, _write(df, path, by, audit), source_version)


def replace_partitions(
    df: DataFrame,
    path: str,
    by: str,
    policy: str = "fail",
    source_version: int | None = None,
    audit=None,
) -> Snapshot:
    """Publish the table with the partitions that occur in `df` replaced by its rows.

    `policy` decides over changed columns: `fail`, or `sync_all_columns`, which gives the
    other partitions NULL in added columns and hides dropped ones. No row is rewritten
    for that; a column that changes its type always fails.
    """
    spark = df.sparkSession
    before = snapshot(spark, path)
    if before is None or before.by != by:
        raise ValueError(f"no table partitioned by {by} at {path}")
    check_columns(before.schema, df.schema, policy)
    parts = before.parts | _write(df, path, by, audit)
    return _publish(spark, path, before, df.schema, by, parts, source_version)


def check_columns(have: T.StructType, want: T.StructType, policy: str) -> None:
    """Raise where the policy does not let a table's columns become those of a load."""
    old, new = ({f.name: f.dataType for f in s} for s in (have, want))
    changed = sorted(n for n in old.keys() | new.keys() if old.get(n) != new.get(n))
    if policy not in ("fail", "sync_all_columns"):
        raise ValueError(f"unknown schema change policy: {policy}")
    retyped = [n for n in changed if n in old and n in new]
    if retyped or (changed and policy == "fail"):
        raise SchemaChanged(f"columns differ: {', '.join(retyped or changed)}")


def touched_partitions(table: DataFrame, batch: DataFrame, by: str) -> DataFrame:
    """Rows of `table` in the partitions the batch falls into.

    A semi join on the partition column: the scan is pruned at run time to
    those partitions.
    """
    return table.join(batch.select(by).distinct(), by, "left_semi")


def vacuum(spark: SparkSession, path: str, keep: int = _KEEP) -> int:
    """Delete the folders that none of the last `keep` states names, and older manifests.

    For times without running loads: a load that has not published yet is not known here.
    """
    files = _Files(spark, path)
    there = _versions(files)
    kept = {p.folder for v in there[-keep:] for p in _load(files, v).parts.values()}
    gone = 0
    for name in files.names(""):
        inner = [f"{name}/{n}" for n in files.names(name)] if "=" in name and not name.startswith(LOAD) else [name]
        for folder in inner:
            if f"{LOAD}=" in folder and folder not in kept:
                files.drop(folder)
                gone += 1
    for version in there[:-keep]:
        files.drop(f"{_MANIFESTS}/{version:010d}.json")
    return gone


def materialize_as(
    df: DataFrame, name: str, how: str, path: str, by: str | None = None, audit=None
):
    """Give a layer its form: `view`, `table` (rewritten) or `incremental` (partitions replaced)."""
    spark = df.sparkSession
    if how == "view":
        df.createOrReplaceTempView(name)
        return df
    if how == "incremental" and by and exists(spark, path):
        replace_partitions(df, path, by, audit=audit)
    elif how in ("table", "incremental"):
        rebuild(df, path, by, audit=audit)
    else:
        raise ValueError(f"unknown form: {how}")
    stored = read(spark, path)
    stored.createOrReplaceTempView(name)
    return stored
