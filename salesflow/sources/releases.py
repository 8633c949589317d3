"""Monthly tables that are replaced as one: versions named by a manifest.

    <path>/data/<table>/<month column>=<month>/run=<id>/*.parquet
    <path>/manifests/<version>.json

Every run writes its months to folders of its own. Nothing changes for readers until a new manifest
appears, by one rename that fails where the version is taken already: so any number of tables, the
report and the history say, are replaced together or not at all, and of two runs that started from
one version only the first is published. A run that dies in between leaves folders that no manifest
names. A reader pins a version, the newest by default, and is never disturbed by later runs.

The manifest lists for every table the folder and schema of each month, so no folder is listed and no
file opened to read them; a month that came out empty is an entry without a folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from salesflow.functions import named
from salesflow.operators.shape import stack_months
from salesflow.session import remove_folder


class VersionTaken(RuntimeError):
    """Another run has published the version in the meantime."""


@dataclass
class MonthFiles:
    """Where a month's rows lie, and their schema; no folder where it has none."""

    folder: str | None
    schema: str | None


@dataclass
class TableMonths:
    """The months of one table, written but not published."""

    table: str
    month_col: str
    months: dict[str, MonthFiles]


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _found(spark: SparkSession, pattern: str) -> list[str]:
    at, system = _files(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(at) or [])


def versions(spark: SparkSession, path: str) -> list[int]:
    """The published versions, oldest first."""
    return [int(f.rsplit("/", 1)[1].removesuffix(".json")) for f in _found(spark, f"{path}/manifests/[0-9]*.json")]


def _manifest(spark: SparkSession, path: str, version: int) -> dict[str, TableMonths]:
    at, system = _files(spark, f"{path}/manifests/{version:010d}.json")
    stream = system.open(at)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {
        name: TableMonths(name, t["month_col"], {m: MonthFiles(**f) for m, f in t["months"].items()})
        for name, t in json.loads(text).items()
    }


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[str, TableMonths]:
    """What a version, the newest by default, holds; nothing where none was published."""
    if version is None:
        known = versions(spark, path)
        return _manifest(spark, path, known[-1]) if known else {}
    return _manifest(spark, path, version)


def write_months_aside(
    df: DataFrame, path: str, table: str, month_col: str, months: Sequence[str] | None = None, sort: Sequence[str] = ()
) -> TableMonths:
    """Write the rows' months to new folders, for ``publish``; readers see nothing of it yet.

    ``months`` names those that are being rebuilt: one without rows becomes an entry without a
    folder. A month that holds most of the rows is written by many tasks.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    data = f"{path.rstrip('/')}/data/{table}"
    rows = df.withColumns({month_col: named(month_col).cast("string"), "run": F.lit(run)})
    spread = rows.hint("rebalance", month_col)
    ordered = spread.sortWithinPartitions(*[named(c) for c in sort]) if sort else spread
    ordered.write.mode("append").partitionBy(month_col, "run").parquet(data)
    schema = StructType([f for f in df.schema.fields if f.name != month_col]).json()
    written = {_month_of(f): MonthFiles(f"{table}/{'/'.join(f.rsplit('/', 2)[1:])}", schema) for f in _found(spark, f"{data}/*/run={run}")}
    empty = {m: MonthFiles(None, None) for m in months or () if m not in written}
    return TableMonths(table, month_col, {**empty, **written})


def _month_of(folder: str) -> str:
    return unquote(folder.rsplit("/", 2)[1].split("=", 1)[1])


def publish(spark: SparkSession, path: str, *tables: TableMonths, base: int | None = None) -> int:
    """Replace the given months of all given tables at once; other months and tables stay.

    ``base`` is the version that the run started from, by default the newest; if another run
    has published since, nothing changes and ``VersionTaken`` is raised. Returns the version.
    """
    path = path.rstrip("/")
    if base is None:
        base = (versions(spark, path) or [0])[-1]
    now = manifest(spark, path, base) if base else {}
    for made in tables:
        old = now.get(made.table)
        if old is not None and old.month_col != made.month_col:
            raise ValueError(f"{made.table} is stored by {old.month_col}")
        now[made.table] = TableMonths(made.table, made.month_col, {**(old.months if old else {}), **made.months})
    text = json.dumps({name: asdict(t) for name, t in sorted(now.items())}, indent=1)
    draft, system = _files(spark, f"{path}/manifests/.draft-{uuid.uuid4().hex}")
    stream = system.create(draft)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    draft, target = (system.makeQualified(p) for p in (draft, _files(spark, f"{path}/manifests/{base + 1:010d}.json")[0]))
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    try:  # a rename that does not replace what is there
        context.rename(draft, target, spark.sparkContext._gateway.new_array(rename, 0))
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise VersionTaken(f"version {base + 1} of {path} is published already") from None
        raise
    return base + 1


def read_months(
    spark: SparkSession, path: str, table: str, version: int | None = None, months: Sequence[str] | None = None,
    date_cols: Sequence[str] = (),
) -> DataFrame:
    """A table of one version, its months stacked under a common schema; only ``months`` if given.

    Months of equal schema are read together, and a filter on the month column skips folders.
    """
    known = manifest(spark, path, version)
    if table not in known:
        raise ValueError(f"no table {table} in {path}")
    return read_aside(spark, path, known[table], months, date_cols)


def read_aside(
    spark: SparkSession, path: str, entry: TableMonths, months: Sequence[str] | None = None, date_cols: Sequence[str] = ()
) -> DataFrame:
    """A table's months as its entry lists them, whether it is published yet or not."""
    groups: dict[str, list[str]] = {}
    for month, files in entry.months.items():
        if files.folder is not None and (months is None or month in months):
            groups.setdefault(files.schema, []).append(f"{path.rstrip('/')}/data/{files.folder}")
    if not groups:
        schemas = [f.schema for f in entry.months.values() if f.schema] or [StructType([]).json()]
        return spark.createDataFrame([], _with_month(schemas[0], entry.month_col)).drop("run")
    reader = spark.read.option("basePath", f"{path.rstrip('/')}/data/{entry.table}")
    parts = [reader.schema(_with_month(schema, entry.month_col)).parquet(*folders).drop("run") for schema, folders in groups.items()]
    return stack_months(parts, date_cols)


def _with_month(schema: str, month_col: str) -> StructType:
    fields = StructType.fromJson(json.loads(schema)).fields
    return StructType([*fields, StructField(month_col, StringType()), StructField("run", StringType())])


def drop_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions and every folder that none of these names,
    those of runs that died included; returns the versions removed.

    Not to be run while another run writes: its folders are not yet named either.
    """
    path = path.rstrip("/")
    known = versions(spark, path)
    gone = known[: max(0, len(known) - max(keep, 1))]
    kept = [_manifest(spark, path, v) for v in known if v not in gone]
    for version in gone:
        remove_folder(spark, f"{path}/manifests/{version:010d}.json")
    named_folders = {f.folder for tables in kept for t in tables.values() for f in t.months.values()}
    for folder in _found(spark, f"{path}/data/*/*/run=*"):
        if "/".join(folder.rsplit("/", 3)[1:]) not in named_folders:
            remove_folder(spark, folder)
    return gone
