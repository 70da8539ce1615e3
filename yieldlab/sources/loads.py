"""Loads that take effect whole or not at all, with declared constraints
checked while the rows are written.

``load_table`` replaces a table: rows go to a version folder of their own, and
readers see it once its marker file is there. ``load_days`` replaces the days
that the load brings and no others: rows are staged by day, marked, and the
day folders moved into the table. A load that fails or is killed before its
marker leaves the old rows; one that is killed while its folders are moved is
finished by ``finish_loads``, which the next load calls first.

Constraints on single rows (required columns, conditions) are counted by an
``Observation`` in the writing stage, so they cost no scan. Keys and parents
need other rows: they are checked on the written files, of which only the key
columns are read. With ``on_violation="fail"`` a violation raises
``LoadRejected`` and the load never shows; with ``"report"`` the counts come
back with the load.

Loads of one table are written one after another. Folders are renamed, so the
file system must be one where a rename is a single step (HDFS and the like).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import DATE_PART

MARKER = "_PUBLISHED"
STAGED = "_loads"  # readers skip names that begin with an underscore


@dataclass(frozen=True)
class Checks:
    """What rows must fulfil. ``required`` columns have no NULL; each of
    ``conditions`` isn't false (NULL passes, as in SQL); no two rows share a
    whole ``key``; ``parent_key`` of every row is NULL or in ``parent``, a
    table with a column of that name."""

    required: Sequence[str] = ()
    conditions: Mapping[str, Column] = field(default_factory=dict)
    key: Sequence[str] = ()
    parent: DataFrame | None = None
    parent_key: str | None = None


@dataclass(frozen=True)
class LoadReport:
    folder: str
    n_rows: int
    violations: dict[str, int]

    @property
    def clean(self) -> bool:
        return not any(self.violations.values())


class LoadRejected(ValueError):
    def __init__(self, report: LoadReport):
        broken = ", ".join(f"{k}: {v}" for k, v in report.violations.items() if v)
        super().__init__(f"load of {report.n_rows} rows rejected ({broken})")
        self.report = report


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _fs(spark, path)
    return fs.exists(folder)


def _delete(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    fs.delete(folder, True)


def _mark(spark: SparkSession, folder: str) -> None:
    fs, marker = _fs(spark, f"{folder}/{MARKER}")
    fs.create(marker, False).close()


def _checked_write(df: DataFrame, folder: str, checks: Checks, day_col: str | None, on_violation: str) -> LoadReport:
    """Write ``df`` to ``folder`` and count what breaks ``checks``."""
    if on_violation not in ("fail", "report"):
        raise ValueError("on_violation is fail or report")
    spark = df.sparkSession
    counts = [F.count(F.lit(1)).alias("n_rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in checks.required]
    counts += [F.count_if(~F.coalesce(c, F.lit(True))).alias(f"broken_{name}") for name, c in checks.conditions.items()]
    out = df
    if day_col:
        out = df.withColumn(DATE_PART, F.to_date(day_col)).hint("rebalance", F.col(DATE_PART))
    # The counts sit above the shuffle, in the writing stage: each of its tasks
    # counts once, however often a map task is run again.
    seen = Observation()
    writer = out.observe(seen, *counts).write.mode("overwrite")
    (writer.partitionBy(DATE_PART) if day_col else writer).parquet(folder)
    found = seen.get
    n_rows = int(found.get("n_rows", 0))
    violations = {c: int(found.get(c, 0)) for c in [f"null_{c}" for c in checks.required] + [f"broken_{c}" for c in checks.conditions]}
    written = spark.read.schema(out.schema).parquet(folder)
    if checks.key:
        key = list(checks.key)
        whole = written.select(*key).dropna()
        extra = whole.groupBy(*key).count().agg(F.sum(F.col("count") - 1)).first()[0]
        violations["duplicate_key"] = int(extra or 0)
    if checks.parent is not None:
        child = written.select(checks.parent_key).dropna()
        violations["orphan"] = child.join(checks.parent.select(checks.parent_key), checks.parent_key, "left_anti").count()
    report = LoadReport(folder, n_rows, violations)
    if on_violation == "fail" and not report.clean:
        _delete(spark, folder)
        raise LoadRejected(report)
    return report


# ---- whole tables ---------------------------------------------------------------


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published versions, oldest first."""
    names = [n for n in _names(spark, path) if n.startswith("version=")]
    return [f"{path}/{n}" for n in names if _exists(spark, f"{path}/{n}/{MARKER}")]


def load_table(df: DataFrame, path: str, checks: Checks = Checks(), on_violation: str = "fail") -> LoadReport:
    """Write ``df`` as the new version of the table. It may be made from the
    version that it replaces. Earlier versions stay until ``drop_versions``."""
    spark = df.sparkSession
    taken = [int(n.split("=")[1].split("-")[0]) for n in _names(spark, path) if n.startswith("version=")]
    folder = f"{path}/version={max(taken, default=0) + 1:012d}-{uuid.uuid4().hex[:8]}"
    report = _checked_write(df, folder, checks, None, on_violation)
    _mark(spark, folder)
    return report


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version."""
    published = versions(spark, path)
    if not published:
        raise FileNotFoundError(f"no published version in {path}")
    return spark.read.parquet(published[-1])


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest ``keep`` published versions, and what failed
    loads left behind; gives the number of folders deleted. Readers of a
    deleted version fail, so keep as many as are in use."""
    if keep < 1:
        raise ValueError("keep at least one version")
    kept = set(versions(spark, path)[-keep:])
    gone = [f"{path}/{n}" for n in _names(spark, path) if n.startswith("version=") and f"{path}/{n}" not in kept]
    for folder in gone:
        _delete(spark, folder)
    return len(gone)


# ---- days of a table --------------------------------------------------------------


def load_days(
    df: DataFrame, path: str, day_col: str = "Timestamp", checks: Checks = Checks(), on_violation: str = "fail"
) -> LoadReport:
    """Replace the days that ``df`` has rows of; rows without a time are a
    day of their own. The table is partitioned by ``Production_Date``, and
    ``df`` must not be read from the table's folders it replaces."""
    spark = df.sparkSession
    finish_loads(spark, path)
    folder = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    report = _checked_write(df, folder, checks, day_col, on_violation)
    _mark(spark, folder)
    finish_loads(spark, path)
    return report


def finish_loads(spark: SparkSession, path: str) -> None:
    """Move the days of marked loads into the table and delete unmarked ones.
    Each day is one rename after the old folder's deletion, and a day that was
    moved is no longer staged, so it can be repeated after any interruption.
    The loop is over days, whatever the number of rows."""
    for name in _names(spark, f"{path}/{STAGED}"):
        staged = f"{path}/{STAGED}/{name}"
        if _exists(spark, f"{staged}/{MARKER}"):
            for day in [n for n in _names(spark, staged) if n.startswith(f"{DATE_PART}=")]:
                _delete(spark, f"{path}/{day}")
                fs, source = _fs(spark, f"{staged}/{day}")
                if not fs.rename(source, _fs(spark, f"{path}/{day}")[1]):
                    raise OSError(f"{staged}/{day} could not be moved")
        _delete(spark, staged)


def read_days(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The table, with ``Production_Date`` for pruning. ``schema`` saves
    reading a footer."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
