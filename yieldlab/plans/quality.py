"""Data-quality checks that replace the reference's declared keys: row
counts, duplicate keys and NULLs in required columns, and orphans (rows whose
unit is missing from the production log)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# table -> (key columns, required columns), as declared by the reference DDL
DECLARED_KEYS = {
    "production_logs": (["Wafer_ID"], ["Wafer_ID", "Timestamp", "Label"]),
    "ml_predictions": (["Wafer_ID"], ["Wafer_ID"]),
    "root_cause_analysis": (["Wafer_ID", "Rank"], ["Wafer_ID", "Sensor_Name", "SHAP_Value", "Rank"]),
}
FOREIGN_KEYS = {
    "ml_predictions": ("Wafer_ID", "production_logs", "Wafer_ID"),
    "root_cause_analysis": ("Wafer_ID", "production_logs", "Wafer_ID"),
}


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    )


def key_violations(
    tables: Mapping[str, DataFrame], declared: Mapping = DECLARED_KEYS
) -> DataFrame:
    """One row per (table, check): ``duplicate_key`` = rows with a whole key
    minus distinct keys, ``null_<col>`` = NULLs in a required column."""
    parts = []
    for name, df in tables.items():
        if name not in declared:
            continue
        keys, required = declared[name]
        whole = F.lit(True)
        for k in keys:
            whole = whole & F.col(k).isNotNull()
        aggs = [
            (F.count_if(whole) - F.count_distinct(*[F.col(k) for k in keys])).alias(
                "duplicate_key"
            )
        ] + [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
        checks = ["duplicate_key"] + [f"null_{c}" for c in required]
        stacked = ", ".join(f"'{c}', `{c}`" for c in checks)
        parts.append(
            df.agg(*aggs).select(
                F.lit(name).alias("table_name"),
                F.expr(f"stack({len(checks)}, {stacked}) AS (check_name, n_violations)"),
            )
        )
    return _union(parts).withColumn("n_violations", F.col("n_violations").cast("long"))


def orphan_rows(tables: Mapping[str, DataFrame], foreign: Mapping = FOREIGN_KEYS) -> DataFrame:
    """Rows whose reference key has no parent row (anti join per table)."""
    parts = []
    for name, (col, parent, parent_col) in foreign.items():
        if name not in tables or parent not in tables:
            continue
        child = tables[name]
        par = tables[parent].select(F.col(parent_col).alias(col))
        orphans = child.join(par, col, "left_anti")
        parts.append(
            orphans.agg(F.count(F.lit(1)).alias("n_orphans")).select(
                F.lit(name).alias("table_name"), "n_orphans"
            )
        )
    return _union(parts)


def smoke_test(spark, view_names: Sequence[str], preview: int = 3) -> DataFrame:
    """Each registered view answers a ``LIMIT preview`` query; one row per
    view with its column count and the number of preview rows."""
    rows = []
    for name in view_names:
        df = spark.table(name)
        rows.append((name, len(df.columns), len(df.limit(preview).collect())))
    return spark.createDataFrame(rows, "view_name string, n_columns int, preview_rows int")
