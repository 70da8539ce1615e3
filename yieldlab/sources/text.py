"""Text sources: whitespace sensor matrices and label/time lines.

Files are read with ``spark.read.text`` (splittable, parallel). The row
position that the reference takes from file order is rebuilt from
``(file path, split start, monotonically_increasing_id)`` and turned into a
dense index with ``ordering.global_index``: no single task ever sees the
whole file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.columns import MISSING_TOKENS, missing_to_null, parse_timestamp_any, recode_label
from ..operators.ordering import IDX, global_index

WHITESPACE = r"\s+"


def _strip(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` only removes
    spaces, so a leading tab would create an empty first token)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def resolve_path(spark: SparkSession, *candidates: str) -> str:
    """First candidate that exists (checked through the data source, so it
    works for any file system the session can read); else the first one."""
    for path in candidates:
        try:
            spark.read.text(path).schema  # noqa: B018 - raises when missing
            return path
        except AnalysisException:
            continue
    return candidates[0]


def read_lines(
    spark: SparkSession, path: str | Sequence[str], row_col: str = "row_idx", header: bool = False
) -> DataFrame:
    """Non-empty lines with their 0-based position in file order;
    ``header=True`` drops the first of each file."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"),
    )
    raw = raw.filter(F.length(_strip(F.col("value"))) > 0)
    if header:
        first = raw.filter(F.col("_b") == 0).groupBy("_f").agg(F.min("_m").alias("_m"))
        raw = raw.join(first, ["_f", "_m"], "left_anti")
    indexed, _ = global_index(raw, ["_f", "_b", "_m"])
    return indexed.select(F.col(IDX).alias(row_col), "value")


def parse_sensor_lines(
    lines: DataFrame, value_col: str = "value", delimiter: str = WHITESPACE
) -> DataFrame:
    """Add ``features ARRAY<DOUBLE>``: tokens split on ``delimiter``; NaN,
    NA, empty and unreadable tokens become NULL."""
    tokens = F.split(_strip(F.col(value_col)), delimiter)
    return lines.withColumn("features", F.transform(tokens, lambda t: missing_to_null(t)))


def features_to_long(
    df: DataFrame, id_cols: Sequence[str], features_col: str = "features"
) -> DataFrame:
    """``features`` array -> one row per sensor (1-based ``sensor_no``)."""
    x = df.select(*id_cols, F.posexplode(features_col).alias("_pos", "value"))
    return x.select(*id_cols, (F.col("_pos") + 1).cast("int").alias("sensor_no"), "value")


def load_sensor_text(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str = WHITESPACE,
    header: bool = False,
    long: bool = True,
    layout: str | None = None,
) -> DataFrame:
    """Sensor matrix text -> one of three layouts:

    * ``"long"`` (default): ``row_idx, sensor_no, value``;
    * ``"array"`` (or ``long=False``): ``row_idx, features ARRAY<DOUBLE>``;
    * ``"wide"``: ``row_idx, Sensor_1 .. Sensor_N`` like the reference, N
      being the widest line (one scalar aggregate; shorter lines get NULLs).

    ``delimiter=","`` reads comma-separated files; ``header=True`` drops the
    first line of each file.
    """
    layout = layout or ("long" if long else "array")
    lines = read_lines(spark, path, header=header)
    parsed = parse_sensor_lines(lines, delimiter=delimiter).select("row_idx", "features")
    if layout == "long":
        return features_to_long(parsed, ["row_idx"])
    if layout == "wide":
        width = parsed.agg(F.max(F.size("features"))).first()[0] or 0
        return parsed.select(
            "row_idx",
            *[F.get(F.col("features"), i).alias(f"Sensor_{i + 1}") for i in range(width)],
        )
    return parsed


def parse_label_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``Label`` (1 fail, else 0) and ``Timestamp`` from label lines.

    Accepted: ``-1 "03/02/2009 08:15:00"`` (quoted day-first) and
    ``-1 07:05:12 14-03-2009`` (documented); unreadable time gives NULL.
    """
    txt = _strip(F.col(value_col))
    label_tok = F.regexp_extract(txt, r"^(\S+)", 1)
    rest = F.regexp_replace(F.regexp_extract(txt, r"^\S+\s+(.*)$", 1), '"', "")
    rest = F.trim(F.regexp_replace(rest, r"\s+", " "))
    return lines.withColumn("Label", recode_label(label_tok.try_cast("int"))).withColumn(
        "Timestamp", parse_timestamp_any(rest)
    )


def unreadable_labels(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines that don't begin with a whole number."""
    token = F.regexp_extract(_strip(F.col(value_col)), r"^(\S+)", 1)
    return lines.filter(token.try_cast("int").isNull())


def unreadable_readings(lines: DataFrame, value_col: str = "value", delimiter: str = WHITESPACE) -> DataFrame:
    """Lines with tokens that are neither numbers nor missing values, and
    those tokens; ``parse_sensor_lines`` makes them NULL."""
    tokens = F.split(_strip(F.col(value_col)), delimiter)
    bad = F.filter(tokens, lambda t: ~F.trim(t).isin(*MISSING_TOKENS) & F.trim(t).try_cast("double").isNull())
    return lines.withColumn("unreadable", bad).filter(F.size("unreadable") > 0)


def load_label_text(
    spark: SparkSession, path: str | Sequence[str], on_bad: str = "fail"
) -> DataFrame:
    """Label file -> ``row_idx, Label, Timestamp`` (times not yet filled).
    A label that is no number raises, or counts as pass with
    ``on_bad="pass"``."""
    lines = read_lines(spark, path)
    if on_bad == "fail":
        bad = unreadable_labels(lines).limit(1).collect()
        if bad:
            raise ValueError(f"line {bad[0]['row_idx']} has no readable label: {bad[0]['value']!r}")
    return parse_label_lines(lines).select("row_idx", "Label", "Timestamp")


def with_row_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Dense ``row_idx`` in ``order`` for frames that did not come from text."""
    indexed, _ = global_index(df, order)
    return indexed.withColumnRenamed(IDX, "row_idx")
