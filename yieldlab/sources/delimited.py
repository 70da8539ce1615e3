"""Sensor matrices in whitespace or comma-separated form, with bad lines kept.

The form and the width are found in one aggregation over the lines: whitespace
if it gives enough columns, else commas (quoted fields may hold commas, spaces
and doubled quotes). The width is that of most lines (of equally many: the
greater). Lines are then read by Spark's CSV functions with a column for
records that don't fit, so no line is lost and none moves another's readings.

A quoted field doesn't go on over the end of a line. Empty lines and NULL
lines are no records and are left out. Without any line the width is 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import MISSING_TOKENS, missing_to_null
from .text import WHITESPACE, _strip, read_lines

#: Fewer whitespace-separated columns mean commas, as in the reference.
MIN_COLUMNS = 100


@dataclass(frozen=True)
class Layout:
    comma: bool
    width: int


def _comma_fields(line: Column) -> Column:
    # what is in quotes goes first; a doubled quote is two quoted parts side by side
    return F.regexp_count(F.regexp_replace(line, '"[^"]*+"', ""), F.lit(",")) + 1


def find_layout(lines: DataFrame, value_col: str = "value", min_columns: int = MIN_COLUMNS) -> Layout:
    """One aggregation, of which one row comes to the driver. The form goes by
    the width of most lines, so that a stray line of text doesn't decide."""
    line = _strip(F.col(value_col))
    widths = {"space": F.size(F.split(line, WHITESPACE)), "comma": _comma_fields(line)}
    # of equally frequent widths mode() takes the least, here of the negated ones
    found = lines.filter(F.length(line) > 0).agg(*[F.mode(-w, True).alias(c) for c, w in widths.items()]).first()
    if found.space is None:
        return Layout(False, 0)
    comma = -found.space < min_columns
    return Layout(comma, -(found.comma if comma else found.space))


def parse_matrix_lines(lines: DataFrame, layout: Layout, value_col: str = "value") -> DataFrame:
    """Add ``features ARRAY<DOUBLE>`` of the layout's width and ``bad_line``.

    ``bad_line`` is the line itself where it has another number of fields, or
    a field that is neither a number nor a missing value; else NULL. Of a bad
    line, ``features`` has what could be read: fields beyond the width go,
    lacking and unreadable ones are NULL."""
    line = _strip(F.col(value_col))
    lines = lines.filter(F.length(line) > 0)
    n = layout.width
    if layout.comma:
        names = [f"f{i}" for i in range(n)]
        most = max(20480, 2 * n)
        options = {
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad", "escape": '"', "maxColumns": str(most),
            "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
        }
        fits = _comma_fields(line) <= most  # the parser's limit; a longer line is bad anyhow
        record = F.from_csv(F.when(fits, line).otherwise(F.lit("")), ", ".join(f"{c} string" for c in [*names, "bad"]), options)
        # inside transform() the record is a variable, so that a line is parsed
        # once and not once for each of its fields
        tokens = lambda r: F.array(*[F.coalesce(r[c], F.lit("")) for c in names])
        odd = lambda r: r["bad"].isNotNull() | ~fits
    else:
        record = F.split(line, WHITESPACE)
        tokens = lambda r: F.transform(F.sequence(F.lit(0), F.lit(max(n - 1, 0))), lambda i: F.coalesce(F.get(r, i), F.lit("")))
        odd = lambda r: F.size(r) != n
    unreadable = lambda t: ~F.trim(t).isin(*MISSING_TOKENS) & F.trim(t).try_cast("double").isNull()
    split = F.transform(F.array(record), lambda r: F.struct(tokens(r).alias("t"), odd(r).alias("odd")))
    read = F.transform(
        split, lambda x: F.struct(F.transform(x["t"], lambda t: missing_to_null(t)).alias("features"), (x["odd"] | F.exists(x["t"], unreadable)).alias("bad"))
    )
    out = lines.withColumn("_r", read[0])
    return out.withColumns({"features": F.col("_r.features"), "bad_line": F.when(F.col("_r.bad"), F.col(value_col))}).drop("_r")


def load_sensor_matrix(
    spark: SparkSession,
    path: str | Sequence[str],
    min_columns: int = MIN_COLUMNS,
    header: bool | None = None,
    on_bad: str = "keep",
) -> DataFrame:
    """Sensor matrix file -> ``row_idx, features, bad_line``.

    ``header=None`` does as the reference: comma-separated files begin with a
    header, whitespace ones don't. ``on_bad="fail"`` raises with the first bad
    line, ``"drop"`` leaves bad lines out (the others keep their ``row_idx``).
    """
    if on_bad not in ("keep", "drop", "fail"):
        raise ValueError("on_bad is keep, drop or fail")
    layout = find_layout(spark.read.text([path] if isinstance(path, str) else list(path)), "value", min_columns)
    lines = read_lines(spark, path, header=layout.comma if header is None else header)
    parsed = parse_matrix_lines(lines, layout).select("row_idx", "features", "bad_line")
    if on_bad == "fail":
        bad = parsed.filter("bad_line is not null").orderBy("row_idx").limit(1).collect()
        if bad:
            raise ValueError(f"line {bad[0].row_idx} is no record of {layout.width} readings: {bad[0].bad_line[:200]!r}")
    return parsed.filter("bad_line is null") if on_bad == "drop" else parsed
