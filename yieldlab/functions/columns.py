"""Scalar column expressions shared by the operators and views.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical output.
UNIT_ID_FORMAT = "WAFER_%04d"
SENSOR_PREFIX = "Sensor_"
DIRECTION_FAIL = "Pushes Toward Fail"
DIRECTION_PASS = "Pushes Toward Pass"
# Label text forms: quoted "dd/MM/yyyy HH:mm:ss" (the shipped file) first,
# then the documented unquoted "HH:mm:ss dd-MM-yyyy".
LABEL_TIME_FORMATS = ("dd/MM/yyyy HH:mm:ss", "HH:mm:ss dd-MM-yyyy")
MISSING_TOKENS = ("NaN", "nan", "NA", "")


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_pct(numerator: str | Column, denominator: str | Column, digits: int = 2) -> Column:
    """``ROUND(100 * num / NULLIF(den, 0), digits)`` as a DOUBLE.

    The literal is a double on purpose: ``100.0`` would make Spark switch to
    decimal arithmetic.
    """
    num = col_(numerator).cast("double")
    den = F.nullif(col_(denominator).cast("double"), F.lit(0.0))
    return F.round(F.lit(100.0) * num / den, digits)


def recode_label(raw: str | Column) -> Column:
    """Map -1 -> 0 (pass), 1 -> 1 (fail), anything else (or NULL) -> 0."""
    return F.when(col_(raw) == 1, F.lit(1)).otherwise(F.lit(0)).cast("int")


def shap_direction(value: str | Column) -> Column:
    """Positive attribution pushes toward fail; zero and NULL toward pass."""
    return F.when(col_(value) > 0, F.lit(DIRECTION_FAIL)).otherwise(F.lit(DIRECTION_PASS))


def unit_id_from_index(idx0: str | Column) -> Column:
    """``WAFER_%04d`` from a 0-based position (the id is 1-based)."""
    return F.format_string(UNIT_ID_FORMAT, (col_(idx0) + 1).cast("long"))


def sensor_name(sensor_no: str | Column) -> Column:
    return F.concat(F.lit(SENSOR_PREFIX), col_(sensor_no).cast("string"))


def parse_timestamp_any(text: str | Column, formats=LABEL_TIME_FORMATS) -> Column:
    """First format that parses wins; unparseable text gives NULL."""
    c = col_(text)
    return F.coalesce(*[_local_time(c, fmt) for fmt in formats])


def _local_time(c: Column, fmt: str) -> Column:
    """Wall-clock time in a format of dd, MM, yyyy and HH:mm:ss; no time zone
    takes part. NULL where the text isn't in the format or is no such time."""
    parts = ("yyyy", "MM", "dd", "HH", "mm", "ss")
    order = sorted(parts, key=fmt.index)
    pattern = "^" + re.sub("|".join(parts), lambda m: rf"(\d{{{len(m[0])}}})", re.escape(fmt)) + "$"
    at = {p: f"${order.index(p) + 1}" for p in parts}
    iso = F.regexp_replace(c, pattern, f"{at['yyyy']}-{at['MM']}-{at['dd']} {at['HH']}:{at['mm']}:{at['ss']}")
    return F.when(c.rlike(pattern), iso).try_cast("timestamp_ntz")


def missing_to_null(token: str | Column) -> Column:
    """Text token -> DOUBLE with NaN/NA/empty/garbage as NULL (never NaN)."""
    c = F.trim(col_(token))
    as_double = c.try_cast("double")
    return F.when(c.isin(*MISSING_TOKENS), F.lit(None).cast("double")).otherwise(
        F.when(F.isnan(as_double), F.lit(None).cast("double")).otherwise(as_double)
    )


_SAFE_NAME = re.compile(r"[- ]")


def safe_identifier(name: str) -> str:
    """SQL-safe column name: dash and space become underscore."""
    return _SAFE_NAME.sub("_", name)


def sanitize_columns(names: list[str]) -> list[str]:
    """Sanitise a list of names; two names mapping to one is an error."""
    out = [safe_identifier(n) for n in names]
    seen: dict[str, str] = {}
    for orig, new in zip(names, out):
        if new in seen and seen[new] != orig:
            raise ValueError(f"columns {seen[new]!r} and {orig!r} both become {new!r}")
        seen[new] = orig
    return out
