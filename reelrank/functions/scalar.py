"""Scalar functions (F1–F8, P1–P3) expressed with built-in Spark SQL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JAVA_WS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a timestamp (floor); wall-clock NTZ values are read as UTC."""
    return F.unix_timestamp(ts).cast("long")


def rating_month(epoch_s: Column) -> Column:
    """F1 ``changeDate``: epoch seconds → yyyyMM as int, in UTC.

    Uses date arithmetic instead of ``date_format`` so the result does not depend on the
    session time zone (the reference used the JVM default zone; we fix it to UTC).
    """
    day = F.date_from_unix_date(F.floor(epoch_s / F.lit(86400)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def java_trim(s: Column) -> Column:
    """trim every character <= U+0020 at both ends, like ``String.trim``."""
    return F.regexp_replace(s, _JAVA_WS, "")


def split_fields(line: Column, sep: str) -> Column:
    """Split on a literal separator; trailing empty fields are kept."""
    return F.split(line, "\\" + sep if sep in "^|.$*+?()[]{}\\" else sep, -1)


def array_dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def array_norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """dot(a, b) / (|a|·|b|); NULL (not NaN) when either vector has zero norm."""
    return array_dot(a, b) / F.nullif(array_norm(a) * array_norm(b), F.lit(0.0))


def log10_count(n: Column) -> Column:
    """log10 of a count that defaults to 1 when absent or zero."""
    return F.log10(F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("double"))


def round6(c: Column) -> Column:
    return F.round(c, 6)
