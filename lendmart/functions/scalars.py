"""Column expressions shared by the models. All of them stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day_of(ts: str | Column) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def rental_days(created_at: str, return_date: str, calendar: bool = False) -> Column:
    """Days from return to record creation, never below 0, NULL if not returned.

    Counts whole 24-hour units; ``calendar=True`` counts midnights passed.
    ``greatest`` would turn a NULL difference into 0, hence the guard.
    """
    if calendar:
        days = F.date_diff(F.to_date(created_at), F.to_date(return_date))
    else:
        days = F.extract(F.lit("DAY"), F.col(created_at) - F.col(return_date))
    days = days.cast("long")
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0).cast("long")))


def second_text(value: Column, dtype: str) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` of epoch milliseconds or of a timestamp.

    Sub-seconds are cut, not rounded. Epoch values, of any numeric type, are read
    without a zone, so the session zone plays no part. Other types raise.
    """
    numeric = dtype in ("bigint", "int", "smallint", "tinyint", "float", "double")
    if not (numeric or dtype.startswith(("decimal", "timestamp", "string", "date", "void"))):
        raise TypeError(f"no time can be read from {dtype}")
    if numeric or dtype.startswith("decimal"):
        millis = value.cast("decimal(18,3)")
        epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
        none = F.lit(0)
        value = epoch + F.make_dt_interval(
            none, none, none, (millis / F.lit(1000)).cast("decimal(18,6)")
        )
    return F.substring(value.cast("string"), 1, 19)


# Suffixes of published figures and what they multiply by.
THOUSANDS, MILLIONS = "Ribu", "M"

_GROUPED = r"[0-9]+(?:_[0-9]+)*"
_INTEGER = rf"^[+-]?{_GROUPED}$"
_DECIMAL = rf"^[+-]?(?:{_GROUPED}(?:\.(?:{_GROUPED})?)?|\.{_GROUPED})(?:[eE][+-]?{_GROUPED})?$"
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _number(text: Column, pattern: str, dtype: str) -> Column:
    # Spark's own cast also takes forms such as '1d', so the shape is checked first.
    text = F.regexp_replace(text, _EDGE_SPACE, "")
    return F.when(text.rlike(pattern), F.replace(text, F.lit("_"), F.lit("")).try_cast(dtype))


def metric_value(value: str | Column) -> Column:
    """Integer of a published figure: ``1.5 Ribu`` -> 1500, ``12 M`` -> 12000000.

    The thousands suffix is looked for first; a scaled figure is cut toward
    zero; anything that is no number becomes NULL.
    """
    value = F.col(value) if isinstance(value, str) else value
    text = F.replace(value, F.lit(" "), F.lit(""))

    def scaled(suffix: str, factor: int) -> Column:
        plain = F.replace(text, F.lit(suffix), F.lit(""))
        return (_number(plain, _DECIMAL, "double") * F.lit(float(factor))).try_cast("bigint")

    return (
        F.when(F.contains(text, F.lit(THOUSANDS)), scaled(THOUSANDS, 1_000))
        .when(F.contains(text, F.lit(MILLIONS)), scaled(MILLIONS, 1_000_000))
        .otherwise(_number(text, _INTEGER, "bigint"))
    )
