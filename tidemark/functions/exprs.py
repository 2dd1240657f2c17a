"""Column expressions: built-in functions only, so they stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def micros_between(start, end) -> Column:
    """end - start in microseconds (works for timestamp and timestamp_ntz)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def fractional_days(start, end) -> Column:
    """(end - start) in days as a double; negative when end precedes start."""
    return micros_between(start, end) / F.lit(float(MICROS_PER_DAY))


def whole_days(start, end) -> Column:
    """Number of whole 24-hour periods, floored (a timedelta's ``days``), not calendar days."""
    us = micros_between(start, end)
    return ((us - F.pmod(us, F.lit(MICROS_PER_DAY))) / F.lit(MICROS_PER_DAY)).cast("int")


def upper_in(col, values: Iterable[str]) -> Column:
    """1 when upper(coalesce(col, '')) is one of ``values``, else 0."""
    return F.upper(F.coalesce(_c(col), F.lit(""))).isin(*list(values)).cast("int")


def not_equal_null_safe(col, value) -> Column:
    """NOT (col <=> value): a null compares as different, as in pandas' ``!=``."""
    return ~_c(col).eqNullSafe(F.lit(value))


def any_equal(col, value) -> Column:
    """Aggregate: 1 if any row has col == value (null counts as false), else 0."""
    return F.coalesce(F.max((_c(col) == F.lit(value)).cast("int")), F.lit(0))


def seeded_bucket(id_col, seed: int, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from md5('seed:id'); equal in DuckDB as
    ('0x' || substr(md5(...), 1, 8))::BIGINT % buckets."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def seeded_order_key(id_col, seed: int) -> Column:
    """Pseudo-random but reproducible order key for shuffling ids (full md5 text)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))


def text_or_nan(col) -> Column:
    """str(x) for a scalar as pandas ``astype(str)`` renders it: null becomes 'nan'."""
    return F.coalesce(_c(col).cast("string"), F.lit("nan"))


def space_join(arr) -> Column:
    """' '.join(list); an empty list gives ''. A null array gives 'nan'."""
    return F.coalesce(F.concat_ws(" ", _c(arr)), F.lit("nan"))


def comma_join_or_none(arr) -> Column:
    """', '.join(list), or 'none' for an empty or missing list."""
    a = _c(arr)
    return F.when(F.coalesce(F.size(a), F.lit(0)) <= 0, F.lit("none")).otherwise(F.concat_ws(", ", a))


def argmax_class(scores) -> Column:
    """0-based index of the largest score; the first wins on ties."""
    a = _c(scores)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def class_score(scores, cls: int = 1) -> Column:
    return F.element_at(_c(scores), cls + 1)


def fixed_decimals(x, digits: int = 4) -> Column:
    """printf-style fixed-point text, e.g. '%.4f'."""
    return F.format_string(f"%.{digits}f", _c(x).cast("double"))


def percent(part, whole, digits: int = 1) -> Column:
    """100 * part / whole rounded; null when whole is 0."""
    return F.round(F.try_divide(_c(part).cast("double") * 100.0, _c(whole).cast("double")), digits)
