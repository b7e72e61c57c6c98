"""Null-safe numeric helpers that reproduce pandas semantics on Columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c, default: float | None = 0.0) -> Column:
    """``pd.to_numeric(errors='coerce').fillna(default)``.

    ``try_cast`` turns blanks and junk into null instead of raising under
    ANSI mode; the null is then replaced by ``default`` (keep null: None).
    """
    v = _c(c).try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def safe_div(num, den, default: float | None = 0.0) -> Column:
    """``num / den`` with a zero or null divisor mapped to ``default``."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def np_round(c, digits: int) -> Column:
    """Round like ``numpy.round`` / ``pandas.Series.round``.

    numpy scales by 10**digits, rounds half to even with ``rint`` and scales
    back; Spark's ``round`` (half up on the decimal string) and ``bround``
    (half even on the decimal string) both differ on binary ties such as
    0.145.  ``rint`` on the scaled double is the exact equivalent.
    """
    s = float(10 ** digits)
    return F.rint(_c(c).cast("double") * F.lit(s)) / F.lit(s)


def flag(cond: Column) -> Column:
    """Boolean predicate → 0/1 int where null counts as 0 (pandas ``astype(int)``)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def flag_eq(c, value: str, case_insensitive: bool = False) -> Column:
    """``(col == value).astype(int)``; optional case folding as ``str.upper()``."""
    col = _c(c)
    if case_insensitive:
        return flag(F.upper(col) == F.lit(value.upper()))
    return flag(col == F.lit(value))


def sum_columns(cols) -> Column:
    """Row-wise sum of several columns (``a + b + ...``)."""
    return reduce(add, [_c(c) for c in cols])


def months_between_floor(later, earlier) -> Column:
    """Whole calendar months between two dates: year diff * 12 + month diff."""
    a, b = _c(later), _c(earlier)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def strict_int(c, name: str | None = None) -> Column:
    """``astype(int)`` that fails on null or unparseable values.

    ANSI ``cast`` already raises on junk text; a null raises explicitly.
    """
    col = _c(c)
    label = name or (c if isinstance(c, str) else "value")
    return F.when(col.isNull(), F.raise_error(F.lit(f"null in {label}"))).otherwise(col.cast("int"))
