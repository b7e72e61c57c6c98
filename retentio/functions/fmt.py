"""Presentation formatting (P34) and id / month text (§2.8 string functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _c, np_round


def money_text(c, digits: int = 0) -> Column:
    """``$1,234`` — thousands separators, numpy-rounded to ``digits``."""
    return F.concat(F.lit("$"), F.format_number(np_round(_c(c), digits), digits))


def pct_text(c, digits: int = 1, scale: float = 100.0) -> Column:
    """``12.3%`` from a share (``scale`` = 100) or a percentage (``scale`` = 1)."""
    return F.concat(F.format_number(np_round(_c(c) * F.lit(scale), digits), digits), F.lit("%"))


def id_code(c, prefix: str = "CUST_", width: int = 6) -> Column:
    """Zero-padded ids such as ``CUST_000042``."""
    return F.format_string(f"{prefix}%0{width}d", _c(c).cast("long"))


def month_text(c) -> Column:
    """``yyyy-MM`` period label of a date or timestamp."""
    return F.date_format(_c(c), "yyyy-MM")


def to_json_text(c) -> Column:
    """Serialise a struct (e.g. the P25 response) as a JSON string."""
    return F.to_json(_c(c))
