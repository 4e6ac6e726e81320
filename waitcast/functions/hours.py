"""Hour-of-day parsing as native column expressions (F1, F2).

The reference parses hour text row by row in Python. Here every rule is a
Catalyst expression, so it stays inside whole-stage codegen:

* ``'HH:MM[:SS]'`` -> HH + MM/60, both parts truncated toward zero first;
* plain number text -> truncated to an integer (``'14.5'`` -> 14);
* anything unparsable -> NULL (or ``default`` when given).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _trunc_double(text: Column) -> Column:
    """Text -> double truncated toward zero, NULL when not a number."""
    d = text.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None).cast("double")).otherwise(
        F.when(d >= 0, F.floor(d)).otherwise(F.ceil(d)).cast("double"))


def parse_hour(col, default: float | None = None, truncate_plain: bool = True) -> Column:
    """hour text -> fractional hours (double).

    ``truncate_plain=False`` keeps the fraction of a plain number (``'14.5'``
    -> 14.5), which is what the Spark training script of the reference does.
    """
    s = F.trim(_as_col(col).cast("string"))
    parts = F.split(s, ":")
    hh = _trunc_double(F.get(parts, 0))
    mm = F.coalesce(_trunc_double(F.get(parts, 1)), F.when(F.size(parts) == 1, F.lit(0.0)))
    with_colon = hh + mm / F.lit(60.0)
    plain_num = s.try_cast("double")
    plain = _trunc_double(s) if truncate_plain else F.when(~F.isnan(plain_num), plain_num)
    out = F.when(F.instr(s, ":") > 0, with_colon).otherwise(plain)
    if default is not None:
        out = F.coalesce(out, F.lit(float(default)))
    return out


def parse_hour_int(col) -> Column:
    """hour text -> integer hour; also accepts full datetime text (``'2025-10-30 14:05'``)."""
    s = F.trim(_as_col(col).cast("string"))
    from_ts = F.hour(F.try_to_timestamp(s))
    first = _trunc_double(F.get(F.split(s, ":"), 0))
    return F.when(F.instr(s, " ") > 0, from_ts).otherwise(first).cast("int")


def hour_int(hours: Column) -> Column:
    """Integer hour of a fractional hour (truncation, like ``int(x)``)."""
    return _as_col(hours).cast("int")
