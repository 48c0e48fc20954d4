"""Scalar cleaning and feature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN is 'missing' in pandas; in Spark it is a number. Turn it into null at ingest."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def null_sentinels(c, tokens=("_", "")) -> Column:
    """Whole-cell sentinel match -> null (``28_`` is *not* touched)."""
    col = _c(c)
    return F.when(col.isin(list(tokens)), F.lit(None)).otherwise(col)


def coerce_double(c) -> Column:
    """Coercing cast; unparsable text (``28_``, blank) -> null. ANSI-safe."""
    return _c(c).cast("string").try_cast("double")


def safe_divide(a, b) -> Column:
    """Division whose zero denominator gives null (pandas gives inf, ANSI Spark raises)."""
    return F.try_divide(_c(a), _c(b))


def ratio(a, b, eps: float = 1e-8, both: bool = False) -> Column:
    """ratio feature with epsilon on the denominator (and numerator if ``both``)."""
    num = _c(a) + F.lit(eps) if both else _c(a)
    return num / (_c(b) + F.lit(eps))


def date_parts(c) -> dict[str, Column]:
    """year, month, day, day of week with Monday = 0, ISO week of year."""
    d = _c(c)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "week_of_year": F.weekofyear(d),
    }


def keyword_flag(c, words) -> Column:
    """1 when the lower-cased text contains any of ``words`` (substring test)."""
    low = F.lower(_c(c))
    cond = None
    for w in words:
        t = F.contains(low, F.lit(w))
        cond = t if cond is None else (cond | t)
    return cond.cast("int")


def yes_flag(c, positive: str = "Yes") -> Column:
    """C14: binary target from text; null counts as 0 as in pandas' comparison."""
    return F.coalesce((_c(c) == F.lit(positive)).cast("int"), F.lit(0))


def round_half_up(c, digits: int) -> Column:
    """Round a double to ``digits`` decimals as ``floor(x * 10^d + 0.5) / 10^d``.

    Pure IEEE arithmetic, so any engine computing the same double gets the same
    rounded value (``round`` implementations differ on ties such as 8.0046875, whose
    binary value lies just below the decimal tie)."""
    scale = float(10 ** digits)
    v = _c(c).cast("double")
    finite = ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return F.when(finite, F.floor(v * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).otherwise(v)


def number(c) -> Column:
    """A column as double in which NaN is missing, like null."""
    return nan_to_null(_c(c).cast("double"))
