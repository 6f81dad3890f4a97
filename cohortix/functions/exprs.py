"""Column expressions (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (Spark orders NaN above every number and counts it)."""
    x = col_(c)
    return F.when(~F.isnan(x), x)


def outside(c: str | Column, lo: float, hi: float) -> Column:
    """Strictly outside ``[lo, hi]``; NULL never matches (gives false)."""
    x = col_(c)
    return F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))


def within_or_null(c: str | Column, lo: float, hi: float) -> Column:
    """Keep the value inside ``[lo, hi]``, else NULL."""
    x = col_(c)
    return F.when(x.between(F.lit(lo), F.lit(hi)), x)


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """Clip to ``[lo, hi]``; NULL stays NULL (bare greatest/least skip NULLs)."""
    x = col_(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def case_flag(c: str | Column, threshold: float) -> Column:
    """``x >= threshold`` as int; missing gives 0."""
    return F.coalesce((col_(c) >= F.lit(threshold)).cast("int"), F.lit(0))


def encode_binary(c: str | Column, positive: str = "M") -> Column:
    """1 for ``positive``, 0 for everything else including missing."""
    return col_(c).eqNullSafe(F.lit(positive)).cast("int")


def zero_to_null(c: str | Column) -> Column:
    return F.nullif(col_(c), F.lit(0))


def safe_div(num: Column, den: Column) -> Column:
    """Division where a zero denominator (and +-inf result) gives NULL."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))


def severity_band(x: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First band whose upper bound is above ``x`` (``x < bound``)."""
    expr = None
    for bound, name in bands:
        expr = F.when(x < bound, name) if expr is None else expr.when(x < bound, name)
    return expr.otherwise(otherwise) if expr is not None else F.lit(otherwise)


def log1p(c: str | Column) -> Column:
    return F.log1p(col_(c))


def pct(part: Column, whole: Column) -> Column:
    """Percentage as ``part * 100.0 / whole`` (one fixed operation order, so
    the rounding of half-way values is reproducible)."""
    return F.try_divide(part * 100.0, whole)


def round_n(c: str | Column, digits: int) -> Column:
    """Round half up at ``digits`` decimals."""
    return F.round(col_(c), digits)
