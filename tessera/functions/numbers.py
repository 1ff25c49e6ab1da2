"""Number and unit functions with NumPy's and Python's rules."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_even(x, places: int = 0) -> Column:
    """Round half to even as NumPy does: the scaled double is rounded, so 1.225 (122.50000000000001 hundredths) gives 1.23,
    where ``bround`` takes its shortest decimal for a tie.  What has no scaled value stays."""
    v, scale = _c(x).cast("double"), float(10**places)
    return F.when(F.abs(v) < 1e300 / scale, F.rint(v * scale) / scale).otherwise(v)


def truncated(x) -> Column:
    """Towards zero, as BIGINT."""
    return _c(x).cast("bigint")


def finite(x) -> Column:
    """Neither null nor NaN nor infinite."""
    v = _c(x).cast("double")
    return F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False))


def ns_to_s(x) -> Column:
    return _c(x) / 1e9


def s_to_ns(x) -> Column:
    return truncated(_c(x) * 1e9)


def mm_to_m(x) -> Column:
    return _c(x) / 1000.0


def deg_to_rad(x) -> Column:
    return _c(x) * (math.pi / 180.0)


def clamp(x, low, high) -> Column:
    return F.least(F.greatest(_c(x), low), high)


def cosine_change(a, b) -> Column:
    """1 - cosine of two arrays, within [0, 1]; a zero vector stays as it is."""
    a, b = _c(a), _c(b)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = lambda x: F.when(F.sqrt(dot(x, x)) > 0, F.sqrt(dot(x, x))).otherwise(1.0)
    return clamp(1 - dot(a, b) / (norm(a) * norm(b)), F.lit(0.0), F.lit(1.0))
