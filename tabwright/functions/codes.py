"""Recoding, binning and arithmetic helpers (COD*, BIN*, MTH*, UPD*), all built-in expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.fixed import FAMILY_SIZE_BINS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(c, mapping: dict, default=None) -> Column:
    """Dictionary lookup as a literal map (a missing key gives null, or ``default``).  For a
    dictionary too large to inline, join a broadcast two-column table instead."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    out = m[_c(c)]
    return out if default is None else F.coalesce(out, F.lit(default))


def collapse(c, values, to: str = "Rare") -> Column:
    """Values in ``values`` become ``to``; others (and null) pass through."""
    col = _c(c)
    return F.when(col.isin(list(values)), F.lit(to)).otherwise(col)


def range_bins(c, bins) -> Column:
    """``bins`` = [(lo, hi, code), ...], inclusive bounds, ``None`` for open ends.  Values in no bin
    get null (a ``when`` chain without ``otherwise``)."""
    col = _c(c)
    out = None
    for lo, hi, code in bins:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (col >= lo)
        if hi is not None:
            cond = cond & (col <= hi)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out


def family_size_bin(size) -> Column:
    """1 -> 0, 2-4 -> 1, 5-7 -> 2, 8+ -> 3."""
    return range_bins(size, FAMILY_SIZE_BINS)


def group_size_bin(size) -> Column:
    """2-4 -> 2, 5-8 or 1 -> 1, 11+ -> 0, and no value for 9-10 (kept on purpose)."""
    s = _c(size)
    return (F.when((s >= 2) & (s <= 4), F.lit(2))
            .when(((s >= 5) & (s <= 8)) | (s == 1), F.lit(1))
            .when(s >= 11, F.lit(0)))


def clip(c, lo: float | None, hi: float | None) -> Column:
    col = _c(c)
    if hi is not None:
        col = F.least(col, F.lit(hi))
    if lo is not None:
        col = F.greatest(col, F.lit(lo))
    return col


def threshold(score, t: float) -> Column:
    """Strictly above ``t`` -> 1, else 0 (null stays null)."""
    return (_c(score) > F.lit(float(t))).cast("int")


def convex(a: float, x, y) -> Column:
    """``a * x + (1 - a) * y``."""
    return F.lit(float(a)) * _c(x) + F.lit(1.0 - float(a)) * _c(y)


def nan_to_null(c) -> Column:
    """Spark orders NaN above every number and ``max`` returns it; the reference's NaN is a
    missing value, so turn it into null at ingest."""
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def overwrite_where(updates: dict, cond: Column) -> dict:
    """``{col: value}`` -> ``{col: when(cond, value).otherwise(col)}`` for ``withColumns``."""
    return {k: F.when(cond, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(k))
            for k, v in updates.items()}
