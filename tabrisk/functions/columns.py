"""Column-level building blocks. All are built-in Spark expressions (codegen, no Python)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (Spark ``trim`` only removes spaces)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def nan_to_null(c: str | Column) -> Column:
    """Map floating NaN to NULL (pandas has one missing notion, Spark two)."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def coerce_double(c: str | Column, fill: float = 0.0) -> Column:
    """``pd.to_numeric(errors='coerce').fillna(0)``: bad text → NULL → ``fill``."""
    v = _c(c).cast("string").try_cast("double")
    return F.coalesce(nan_to_null(v), F.lit(float(fill)))


def divide(num: str | Column, den: str | Column) -> Column:
    """Floating division as pandas does it: x/0 is ±inf, 0/0 and NaN/0 are NaN, NULL stays NULL."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d == 0, n * F.lit(float("inf"))).otherwise(F.try_divide(n, d))


def guarded_ratio(num: str | Column, den: str | Column, eps: float) -> Column:
    """``a / (b + eps)`` on doubles; never raises (see ``divide``)."""
    return divide(num, _c(den).cast("double") + F.lit(float(eps)))


def clip_lower(c: str | Column, lo: float) -> Column:
    """``s.clip(lo)`` that keeps NULL (``greatest`` would skip it)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def interval_flag(c: str | Column, lo: float | None = None, hi: float | None = None,
                  lo_closed: bool = True, hi_closed: bool = True) -> Column:
    """0/1 flag for membership in an interval; NULL and NaN compare false → 0."""
    c = nan_to_null(c)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & ((c >= lo) if lo_closed else (c > lo))
    if hi is not None:
        cond = cond & ((c <= hi) if hi_closed else (c < hi))
    return F.coalesce(cond.cast("int"), F.lit(0))


def flag(cond: Column) -> Column:
    """Boolean → 0/1 with NULL → 0. Spark sorts NaN above all numbers: compare ``nan_to_null`` of a
    floating column, as ``threshold_flag`` does, where pandas' comparisons with NaN are False."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def threshold_flag(c: str | Column, op: str, value: float) -> Column:
    """0/1 flag of ``c op value`` for numeric ``c``; NULL and NaN give 0."""
    c, v = nan_to_null(c), F.lit(value)
    return flag({">": c > v, ">=": c >= v, "<": c < v, "<=": c <= v, "==": c == v}[op])


def bin_right_closed(c: str | Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """``pd.cut`` with right-closed bins (-inf,e0],(e0,e1],...,(ek,inf) → 0..k+1 or labels; NaN → NULL."""
    c = nan_to_null(c)
    labels = list(labels) if labels is not None else list(range(len(edges) + 1))
    expr = None
    for e, lab in zip(edges, labels):
        expr = (F.when(c <= e, F.lit(lab)) if expr is None else expr.when(c <= e, F.lit(lab)))
    return expr.when(c.isNotNull(), F.lit(labels[len(edges)]))


def bin_left_closed(c: str | Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """Row-callback style bins: ``< e0``, ``< e1``, ..., else → labels; NaN → NULL."""
    c = nan_to_null(c)
    labels = list(labels) if labels is not None else list(range(len(edges) + 1))
    expr = None
    for e, lab in zip(edges, labels):
        expr = (F.when(c < e, F.lit(lab)) if expr is None else expr.when(c < e, F.lit(lab)))
    return expr.when(c.isNotNull(), F.lit(labels[len(edges)]))


def ordinal_map(c: str | Column, mapping: Mapping, default) -> Column:
    """Dictionary lookup with default (``s.map(d).fillna(default)``) as a map literal."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), _c(c)), F.lit(default))


def weighted_sum(weights: Mapping[str, float], const: float = 0.0) -> Column:
    """Linear index ``sum(w_i * c_i)`` evaluated left to right in dictionary order."""
    expr = None
    for name, w in weights.items():
        term = F.lit(float(w)) * _c(name)
        expr = term if expr is None else expr + term
    return expr + F.lit(float(const)) if const else expr


def argmax_first(arr: str | Column) -> Column:
    """0-based arg-max of an array, first position on ties (``np.argmax``)."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def round_half_even(c: str | Column, scale: int) -> Column:
    """Banker's rounding like Python ``round`` / NumPy ``round`` (Spark ``round`` is half-up)."""
    return F.bround(_c(c), scale)


def hash_key(id_col: str | Column, seed: int | str) -> Column:
    """Deterministic pseudo-random order key ``md5('<id>-<seed>')`` (same text in DuckDB)."""
    return F.md5(F.concat_ws("-", _c(id_col).cast("string"), F.lit(str(seed))))


def hash_unit(id_col: str | Column, seed: int | str) -> Column:
    """Deterministic value in [0, 1) from the first 8 hex digits of ``hash_key``."""
    h = F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10).cast("double")
    return h / F.lit(4294967296.0)


def round_binary(c: str | Column, dp: int) -> Column:
    """Round the binary value: ``round(x * 10^dp) / 10^dp`` with ties away from zero.

    Matches SQL engines that round the double itself (and NumPy up to the tie rule);
    Spark's ``round`` rounds the shortest decimal text, which differs on exact ties.
    """
    scale = float(10 ** dp)
    scaled = _c(c) * F.lit(scale)
    # ``rint`` sends ties to the even neighbour; ``round`` would make a decimal of every value, which is far slower.
    nearest = F.rint(scaled)
    whole = F.when(F.abs(scaled - nearest) == 0.5, scaled + F.signum(scaled) * 0.5).otherwise(nearest)
    # Adding 0.0 makes -0.0 zero.
    return (whole + F.lit(0.0)) / F.lit(scale)
