"""Vector column expressions C6-C10 (JVM-side higher-order functions).

These suit a bounded number of pairs per row (a row against its few routes).
Large pair sets go through ``weft.operators.scoring`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double_array(col: Column | str) -> Column:
    return _c(col).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    """Sum of element products. Mixed dimensions raise instead of silently
    yielding NULL."""
    a, b = as_double_array(a), as_double_array(b)
    prod = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x)
    return F.when(
        a.isNotNull() & b.isNotNull() & (F.size(a) != F.size(b)),
        F.raise_error(F.lit("vectors of unequal length cannot be compared")).cast("double"),
    ).otherwise(prod)


def sq_norm(a: Column | str) -> Column:
    a = as_double_array(a)
    return F.aggregate(a, F.lit(0.0).cast("double"), lambda s, x: s + x * x)


def l2_norm(a: Column | str) -> Column:
    """C7."""
    return F.sqrt(sq_norm(a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Dot / (|a| * |b|). A zero or NULL vector gives NULL (never raises under ANSI)."""
    return F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))


def score_label(col: Column | str) -> Column:
    """Three decimals, as printed by the router (``score=0.386``)."""
    return F.format_string("%.3f", _c(col))


def decode_vector(col: Column | str) -> Column:
    """Decode the text of a list literal such as ``[0.1, -2e-3]``.
    Malformed text becomes NULL (and is skipped by routing), never evaluated."""
    return F.from_json(_c(col), "array<double>")


def encode_vector(col: Column | str) -> Column:
    """Text form of a vector for CSV export."""
    return F.to_json(_c(col))
