"""Logit and score functions (L01-L05) on one logit vector per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def as_double(x: Column | str) -> Column:
    """FLOAT arrays are cast to DOUBLE before any sum."""
    return F.transform(col_(x), lambda v: v.cast("double"))


def temperature(x: Column | str, t: float) -> Column:
    """``logits / (T + 1e-7)``."""
    d = F.lit(float(t) + 1e-7)
    return F.transform(as_double(x), lambda v: v / d)


def logsumexp(z: Column) -> Column:
    m = F.array_max(z)
    return m + F.log(F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))


def selective_log_softmax(z: Column, index: Column | str) -> Column:
    """Log-softmax of ``z`` gathered at 0-based ``index``."""
    return F.element_at(z, col_(index) + 1) - logsumexp(z)


def entropy(z: Column) -> Column:
    """``logsumexp(z) - sum(softmax(z) * z)``."""
    m = F.array_max(z)
    s = F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - m))
    sz = F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - m) * v)
    return (m + F.log(s)) - sz / s


def dot(h: Column, w: Column) -> Column:
    """Linear head without bias."""
    return F.aggregate(F.zip_with(h, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def weight_vector(dim: int, label: int = 0) -> list[float]:
    """Deterministic head weights for the score heads (a model parameter, not data)."""
    return [((i * (7 + 4 * label)) % 11 - 5) / 10.0 for i in range(dim)]
