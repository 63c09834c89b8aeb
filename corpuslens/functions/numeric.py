"""Column expressions for numbers that Spark has no built-in for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 7.1.26, absolute error at most 1.5e-7.
ERFC_P = 0.3275911
ERFC_COEFFICIENTS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erfc_nonnegative(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    t = 1.0 / (1.0 + F.lit(ERFC_P) * x)
    poly = F.lit(0.0)
    for coefficient in reversed(ERFC_COEFFICIENTS):
        poly = (poly + coefficient) * t
    return poly * F.exp(-x * x)


def two_sided_p(z: Column) -> Column:
    """2 (1 - Phi(|z|)) of the standard normal distribution."""
    return erfc_nonnegative(F.abs(z) / F.sqrt(F.lit(2.0)))


def array_total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def array_median(values: Column) -> Column:
    """Median of an array of doubles, the middle two averaged; NULL if it is empty."""
    ordered = F.array_sort(values)
    n = F.size(ordered)
    low = F.try_element_at(ordered, F.floor((n + 1) / 2).cast("int"))
    high = F.try_element_at(ordered, F.floor(n / 2).cast("int") + 1)
    return F.when(n > 0, (low + high) / 2)


def dot(a: Column, b: Column) -> Column:
    return array_total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(array_total(F.transform(a, lambda x: x * x)))


def plain_double(x: Column) -> Column:
    """A number in decimal notation as DOUBLE, else NULL; a plain cast also takes suffixes such as 12d and 7f."""
    text = F.trim(x.cast("string"))
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
