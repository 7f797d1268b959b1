"""Arithmetic on array<double> columns, kept JVM-side."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(v) -> Column:
    return F.col(v).cast("array<double>") if isinstance(v, str) else v.cast("array<double>")


def vec_dot(a, b) -> Column:
    return _sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def vec_norm(v) -> Column:
    return F.sqrt(_sum(F.transform(as_doubles(v), lambda x: x * x)))


def vec_l2(a, b) -> Column:
    """Euclidean distance."""
    return F.sqrt(_sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))))


def vec_cos(a, b) -> Column:
    """Cosine similarity; null when either vector is zero."""
    return F.try_divide(vec_dot(a, b), vec_norm(a) * vec_norm(b))


def l2_normalize(v) -> Column:
    """Unit-length copy of a vector; a zero vector stays zero."""
    # The norm is bound as the one element of an array, so that it is not computed again per component.
    unit = F.transform(
        F.array(vec_norm(v)),
        lambda n: F.when(n == 0.0, as_doubles(v)).otherwise(F.transform(as_doubles(v), lambda x: x / n)),
    )
    return F.get(unit, F.lit(0))
