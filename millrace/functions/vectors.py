"""Vector arithmetic as column expressions, in double."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, NULL when either vector is zero."""
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths)


def unit_length(a: Column) -> Column:
    # A list of one, so that the length is summed once a vector and not once a component.
    scaled = lambda length: F.when(length > 0, F.transform(a, lambda x: x.cast("double") / length))
    return F.get(F.transform(F.array(norm(a)), scaled), F.lit(0))
