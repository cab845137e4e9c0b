"""Column functions on vectors (arrays of numbers), in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def normalise(a: Column, epsilon: float = 0.0) -> Column:
    """Length 1; a zero vector stays as it is (with an epsilon, every vector is divided).

    The norm is bound once for a vector, not computed for each of its components.
    """

    def by(n: Column) -> Column:
        divide = lambda x: x.cast("double") / (n + epsilon if epsilon else n)
        return F.transform(a, divide) if epsilon else F.when(n > 0, F.transform(a, divide)).otherwise(F.transform(a, lambda x: x.cast("double")))

    return F.get(F.transform(F.array(norm(a)), by), F.lit(0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, null if either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda acc, x: acc + x))


def fuse(text: Column, image: Column, dim: int, text_weight: float = 0.7, image_weight: float = 0.3) -> Column:
    """Weighted sum of two vectors of length 1; a missing one leaves the other, both missing give the zero vector."""
    both = F.zip_with(text, image, lambda x, y: (x * text_weight + y * image_weight) / (text_weight + image_weight))
    return F.when(text.isNotNull() & image.isNotNull(), normalise(both, 1e-8)).when(text.isNotNull(), normalise(text, 1e-8)).when(image.isNotNull(), normalise(image, 1e-8)).otherwise(F.array_repeat(F.lit(0.0), dim))


def stored_dim(vector: Column, dim: Column) -> Column:
    """The vector's own length if it is there, else the stored dimension."""
    return F.when(vector.isNotNull(), F.size(vector)).otherwise(dim)


def valid(vector: Column, dim: int, tolerance: float = 0.1) -> Column:
    return (F.size(vector) == dim) & (F.abs(norm(vector) - 1) <= tolerance)
