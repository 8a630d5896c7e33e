"""Vector expressions over array<float> columns, in double arithmetic inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0).cast("double"), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector is zero."""
    length = norm(a) * norm(b)
    return F.when(length > 0, dot(a, b) / length).otherwise(F.lit(0.0))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def l2_normalize(a: Column) -> Column:
    """Unit length; a zero vector stays."""
    return let(a, lambda v: let(norm(v), lambda n: F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))))


def masked_mean(vectors: Column, mask: Column) -> Column:
    """Mean over the vectors whose mask is 1, position by position; null without any."""
    kept = F.filter(F.zip_with(vectors, mask, lambda v, m: F.when(m == 1, v)), lambda v: v.isNotNull())

    def mean(vs: Column) -> Column:
        total = F.aggregate(F.slice(vs, 2, F.greatest(F.size(vs) - 1, F.lit(0))), F.transform(F.get(vs, F.lit(0)), lambda x: x.cast("double")),
                            lambda s, v: F.zip_with(s, v, lambda x, y: x + y.cast("double")))
        return F.when(F.size(vs) > 0, F.transform(total, lambda x: x / F.size(vs)))

    return let(kept, mean)
