"""Vector expressions in double precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineloom.functions import text


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def literal(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values]).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where one side has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)


def tokens(source: Column) -> Column:
    return F.regexp_extract_all(source, F.lit(text.TOKEN), F.lit(0))


def bucket_of(token: Column, dim: int) -> Column:
    """Feature hashing: the dimension a token counts for."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint") % F.lit(dim)


def hashed_text(source: Column, dim: int) -> Column:
    """Hashed vector of one short text, such as a query, inside its row."""
    buckets = F.transform(tokens(source), lambda t: bucket_of(t, dim))
    # Passing the buckets through a one-element array hashes each token once for all dimensions.
    counted = F.transform(
        F.array(buckets),
        lambda found: F.transform(
            F.sequence(F.lit(0), F.lit(dim - 1)), lambda b: F.size(F.filter(found, lambda x: x == b)).cast("double")
        ),
    )
    return F.get(counted, 0)
