"""Probability vectors kept as ARRAY<DOUBLE>, and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_vector(text: Column, sep: str = "|") -> Column:
    return F.split(text, "\\" + sep).cast("array<double>")


def format_vector(v: Column, sep: str = "|") -> Column:
    return F.array_join(v.cast("array<string>"), sep)


def running_sum(v: Column) -> Column:
    return F.transform(v, lambda x, i: F.aggregate(F.slice(v, F.lit(1), i + 1), F.lit(0.0), lambda a, b: a + b))


def pad_with(v: Column, length: Column, value: float = 1.0) -> Column:
    """Append `value` until the vector has `length` entries."""
    missing = F.greatest(length - F.size(v), F.lit(0)).cast("int")
    return F.concat(v, F.array_repeat(F.lit(value), missing))


def softplus_weight(distance: Column, scale: float = 1200.0) -> Column:
    """ln(1 + exp(-d/scale)) / ln 2; a missing distance counts as infinite."""
    import math

    return F.coalesce(F.log1p(F.exp(-distance / scale)) / math.log(2), F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b with null for a zero divisor."""
    return a / F.nullif(b, F.lit(0.0))


def binned(x: Column, breaks: list[float], labels: list[str]) -> Column:
    """Label of the first break that is not below x; the last label beyond all breaks."""
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(breaks, labels))):
        out = F.when(x <= edge, F.lit(label)).otherwise(out)
    return F.when(x.isNotNull(), out)
