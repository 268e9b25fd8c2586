"""Small column builders shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MACHINE_EPS = 2.220446049250313e-16


def as_value(one_row: DataFrame) -> Column:
    """A one-row frame as a scalar subquery: a struct of its columns, evaluated once per query."""
    return one_row.select(F.struct(*one_row.columns).alias("row")).scalar()


def clean_number(col: Column) -> Column:
    """NaN to null, so that aggregates skip it."""
    return F.nanvl(col.cast("double"), F.lit(None).cast("double"))


def correlation(x: Column, y: Column, complete: bool = False) -> Column:
    """Pearson r over the pairs with both values; null where either side does not vary.

    ``complete`` says that neither column has nulls, so that deviations are shared between pairs.
    """
    left, right = (x, y) if complete else (F.when(y.isNotNull(), x), F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(left) * F.stddev_pop(right))


def cut(value: Column, edges: Sequence[float], labels: Sequence[str], lowest: bool = False) -> Column:
    """Label of the right-closed bin ``(edges[i], edges[i+1]]``; null outside the edges.

    ``lowest`` also takes the first edge into the first bin.
    """
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i, (lo, hi, label) in enumerate(zip(edges, edges[1:], labels)):
        above = (value >= lo) if lowest and i == 0 else (value > lo)
        out = out.when(above & (value <= hi), F.lit(label))
    return out


def absolute_percentage(actual: Column, predicted: Column) -> Column:
    """Absolute error over the actual, the denominator bounded away from zero."""
    return F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(MACHINE_EPS))


def unit_hash(*keys: Column, salt: str = "") -> Column:
    """A reproducible number in [0, 1) per key, equal on every machine and partitioning."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)
