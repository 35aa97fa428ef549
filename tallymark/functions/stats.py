"""Aggregate expressions with the pairing and zero-variance rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.exprs import round_to


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def both(x: str | Column, y: str | Column) -> Column:
    return _c(x).isNotNull() & _c(y).isNotNull()


def pair_count(x: str | Column, y: str | Column) -> Column:
    return F.count_if(both(x, y))


def paired_mean(value: str | Column, other: str | Column, digits: int | None = None) -> Column:
    """Mean of ``value`` over rows where ``other`` exists too."""
    mean = F.avg(F.when(_c(other).isNotNull(), _c(value)))
    return mean if digits is None else round_to(mean, digits)


def pearson(x: str | Column, y: str | Column, digits: int = 4, min_n: int = 3) -> Column:
    """Pearson r over complete pairs; null below ``min_n`` pairs or without variance.

    Built from the paired co-moments, which Spark merges stably; ``corr`` itself
    fails on a zero variance before any guard around it is looked at.
    """
    x, y = _c(x).cast("double"), _c(y).cast("double")
    spread = F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))
    r = F.try_divide(F.regr_sxy(y, x), spread)
    return F.when(pair_count(x, y) >= min_n, round_to(r, digits))
