"""Counting, comparison and ratio expressions shared by aggregates and checks."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger import contract as C


def all_of(conditions) -> Column:
    return reduce(and_, conditions)


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def count_when(condition: Column) -> Column:
    """Rows where the condition holds; NULL does not count and no rows gives 0."""
    return F.count_if(condition)


def count_violations(rule: Column) -> Column:
    """Rows where the rule does not hold; a rule that comes out NULL is a violation."""
    return F.count_if(~F.coalesce(rule, F.lit(False)))


def is_finite(number: Column) -> Column:
    """NaN sorts above every number in Spark, so it is ruled out first."""
    return ~F.isnan(number) & (F.abs(number) <= C.LARGEST_DOUBLE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL when the denominator is 0 or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def same_number(left: Column, right: Column, abs_tol: float = C.REGRESSION_ABS_TOL,
                rel_tol: float = C.REGRESSION_REL_TOL) -> Column:
    """Equal within max(abs_tol, rel_tol * larger magnitude); NULL equals only NULL; never NULL itself."""
    tolerance = F.greatest(F.lit(abs_tol), F.lit(rel_tol) * F.greatest(F.abs(left), F.abs(right)))
    close = is_finite(left) & is_finite(right) & (F.abs(left - right) <= tolerance)
    return F.coalesce((left.isNull() & right.isNull()) | close, F.lit(False))


def in_period(period: C.Period, year: str = "YEAR", month: str = "MONTH") -> Column:
    return F.col(year).isin(*period.years) & F.col(month).isin(*period.months)
