"""Exact averages, durations and counting expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(value: Column, scale: int = 2) -> Column:
    """Mean of a decimal, rounded once. ``avg`` would round to six digits first
    and so could round twice."""
    return F.round(F.sum(value) / F.count(value), scale)


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with three decimals."""
    return F.round(micros_between(start, end).cast("decimal(20,0)") / F.lit(1_000_000), 3).cast("decimal(18,3)")


def hours_between(start: Column, end: Column) -> Column:
    """Hours with two decimals, NULL where either end is missing."""
    return F.round(micros_between(start, end).cast("decimal(20,0)") / F.lit(3_600_000_000), 2).cast("decimal(14,2)")


def millis_between(start: Column, end: Column) -> Column:
    """Milliseconds with three decimals."""
    return (micros_between(start, end).cast("decimal(20,0)") / F.lit(1000)).cast("decimal(20,3)")


def any_null(columns: Iterable[str]) -> Column:
    condition = F.lit(False)
    for name in columns:
        condition = condition | F.col(name).isNull()
    return condition


def segment(value: Column, bands: Iterable[tuple[str, float | None]]) -> Column:
    """First band whose lower bound the value reaches; ``None`` is the rest."""
    chain = None
    rest = None
    for name, floor in bands:
        if floor is None:
            rest = name
        elif chain is None:
            chain = F.when(value >= floor, name)
        else:
            chain = chain.when(value >= floor, name)
    return chain.otherwise(rest)
