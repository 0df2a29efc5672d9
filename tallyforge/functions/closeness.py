"""Notions of two amounts being close. They differ on purpose: each check has its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _larger(a: Column, b: Column, least: float = 0.0) -> Column:
    return F.greatest(F.abs(a), F.abs(b), F.lit(least))


def close_quality(a: Column, b: Column, tol: float = 0.02) -> Column:
    """Both 0; or one 0 and less than 1,000 apart; or within ``tol`` of the larger."""
    return F.when((a == 0) & (b == 0), True).when((a == 0) | (b == 0), F.abs(a - b) < 1000).otherwise(F.abs(a - b) / _larger(a, b) <= tol)


def close_value(a: Column, b: Column) -> Column:
    """Within 100, or 2 % of the larger."""
    return F.abs(a - b) <= F.greatest(F.lit(100.0), 0.02 * _larger(a, b, 1.0))


def close_financial(a: Column, b: Column, strict: bool = False) -> Column:
    """Within 100, or 0.5 % of the larger; strict: within 1."""
    return F.abs(a - b) <= (F.lit(1.0) if strict else F.greatest(F.lit(100.0), 0.005 * _larger(a, b, 1.0)))


def close_ratio(a: Column, b: Column, tol: float) -> Column:
    """Within ``tol`` of the larger, or of 1."""
    return F.when((a == 0) & (b == 0), True).otherwise(F.abs(a - b) / _larger(a, b, 1.0) <= tol)


def close_audit(a: Column, b: Column, tol: float = 0.01) -> Column:
    """Within ``tol`` of the second amount, or of 1."""
    return F.abs(a - b) / F.greatest(F.abs(b), F.lit(1.0)) <= tol


def close_target(target: Column, value: Column, tol: float = 0.02) -> Column:
    """Within ``tol`` of the target, or of 1."""
    return F.when((target == 0) & (value == 0), True).otherwise(F.abs(target - value) <= tol * F.greatest(F.abs(target), F.lit(1.0)))


def match_score(got: Column, expected: Column) -> Column:
    """100 both 0, 40 one 0, else by relative distance: 95 to 2 %, 75 below 10 %, 55 below 30 %, 30."""
    off = F.abs(got - expected) / F.greatest(F.abs(got), F.abs(expected))
    return F.when((got == 0) & (expected == 0), 100).when((got == 0) | (expected == 0), 40).when(off <= 0.02, 95).when(off < 0.10, 75).when(off < 0.30, 55).otherwise(30).cast("int")


def percent_error(got: Column, expected: Column) -> Column:
    """Distance in percent of the expected amount, rounded half to even at two places; 0 where nothing is expected."""
    return F.when(expected == 0, F.when(got == 0, 0.0).otherwise(100.0)).otherwise(F.bround(F.abs(got - expected) / F.abs(expected) * 100, 2))
