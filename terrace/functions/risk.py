"""Derived flags and bands as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(value: Column) -> Column:
    """The value, or 0 when there is none."""
    return F.coalesce(value, F.lit(0))


def coverage_flag(value: Column, balance: Column) -> Column:
    """``YES`` when the value (0 if missing) reaches the balance, else ``NO``."""
    return F.when(or_zero(value) >= balance, "YES").otherwise("NO")


def risk_band(defaulted: Column, score: Column, high_below: int, medium_below: int) -> Column:
    """``HIGH`` if defaulted or the score is low, then ``MEDIUM``, then ``LOW``.

    A missing score passes neither comparison and ends up as ``LOW``. The score of
    a defaulted credit is not looked at.
    """
    return (
        F.when(defaulted, "HIGH")
        .when(score < high_below, "HIGH")
        .when(score < medium_below, "MEDIUM")
        .otherwise("LOW")
    )
