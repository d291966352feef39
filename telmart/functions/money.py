"""Whole cents for sums and comparisons, dollars for reports.

Cents are 64-bit integers: exact, and cheaper to add up and to shuffle than
decimals as wide as a sum of them has to be.
"""

from pyspark.sql import Column, functions as F


def cents(dollars: Column) -> Column:
    """An amount rounded half up to the cent, in cents."""
    return (F.round(dollars, 2) * 100).cast("bigint")


def dollars(cents: Column) -> Column:
    return (cents.cast("decimal(19,0)") / 100).cast("double")
