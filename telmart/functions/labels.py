"""Null labels, null counts, ages and age bands."""

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

NOT_AVAILABLE = "Not Available"


def or_not_available(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NOT_AVAILABLE))


def null_count(columns: list[str]) -> Column:
    return reduce(add, [F.col(name).isNull().cast("int") for name in columns])


def age(year_of_birth: Column, as_of: str | None = None) -> Column:
    """Calendar year of ``as_of`` (today if not given) minus the birth year,
    which may be written 1990.0; null where it is no whole number."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    number = year_of_birth.cast("string").try_cast("decimal(20,6)")
    whole = F.when(number == F.floor(number), number.try_cast("int"))
    return F.try_subtract(F.year(today), whole)


def age_band(years: Column) -> Column:
    """The decade of an age, such as 30-39; null for a null age."""
    low = years - years % 10
    return F.concat(low.cast("string"), F.lit("-"), (low + 9).cast("string"))
