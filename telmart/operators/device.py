"""Cleaning of device records: the most complete row per subscriber."""

from pyspark.sql import DataFrame, Window, functions as F

from telmart.functions.labels import NOT_AVAILABLE, null_count, or_not_available

DETAILS = ["imei_tac", "brand_name", "model_name", "os_name", "os_vendor"]


def with_null_count(raw: DataFrame) -> DataFrame:
    """Adds ``no_of_nulls`` over all columns. The key gets its label for null
    here already, so that its partitioning lasts through to the joins."""
    return raw.withColumns({
        "no_of_nulls": null_count(raw.columns),
        "msisdn": or_not_available(F.col("msisdn")),
    })


def one_per_subscriber(counted: DataFrame) -> DataFrame:
    """The row with the fewest nulls; ties go by the device details. Each map
    task passes on one row per subscriber (WindowGroupLimit), so a subscriber
    with very many rows costs the reducer one row per map task."""
    first = Window.partitionBy("msisdn").orderBy(
        "no_of_nulls", *[F.asc_nulls_last(name) for name in DETAILS]
    )
    return (
        counted.withColumn("place", F.row_number().over(first))
        .filter(F.col("place") == 1)
        .drop("place", "no_of_nulls")
    )


def clean(raw: DataFrame) -> DataFrame:
    return one_per_subscriber(with_null_count(raw)).fillna(NOT_AVAILABLE)


def keys(raw: DataFrame) -> DataFrame:
    """The subscribers that ``clean`` has a row for, without choosing the row:
    all that a report without device columns needs."""
    return raw.select(or_not_available(F.col("msisdn")).alias("msisdn")).distinct()
