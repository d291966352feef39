"""Joins of customers, devices and revenue, and the revenue roll-up."""

from pyspark.sql import DataFrame, functions as F

from telmart.functions.money import cents


def subscribers(crm: DataFrame, device: DataFrame) -> DataFrame:
    """Every subscriber known to either side, one row each."""
    return crm.join(device, "msisdn", "full")


def subscriber_week(known: DataFrame, revenue: DataFrame) -> DataFrame:
    """One row per revenue event of a known subscriber; batch or stream.

    No side is marked for broadcast: both grow with the data. A subscriber
    with very many events is split by adaptive skew-join handling.
    """
    return known.join(revenue, "msisdn", "inner")


def activity(revenue: DataFrame, weekly: bool = True) -> DataFrame:
    """Revenue events rolled up per subscriber (and week), in cents as every
    report counts them. It combines on the map side, so that the join that
    follows sees one row per key however many events a subscriber has."""
    keys = ["msisdn", "week_number"] if weekly else ["msisdn"]
    amount = cents(F.col("revenue_usd"))
    return revenue.groupBy(*keys).agg(
        F.count("*").alias("events"),
        F.sum(amount).alias("revenue"),
        F.max(amount).alias("highest"),
        F.min(amount).alias("lowest"),
    )


def subscriber_activity(crm: DataFrame, device: DataFrame, rolled_up: DataFrame) -> DataFrame:
    """The roll-up with customer and device columns, for known subscribers.

    Equal to rolling up ``subscriber_week``. Two left joins on the one msisdn
    reuse the partitioning of both cleaned sides, where the full join's merged
    key would have to be shuffled again.
    """
    joined = rolled_up.join(crm.withColumn("in_crm", F.lit(True)), "msisdn", "left").join(
        device.withColumn("in_device", F.lit(True)), "msisdn", "left"
    )
    return joined.filter(F.col("in_crm").isNotNull() | F.col("in_device").isNotNull()).drop(
        "in_crm", "in_device"
    )


def as_activity(facts: DataFrame) -> DataFrame:
    """Single events in the shape of the roll-up."""
    amount = cents(F.col("revenue_usd"))
    return facts.select(
        "*",
        F.lit(1).cast("bigint").alias("events"),
        amount.alias("revenue"),
        amount.alias("highest"),
        amount.alias("lowest"),
    ).drop("revenue_usd")
