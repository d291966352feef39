"""The report tables, one declaration each.

Every report groups rolled-up activity (``operators.enrich``) by at most three
small keys, so partial aggregation leaves little to shuffle and no key can
grow into a hot group.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from telmart.functions.labels import age, age_band
from telmart.functions.money import dollars

ACTIVE = "ACTIVE"
DEVICE_KEYS = {"brand_name", "os_name", "os_vendor"}


@dataclass(frozen=True)
class Mart:
    name: str
    table: str
    keys: tuple[str, ...]
    measures: dict[str, Callable[[], Column]] = field(hash=False)
    status: str | None = None
    ordered: bool = False

    @property
    def weekly(self) -> bool:
        return "week_number" in self.keys

    @property
    def counts_devices(self) -> bool:
        return _devices in self.measures.values()

    @property
    def shows_devices(self) -> bool:
        return self.counts_devices or not DEVICE_KEYS.isdisjoint(self.keys)


def _events() -> Column:
    return F.coalesce(F.sum("events"), F.lit(0)).cast("bigint")


def _devices() -> Column:
    return F.count_distinct("imei_tac")


def _revenue() -> Column:
    return dollars(F.sum("revenue"))


def _revenue_of(gender: str) -> Callable[[], Column]:
    return lambda: dollars(F.sum(F.when(F.col("gender") == gender, F.col("revenue")).otherwise(0)))


_BY_GENDER = {"male_revenue": _revenue_of("male"), "female_revenue": _revenue_of("female")}
_RANGE = {
    "highest_revenue_generated": lambda: dollars(F.max("highest")),
    "lowest_revenue_generated": lambda: dollars(F.min("lowest")),
}
_WEEK = ("week_number",)

# Table and column names as report readers know them, spelling included.
MARTS = [
    Mart("total_devices", "total_devices", (), {"total_devices": _devices}),
    Mart("devices_by_week", "total_devices_weekwise", _WEEK, {"total_devices": _events}, ordered=True),
    Mart("active_devices", "total_active_devices", (), {"total_active_devices": _devices}, ACTIVE),
    Mart("active_devices_by_week", "total_active_devices_weekwise", _WEEK,
         {"total_active_devices": _events}, ACTIVE, ordered=True),
    Mart("total_customers", "total_customers", (), {"total_customers": _events}),
    Mart("customers_by_week", "total_customers_weekwise", _WEEK, {"total_customers": _events}, ordered=True),
    Mart("active_customers", "total_customers_active", (), {"total_active_customers": _events}, ACTIVE),
    Mart("active_customers_by_week", "total_active_customers_weekwise", _WEEK,
         {"total_active_customers": _events}, ACTIVE, ordered=True),
    Mart("revenue_by_gender", "total_revenue_male_female", (), _BY_GENDER),
    Mart("revenue_by_gender_week", "total_revenue_male_female_weekwise", _WEEK, _BY_GENDER),
    # Grouped by exact age; the age goes along, so that rows of one decade differ.
    Mart("revenue_by_age", "total_revenue_age", ("age",), {"revenue": _revenue}),
    Mart("revenue_by_age_week", "total_revenue_age_weekwise", _WEEK + ("age",), {"revenue": _revenue}),
    Mart("revenue_by_segment_age", "total_revenue_by_age_value_segment",
         ("value_segment", "age"), {"total": _revenue}),
    Mart("revenue_by_segment_age_week", "total_revenue_by_age_value_segment_weekwise",
         ("value_segment", "week_number", "age"), {"total": _revenue}),
    # The same by whole decades.
    Mart("revenue_by_age_band", "total_revenue_age_band", ("age_group",), {"revenue": _revenue}),
    Mart("revenue_by_age_band_week", "total_revenue_age_band_weekwise",
         _WEEK + ("age_group",), {"revenue": _revenue}),
    Mart("revenue_by_segment_age_band_week", "total_revenue_by_age_band_value_segment_weekwise",
         ("value_segment", "week_number", "age_group"), {"total": _revenue}),
    Mart("revenue_by_mobile_type", "total_revenue_by_mobile_type", ("mobile_type",), {"revenue": _revenue}),
    Mart("revenue_by_mobile_type_week", "total_revenue_by_mobile_type_weekwise",
         _WEEK + ("mobile_type",), {"revenue": _revenue}),
    Mart("revenue_by_brand", "total_revenue_by_brand_name", ("brand_name",), {"revenue": _revenue}),
    Mart("revenue_by_brand_week", "total_revenue_by_brand_name_weekwise",
         _WEEK + ("brand_name",), {"revenue": _revenue}),
    Mart("revenue_by_os", "total_revenue_by_os_name", ("os_name",), {"revenue": _revenue}),
    Mart("revenue_by_os_week", "total_revenue_by_os_name_weekwise", _WEEK + ("os_name",), {"revenue": _revenue}),
    Mart("revenue_by_os_vendor", "total_revenue_by_os_vender", ("os_vendor",), {"revenue": _revenue}),
    Mart("revenue_by_os_vendor_week", "total_revenue_by_os_vender_weekwise",
         _WEEK + ("os_vendor",), {"revenue": _revenue}),
    Mart("customers_by_os", "total_customers_by_os_name", ("os_name",), {"total_customers": _events}),
    Mart("customers_by_os_week", "total_customers_by_os_name_weekwise",
         _WEEK + ("os_name",), {"total_customers": _events}),
    Mart("customers_by_brand", "total_customers_by_brand_name", ("brand_name",), {"total_customers": _events}),
    Mart("customers_by_brand_week", "total_customers_by_brand_name_weekwise",
         _WEEK + ("brand_name",), {"total_customers": _events}),
    Mart("customers_by_mobile_type", "total_customers_by_mobile_type",
         ("mobile_type",), {"total_customers": _events}),
    Mart("customers_by_mobile_type_week", "total_customers_by_mobile_type_weekwise",
         _WEEK + ("mobile_type",), {"total_customers": _events}),
    Mart("revenue_range_by_brand_week", "highest_lowest_revenue_by_brand_name_weekwise",
         _WEEK + ("brand_name",), _RANGE),
    Mart("revenue_range_by_os_week", "highest_lowest_revenue_by_os_name_weekwise", _WEEK + ("os_name",), _RANGE),
    Mart("brand_by_age_band", "distrbution_brand_name_by_age",
         ("age_group", "brand_name"), {"total_customers": _events}),
    Mart("os_by_age_band", "distrbution_os_name_by_age", ("age_group", "os_name"), {"total_customers": _events}),
]

BY_NAME = {mart.name: mart for mart in MARTS}

# What a report may group by or filter on, the device count apart.
DIMENSIONS = [
    "week_number", "gender", "year_of_birth", "system_status", "mobile_type",
    "value_segment", "brand_name", "os_name", "os_vendor",
]


def with_age(rows: DataFrame, as_of: str | None = None) -> DataFrame:
    return rows.withColumn("age", age(F.col("year_of_birth"), as_of)).withColumn(
        "age_group", age_band(F.col("age"))
    )


def build(mart: Mart, activity: DataFrame, as_of: str | None = None) -> DataFrame:
    """The rows of one report. ``as_of`` fixes the date that ages refer to."""
    rows = activity
    if mart.status is not None:
        rows = rows.filter(F.col("system_status") == mart.status)
    if "age" in mart.keys or "age_group" in mart.keys:
        rows = with_age(rows, as_of)
    report = rows.groupBy(*mart.keys).agg(
        *[measure().alias(name) for name, measure in mart.measures.items()]
    )
    if "age" in mart.keys:
        report = report.withColumn("age_group", age_band(F.col("age")))
    return report.orderBy(*mart.keys) if mart.ordered else report


_SUMS = ["events", "revenue", "highest", "lowest"]
# The written bitmaps by week.
BITMAPS = "week_number int, system_status string, bucket bigint, devices binary"


def by_week(activity: DataFrame) -> DataFrame:
    """Activity by every report dimension at once, and the devices of each
    week and status, from one pass over the facts. ``part`` tells the two
    apart: ``summary`` rows have the dimensions and sums, ``devices`` rows
    week, status and device."""
    sets = [[F.col(name) for name in DIMENSIONS], [F.col(name) for name in ("week_number", "system_status", "imei_tac")]]
    return activity.groupingSets(sets, *[F.col(name) for name in DIMENSIONS], F.col("imei_tac")).agg(
        F.sum("events").alias("events"),
        F.sum("revenue").alias("revenue"),
        F.max("highest").alias("highest"),
        F.min("lowest").alias("lowest"),
        F.when(F.grouping("imei_tac") == 1, "summary").otherwise("devices").alias("part"),
    )


def summary_of(weeks: DataFrame) -> DataFrame:
    return weeks.where(F.col("part") == "summary").select(*DIMENSIONS, *_SUMS)


def summary(activity: DataFrame) -> DataFrame:
    """The same straight from the activity."""
    return summary_of(by_week(activity))


def devices_of(weeks: DataFrame) -> DataFrame:
    """The different devices of each week and status."""
    return weeks.where((F.col("part") == "devices") & F.col("imei_tac").isNotNull()).select(
        "week_number", "system_status", "imei_tac"
    )


def device_bitmaps(devices: DataFrame, numbers: DataFrame) -> DataFrame:
    """week_number, system_status, bucket, devices: the numbers of the devices
    as bitmaps, which can be merged over weeks without counting a device twice."""
    number = F.col("number")
    return devices.join(numbers, "imei_tac").groupBy(
        "week_number", "system_status", F.bitmap_bucket_number(number).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("devices"))


def count_devices(mart: Mart, bitmaps: DataFrame) -> DataFrame:
    """A report of different devices, from the bitmaps of all weeks."""
    rows = bitmaps if mart.status is None else bitmaps.where(F.col("system_status") == mart.status)
    merged = rows.groupBy("bucket").agg(F.bitmap_or_agg("devices").alias("devices"))
    (name,) = mart.measures
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("devices")), F.lit(0)).cast("bigint").alias(name))
