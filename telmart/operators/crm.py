"""Cleaning of customer records: one row per subscriber.

A subscriber's rows are made distinct before anything is brought together by
msisdn. Distinct combines on the map side and spreads over all six columns, so
what later meets in one window is a subscriber's distinct attribute
combinations (years x plan types x statuses x tiers x genders), however often
they repeat: a key that holds a third of the raw rows arrives as a few thousand
rows. All later steps share the one exchange by msisdn.
"""

from pyspark.sql import DataFrame, Window, functions as F

from telmart.functions.gender import normalise_gender
from telmart.functions.labels import or_not_available

GROUP = ["msisdn", "year_of_birth", "mobile_type", "gender"]


def normalise(raw: DataFrame) -> DataFrame:
    """Distinct rows with gender as male, female or null and birth year as
    a label."""
    return raw.select(
        "msisdn",
        normalise_gender("gender").alias("gender"),
        or_not_available(F.col("year_of_birth")).alias("year_of_birth"),
        "system_status",
        "mobile_type",
        "value_segment",
    ).distinct()


def fill_gender(rows: DataFrame) -> DataFrame:
    """Adds ``filled_gender``: the subscriber's last known gender in birth-year
    order, else the next known one, else Not Available. Rows of one birth year
    are taken in the order female, male, unknown. Where no gender is known up
    to a row, the next known one is the subscriber's first, so both frames
    share one sort and take one pass."""
    ordered = Window.partitionBy("msisdn").orderBy("year_of_birth", F.asc_nulls_last("gender"))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_rows = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn(
        "filled_gender",
        or_not_available(F.coalesce(
            F.last("gender", ignorenulls=True).over(so_far),
            F.first("gender", ignorenulls=True).over(all_rows),
        )),
    )


def dedupe(filled: DataFrame) -> DataFrame:
    """Puts the filled gender in place and drops the copies that this makes."""
    return (
        filled.withColumn("gender", F.col("filled_gender"))
        .drop("filled_gender")
        .distinct()
    )


def with_counts(rows: DataFrame) -> DataFrame:
    """Adds the row counts that the choice of a survivor rests on, per
    subscriber (n_*) and per birth year, plan type and gender of a
    subscriber (group_*). The finer window comes first: its sort serves the
    coarser one as well."""
    group = f"OVER (PARTITION BY {', '.join(GROUP)})"
    subscriber = "OVER (PARTITION BY msisdn)"
    return (
        rows.selectExpr(
            "*",
            f"count_if(system_status IN ('ACTIVE', 'SUSPEND', 'IDLE')) {group} AS group_live",
            f"count_if(system_status = 'ACTIVE') {group} AS group_active",
            f"count_if(system_status = 'IDLE') {group} AS group_idle",
        )
        .selectExpr(
            "*",
            f"count(*) {subscriber} AS n_rows",
            f"count_if(system_status = 'DEACTIVE') {subscriber} AS n_deactive",
            f"count_if(system_status = 'ACTIVE') {subscriber} AS n_active",
            f"count_if(system_status = 'IDLE') {subscriber} AS all_idle",
            f"count_if(system_status = 'ACTIVE' AND group_live = 1) {subscriber} AS lone_active",
            f"max(group_live) {subscriber} AS widest",
        )
        .selectExpr(
            "* EXCEPT (all_idle, lone_active, widest)",
            "if(n_active = 0, all_idle, 0) AS n_idle",
            "group_live IN (1, n_rows) AS alone",
            # A group of all the subscriber's rows is alone however many they are.
            "if(widest = n_rows, n_active, lone_active) AS n_alone_active",
        )
    )


def survivors(counted: DataFrame) -> DataFrame:
    """The rows a subscriber may be represented by; possibly none.

    Deactivated subscribers keep their DEACTIVE rows, except that where the
    subscriber also idles and was never active, a row goes if the one live row
    of its group is a suspended one. Otherwise ACTIVE rows win, first those
    alone in their group, then any; else IDLE rows; else SUSPEND rows.
    """
    return counted.filter("""
        CASE system_status
            WHEN 'DEACTIVE' THEN NOT (n_idle > 0 AND group_live = 1 AND group_active = 0 AND group_idle = 0)
            WHEN 'ACTIVE' THEN n_deactive = 0 AND (alone OR n_alone_active = 0)
            WHEN 'IDLE' THEN n_deactive = 0 AND n_active = 0
            WHEN 'SUSPEND' THEN n_deactive = 0 AND n_active = 0 AND n_idle = 0
        END
    """).select("msisdn", "gender", "year_of_birth", "system_status", "mobile_type", "value_segment")


def one_per_subscriber(rows: DataFrame) -> DataFrame:
    """The first row per subscriber by status; ties go by birth year, plan
    type, gender and tier, unknown plan types and tiers last."""
    place = """row_number() OVER (PARTITION BY msisdn ORDER BY
        system_status NULLS LAST, year_of_birth NULLS LAST, mobile_type NULLS LAST,
        gender NULLS LAST, value_segment NULLS LAST) AS place"""
    return rows.selectExpr("*", place).filter("place = 1").drop("place")


def clean(raw: DataFrame) -> DataFrame:
    """Raw customer records to at most one row per subscriber."""
    rows = dedupe(fill_gender(normalise(raw)))
    return one_per_subscriber(survivors(with_counts(rows)))
