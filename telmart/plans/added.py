"""Cleaned tables that grow by added rows.

A subscriber's cleaned row rests on its own raw rows alone, so added rows change
only the subscribers that they name. These are cleaned again from all their raw
rows, which a Bloom filter of their keys picks out of the raw table before
anything is shuffled, and take the place of their cleaned rows in the next
version. Raw rows and versions lie beside the earlier ones; the ledger has a
version's end once it is complete, so readers see the version before until then,
and a run that breaks off is done again under the same number.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from telmart.functions.labels import or_not_available
from telmart.operators import bloom
from telmart.plans.ledger import DONE, INTENT, Ledger
from telmart.session import remove_folder


def _ledger(spark: SparkSession, folder: str) -> Ledger:
    return Ledger(spark, f"{folder}/ledger", "version")


def _keyed(rows: DataFrame) -> DataFrame:
    """With ``key``: a missing subscriber and its label are one subscriber in a
    cleaned table and may be two in a raw one; here they go together."""
    return rows.withColumn("key", or_not_available(F.col("msisdn")))


def add(spark: SparkSession, new: DataFrame, folder: str, clean: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The cleaned table after ``new`` raw rows have been added. ``clean`` must
    treat each subscriber by itself. All additions have the same columns."""
    ledger = _ledger(spark, folder)
    last = ledger.last() or 0
    version = last + 1
    ledger.record(version, INTENT)
    new.write.mode("overwrite").parquet(f"{folder}/raw/{version}")

    def raw(*versions: int) -> DataFrame:
        return spark.read.schema(new.schema).parquet(*[f"{folder}/raw/{number}" for number in versions])

    if last == 0:
        cleaned = clean(raw(1))
    else:
        touched = _keyed(raw(version)).select("key").distinct()
        rows = bloom.may_match(_keyed(raw(*range(1, version + 1))), "key", bloom.key_filter(touched, "key"))
        again = clean(rows.join(touched, "key", "left_semi").select(*new.columns))
        kept = _keyed(current(spark, folder, clean(raw(1)))).join(touched, "key", "left_anti").drop("key")
        cleaned = kept.unionByName(again)
    cleaned.write.mode("overwrite").parquet(f"{folder}/clean/{version}")
    ledger.record(version, DONE)
    if version > 2:  # a reader may still be at the version before this one
        remove_folder(spark, f"{folder}/clean/{version - 2}")
    return current(spark, folder, cleaned)


def current(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """The last complete version, with the columns of ``like``; none of its
    rows are read."""
    version = _ledger(spark, folder).last()
    if version is None:
        raise ValueError(f"nothing has been added to {folder}")
    return spark.read.schema(like.schema).parquet(f"{folder}/clean/{version}")
