"""A ledger of numbered steps: what was intended, and what was done.

An append-only table with a row for each (number, state). A step's intent is
written before it begins and its end after it has succeeded, so a run that
finds an intent alone knows that the step may have happened in part."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

INTENT, DONE = "intent", "done"


class Ledger:
    def __init__(self, spark: SparkSession, path: str, number: str = "number"):
        self._spark, self._path, self._number = spark, path, number

    def record(self, number: int, state: str) -> None:
        row = self._spark.range(1).select(
            F.lit(number).cast("long").alias(self._number), F.lit(state).alias("state")
        )
        row.coalesce(1).write.mode("append").parquet(self._path)

    def _rows(self) -> DataFrame | None:
        try:
            return self._spark.read.schema(f"{self._number} long, state string").parquet(self._path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def last(self, state: str = DONE) -> int | None:
        """The highest number that has come to a state."""
        rows = self._rows()
        return None if rows is None else rows.where(F.col("state") == state).agg(F.max(self._number)).first()[0]

    def has(self, number: int, state: str = DONE) -> bool:
        rows = self._rows()
        return rows is not None and not rows.where(
            (F.col(self._number) == number) & (F.col("state") == state)).isEmpty()

    def unfinished(self) -> list[int]:
        """Numbers with an intent that were never done."""
        rows = self._rows()
        if rows is None:
            return []
        open_steps = rows.groupBy(self._number).agg(F.max(F.col("state") == DONE).alias("done")).where(~F.col("done"))
        return sorted(row[0] for row in open_steps.collect())
