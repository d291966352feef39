"""Vectors of a table as rows of numpy matrices."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ROWS_AT_ONCE = 1 << 21  # numbers of a matrix that a task works on at a time


def usable(rows: DataFrame, vector_column: str, keep: list[Column]) -> tuple[DataFrame, int]:
    """The kept columns and ``vector`` of all rows whose vector is usable, and
    the number of dimensions.

    A vector that is null, empty or holds a null, NaN or infinite entry is
    not; nor is one of another length than the commonest (of equally common
    ones the longest). Numbers other than single floats become doubles.
    """
    kind = rows.select(vector_column).schema[0].dataType.elementType.simpleString()
    vector = F.col(vector_column).cast(f"array<{'float' if kind == 'float' else 'double'}>")
    found = rows.select(*keep, vector.alias("vector")).where(
        (F.size("vector") > 0) & F.forall("vector", lambda x: F.abs(x) < float("inf"))
    )
    size = F.size("vector")
    most = found.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = 0 if most is None else most["d"]
    return found.where(size == d), d


def matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """The vectors of a batch of usable rows, one a row."""
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def pieces_of(batch: pa.RecordBatch, d: int):
    """The batch in pieces of at most ROWS_AT_ONCE numbers, or one row."""
    step = max(1, ROWS_AT_ONCE // max(d, 1))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)
