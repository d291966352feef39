"""Tables and files in the cluster's shared folder, and Arrow columns as numpy."""

import gc

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telmart.session import new_folder, remove_folder

# White space of all word operators.
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def written(rows: DataFrame, name: str, **options) -> DataFrame:
    """The rows as a table in the shared folder: it cuts the lineage, and a
    lost executor costs only its tasks."""
    return stored(rows, name, **options)[0]


# Shuffle files go with the query that wrote them, not only once the driver has
# collected its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(rows: DataFrame, name: str, **options) -> tuple[DataFrame, str]:
    """As ``written``, with the folder, for a caller that removes it."""
    folder = new_folder(rows.sparkSession, name)
    conf = rows.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, True)
    try:
        rows.write.options(**options).parquet(folder)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder), folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file, which every machine has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def numbered(documents: DataFrame) -> DataFrame:
    """doc_id, text and row as a written table. How a scan is split depends on
    the cores alive, so a pass of its own would number the rows anew; later
    passes read the stored number. Divided by 2^33 it names the task that wrote
    the row."""
    return numbered_in(documents)[0]


def numbered_in(documents: DataFrame) -> tuple[DataFrame, str]:
    """As ``numbered``, with the folder, for a caller that removes it."""
    rows = documents.select("doc_id", text_of().alias("text"), F.monotonically_increasing_id().alias("row"))
    return stored(rows, "numbered", compression="zstd")


def unused(rows: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to be none of
    the table's columns, which Spark compares without case."""
    taken = {column.lower() for column in rows.columns}
    while name in taken:
        name = f"_{name}"
    return name


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the identifier as text, modulo ``of``; a null counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of


def open_folder(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and path of a shared folder, for files that are no
    Spark tables. Works for every store that pyarrow reaches."""
    return arrow_fs.FileSystem.from_uri(uri)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (bytes, offsets); nulls are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]: bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20):
    """Cuts a batch so that no piece holds much more than ``most`` bytes of a
    column, or one row."""
    sizes = np.diff(flat(batch.column(column))[1])
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Consecutive runs of a number array as one binary value each."""
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.asarray(counts, np.int64) * values.itemsize, out=offsets[1:])
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).cast(pa.binary())


def release(spark: SparkSession, *folders: str) -> None:
    """Removes written tables that are no longer needed. Spark drops the
    shuffle files of finished jobs only once the driver collects its garbage,
    which a long iteration on few driver objects does not bring about, so it
    is asked to."""
    for folder in folders:
        remove_folder(spark, folder)
    gc.collect()
    spark._jvm.System.gc()
