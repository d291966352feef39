"""Session settings and the shared folder for intermediate tables."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **settings) -> SparkSession:
    """A session for tests and the bench. On a cluster spark-submit's own
    settings apply and the jobs take whatever session they are given."""
    builder = (
        SparkSession.builder.master(master)
        .appName("telmart")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for written tables: below spark.checkpoint.dir, which all
    executors share, or where that is not set below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a written folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(size: str) -> int:
    digits = size.rstrip("bBkKmMgGtTpP")
    return int(digits) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[size[len(digits):][:1].lower()]


@contextmanager
def pieces(spark: SparkSession, most: str) -> Iterator[None]:
    """Within, adaptive execution cuts what it rebalances into pieces of about
    ``most`` shuffled bytes, or of the session's own size if that is less: a step
    takes as many tasks as its rows make pieces, not one for 64 MB."""
    before = spark.conf.get(ADVISORY, None)
    if _bytes(spark.conf.get(ADVISORY)) > _bytes(most):
        spark.conf.set(ADVISORY, most)
    try:
        yield
    finally:
        spark.conf.unset(ADVISORY) if before is None else spark.conf.set(ADVISORY, before)
