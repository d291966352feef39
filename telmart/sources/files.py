"""Headered text files, stored collections and exports."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from telmart import schemas


def read_text_table(
    spark: SparkSession, path: str, schema: StructType, names: list[str] | None = None
) -> DataFrame:
    """The columns of ``schema`` by their names in the header, in any order.
    Where ``names`` says what the header holds, it is only compared, while the
    rows are read.

    Stops where a column is missing, where files have different headers, and
    where a value is not of its column's type; blanks around numbers are no
    fault, and further columns are left out.
    """
    names = _header(spark, path, schema, names)
    rows = _as_text(spark, path, names)
    return rows.select(*[_value(field).cast(field.dataType).alias(field.name) for field in schema])


def read_with_causes(
    spark: SparkSession, path: str, schema: StructType, names: list[str] | None = None
) -> DataFrame:
    """Every record of the files: the columns of ``schema``, and for a record
    that cannot be used its text and the cause, else nulls. The cause is
    ``fields`` for another number of fields than the header has, or the names of
    the columns whose values are not of their type, which are null. Headers are
    checked as by ``read_text_table``."""
    names = _header(spark, path, schema, names)
    record = "record"
    while record in (name.lower() for name in names):
        record = f"_{record}"
    rows = _as_text(spark, path, names, record)
    typed = [field for field in schema if not isinstance(field.dataType, StringType)]
    unread = F.concat_ws(", ", *[
        F.when(_value(field).isNotNull() & _value(field).try_cast(field.dataType).isNull(), F.lit(field.name))
        for field in typed
    ])
    cause = F.when(F.col(record).isNotNull(), "fields").when(unread != "", unread)
    text = F.when(cause.isNotNull(), F.coalesce(record, F.to_csv(F.struct(*names))))
    return rows.select(
        *[_value(field).try_cast(field.dataType).alias(field.name) for field in schema], text.alias("text"), cause.alias("cause"),
    )


def _header(spark: SparkSession, path: str, schema: StructType, names: list[str] | None) -> list[str]:
    names = names or spark.read.option("header", True).csv(path).columns
    missing = [name for name in schema.names if name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return names


def _as_text(spark: SparkSession, path: str, names: list[str], record: str | None = None) -> DataFrame:
    """All columns as text; in ``record`` the records of another number of fields."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if record is not None:
        names, reader = [*names, record], reader.option("columnNameOfCorruptRecord", record)
    return reader.schema(StructType([StructField(name, StringType()) for name in names])).csv(path)


def _value(field: StructField) -> Column:
    return F.col(field.name) if isinstance(field.dataType, StringType) else F.nullif(F.trim(field.name), F.lit(""))


def scan_crm(spark: SparkSession, path: str) -> DataFrame:
    return birth_years(read_text_table(spark, path, schemas.CRM))


def birth_years(rows: DataFrame) -> DataFrame:
    """Birth years as they are written, without blanks; an empty one is null."""
    return rows.withColumn("year_of_birth", F.nullif(F.trim("year_of_birth"), F.lit("")))


def scan_device(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, schemas.DEVICE)


def scan_revenue(spark: SparkSession, path: str) -> DataFrame:
    return read_text_table(spark, path, schemas.REVENUE)


def write_text_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def append_collection(rows: DataFrame, location: str, fmt: str = "parquet", **options) -> None:
    """Adds rows to a stored collection; ``fmt`` is any batch writer that the
    cluster has, a document store's included."""
    rows.write.mode("append").format(fmt).options(**options).save(location)


def read_collection(spark: SparkSession, location: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stored collection without the identifier that document stores add."""
    return spark.read.format(fmt).options(**options).load(location).drop("_id")
