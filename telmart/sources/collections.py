"""Collections whose documents differ: every append brings its own fields and
types, and all are read as one table.

An append is a folder of its own, which is entered in a list with its schema
once it is complete. Readers see what is listed, so an append that breaks off
leaves nothing behind that could be read, and two that run at once do not
disturb each other. The list has one short row an append; no file is opened to
learn the fields.
"""

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

LISTED = "folder string, schema string, added timestamp"
_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))


def widest(one: T.DataType, two: T.DataType) -> T.DataType:
    """The type that holds the values of both without loss: the wider of two
    whole numbers, a decimal or a double that has room for both, structures with
    the fields of both, and text for all that have nothing else in common."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        return merged(one, two)
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(widest(one.elementType, two.elementType))
    if one in _WHOLE and two in _WHOLE:
        return max(one, two, key=_WHOLE.index)
    if _is_exact(one) and _is_exact(two):
        (left, scale_one), (right, scale_two) = _digits(one), _digits(two)
        scale = max(scale_one, scale_two)
        precision = max(left, right) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    doubles = (T.FloatType(), T.DoubleType(), *_WHOLE[:3])
    if one in doubles and two in doubles:
        return T.DoubleType()
    return T.StringType()


def _is_exact(kind: T.DataType) -> bool:
    return kind in _WHOLE or isinstance(kind, T.DecimalType)


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and behind the point."""
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (_DIGITS[kind], 0)


def merged(one: T.StructType, two: T.StructType) -> T.StructType:
    """The fields of both, in the order in which they came; names that differ
    in case alone are one field."""
    fields = {field.name.lower(): field for field in one}
    for field in two:
        known = fields.get(field.name.lower())
        fields[field.name.lower()] = T.StructField(
            known.name if known else field.name, widest(known.dataType, field.dataType) if known else field.dataType)
    return T.StructType(list(fields.values()))


def _as(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_fields(value.getField, have, want)))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: _as(x, have.elementType, want.elementType))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    return value.cast(want)


def _fields(field, have: T.StructType, want: T.StructType) -> list[Column]:
    known = {own.name.lower(): own for own in have}
    return [
        (_as(field(known[x.name.lower()].name), known[x.name.lower()].dataType, x.dataType)
         if x.name.lower() in known else F.lit(None).cast(x.dataType)).alias(x.name)
        for x in want
    ]


def append_documents(rows: DataFrame, location: str) -> None:
    """Adds rows with whatever columns they have."""
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    rows.write.parquet(f"{location}/{folder}")
    entry = (F.lit(folder).alias("folder"), F.lit(rows.schema.json()).alias("schema"), F.current_timestamp().alias("added"))
    spark.range(1).select(*entry).write.mode("append").parquet(f"{location}/listed")


def read_documents(spark: SparkSession, location: str) -> DataFrame:
    """All documents, with the fields that any of them has in the types that
    hold them all; a field that a document lacks is null. Without the
    identifier that document stores add. Appends of one schema are one scan."""
    listed = spark.read.schema(LISTED).parquet(f"{location}/listed")
    kinds = listed.groupBy("schema").agg(F.min("added").alias("first"), F.collect_list("folder").alias("folders"))
    parts = [
        spark.read.schema(T.StructType.fromJson(json.loads(kind.schema)))
        .parquet(*[f"{location}/{folder}" for folder in kind.folders]).drop("_id")
        for kind in kinds.orderBy("first", "schema").collect()
    ]
    schema = reduce(merged, [part.schema for part in parts])
    return reduce(DataFrame.unionAll, [
        part.select(*_fields(lambda name, part=part: part[f"`{name}`"], part.schema, schema)) for part in parts
    ])
