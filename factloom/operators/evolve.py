"""Types that hold the values of two versions of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.spec import quoted

#: Whole numbers, narrow to wide, with the decimal digits that hold all their values.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
#: Whole numbers that a float or a double holds exactly.
_EXACT = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}
_MOST_DIGITS = 38


class TypeConflictError(TypeError):
    """Two versions of a column have no common type that holds the values of both."""


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type into which both cast without loss.

    Whole numbers widen to longer ones, to decimals, or to a float or double that holds them exactly; decimals to one
    with the digits of both before and after the point; a date to a timestamp at midnight; arrays, maps and structs
    part by part (fields by name). Nothing else widens, least of all numbers to text.
    """
    if a == b:
        return a
    kinds = {type(a): a, type(b): b}
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        values = common_type(a.valueType, b.valueType)
        return T.MapType(common_type(a.keyType, b.keyType), values, a.valueContainsNull or b.valueContainsNull)
    if set(kinds) <= set(_WHOLE):
        return kinds[max(kinds, key=_WHOLE.__getitem__)]
    for wide, exact in _EXACT.items():
        if wide in kinds and set(kinds) <= {wide, *exact}:
            return kinds[wide]
    if T.DecimalType in kinds and set(kinds) <= {T.DecimalType, *_WHOLE}:
        points = [(x.precision, x.scale) if isinstance(x, T.DecimalType) else (_WHOLE[type(x)], 0) for x in (a, b)]
        scale = max(s for _, s in points)
        digits = max(p - s for p, s in points) + scale
        if digits <= _MOST_DIGITS:
            return T.DecimalType(digits, scale)
    if set(kinds) <= {T.DateType, T.TimestampType, T.TimestampNTZType} and T.DateType in kinds:
        return next(x for k, x in kinds.items() if k is not T.DateType)
    raise TypeConflictError(f"{a.simpleString()} and {b.simpleString()} have no common type")


def _common_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    others = {f.name: f for f in b.fields}
    fields = []
    for field in a.fields:
        other = others.pop(field.name, None)
        kind = field.dataType if other is None else common_type(field.dataType, other.dataType)
        fields.append(T.StructField(field.name, kind, True))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in others.values()]])


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Columns of both, those of ``a`` first, each in a type that holds both versions; a conflict names its column."""
    others = {f.name: f for f in b.fields}
    for field in a.fields:
        if field.name in others:
            try:
                common_type(field.dataType, others[field.name].dataType)
            except TypeConflictError as conflict:
                raise TypeConflictError(f"column {field.name}: {conflict}") from None
    return _common_struct(a, b)


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in the columns and types of ``schema``; columns that ``df`` lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(quoted(f.name)) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def union_widened(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both, in the columns of both and in types that hold both versions of each."""
    schema = common_schema(a.schema, b.schema)
    return widened(a, schema).unionByName(widened(b, schema))
