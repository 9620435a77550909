"""Columns whose types change between loads: the common type, and values brought to it.

Types form a lattice. Integers widen to larger integers, numbers of different
kinds to double, dates to times, records, arrays and maps part by part; types
that have nothing else in common are text. Text of a number does not depend on
the steps it took there: ``1`` and ``1.0`` are both ``1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
# Below this size every whole double is exact, and has the digits of an integer.
_WHOLE = 2.0**53


def storable(dtype: T.DataType) -> T.DataType:
    """The type as it is written: all parts nullable, and text where only nulls came so far."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, storable(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(storable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(storable(dtype.keyType), storable(dtype.valueType))
    if isinstance(dtype, T.NullType):
        return T.StringType()
    return dtype


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider(a.valueType, b.valueType))
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both, those of ``a`` first, each of the wider type."""
    others = {f.name: f.dataType for f in b}
    fields = [T.StructField(f.name, wider(f.dataType, others.get(f.name, f.dataType))) for f in a]
    return T.StructType([*fields, *[f for f in b if f.name not in a.names]])


def as_type(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type as another that is at least as wide."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have}
        fields = [
            (as_type(value.getField(f.name), own[f.name], f.dataType) if f.name in own
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(value, lambda _, x: as_type(x, have.valueType, want.valueType))
    if isinstance(want, T.StringType):
        if isinstance(have, _NESTED):
            return F.to_json(value)
        if isinstance(have, (T.FloatType, T.DoubleType)):
            whole = (F.floor(value) == value) & (F.abs(value) < _WHOLE)
            # Not a cast of the value itself: that is an error for one that is no whole number.
            digits = F.floor(F.when(whole, value)).cast("string")
            return F.coalesce(digits, value.cast("string"))
        if isinstance(have, T.DecimalType):
            return as_type(value.cast("double"), T.DoubleType(), want)
    return value.cast(want)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with the columns of ``schema``, which is as wide as theirs or wider."""
    own = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (as_type(_stored(F.col(f"`{f.name}`"), own[f.name]), storable(own[f.name]), f.dataType) if f.name in own
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def _stored(value: Column, dtype: T.DataType) -> Column:
    """The value under the type it is written as."""
    return value.cast(storable(dtype)) if "void" in dtype.simpleString() else value
