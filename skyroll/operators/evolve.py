"""Schemas that grow: generations of a table read as one, at any depth.

A later generation may add columns, or fields of a nested one, and widen a
type. ``merged`` gives the schema that holds both, ``conformed`` brings rows to
it (what a generation doesn't have is NULL) and ``read_generations`` reads
files of several schemas, each by its own, so that pruning and pushed filters
still reach every scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Decimal digits that a whole-number type needs.
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19), strict=True))


def merged(a: T.DataType, b: T.DataType, at: str = "row") -> T.DataType:
    """The type that holds values of both; fields keep ``a``'s order and names, new ones follow. Raises if none does."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merged_fields(a, b, at)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged(a.elementType, b.elementType, f"{at}[]"), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        value = merged(a.valueType, b.valueType, f"{at}[]")
        return T.MapType(merged(a.keyType, b.keyType, f"{at} key"), value, a.valueContainsNull or b.valueContainsNull)
    wide = _widened(a, b) or _widened(b, a)
    if wide is None:
        raise TypeError(f"{at}: {a.simpleString()} and {b.simpleString()} have no common type")
    return wide


def _merged_fields(a: T.StructType, b: T.StructType, at: str) -> T.StructType:
    new = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = new.pop(f.name.lower(), None)
        kind = f.dataType if other is None else merged(f.dataType, other.dataType, f"{at}.{f.name}")
        fields.append(T.StructField(f.name, kind, True))
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in new.values()])


def _widened(narrow: T.DataType, wide: T.DataType) -> T.DataType | None:
    """The wider of two scalar types, if ``narrow`` goes into it; float and whole numbers meet in double."""
    if isinstance(narrow, _WHOLE):
        if isinstance(wide, _WHOLE):
            return wide if _DIGITS[type(narrow)] <= _DIGITS[type(wide)] else None
        if isinstance(wide, T.FractionalType) and not isinstance(wide, T.DecimalType):
            return T.DoubleType()
        if isinstance(wide, T.DecimalType):
            return _decimal(_DIGITS[type(narrow)], 0, wide)
    if isinstance(narrow, T.FloatType) and isinstance(wide, T.DoubleType):
        return wide
    if isinstance(narrow, T.DecimalType) and isinstance(wide, T.DecimalType):
        return _decimal(narrow.precision - narrow.scale, narrow.scale, wide)
    if isinstance(narrow, T.DateType) and isinstance(wide, (T.TimestampNTZType, T.TimestampType)):
        return wide
    return None


def _decimal(whole: int, scale: int, other: T.DecimalType) -> T.DecimalType | None:
    scale = max(scale, other.scale)
    digits = max(whole, other.precision - other.scale) + scale
    return T.DecimalType(digits, scale) if digits <= 38 else None


def _value(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_fields(have, want, value.getField)))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda v: _value(v, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            _value(e["key"], have.keyType, want.keyType).alias("key"), _value(e["value"], have.valueType, want.valueType).alias("value")))
        return F.map_from_entries(entries)
    return value.cast(want)


def _fields(have: T.StructType, want: T.StructType, get) -> list[Column]:
    held = {f.name.lower(): f for f in have.fields}
    out = []
    for f in want.fields:
        old = held.get(f.name.lower())
        out.append((F.lit(None).cast(f.dataType) if old is None else _value(get(old.name), old.dataType, f.dataType)).alias(f.name))
    return out


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the columns of ``schema``; a column or nested field that ``df`` lacks is NULL, a NULL struct stays NULL."""
    return df.select(*_fields(df.schema, schema, lambda name: df[f"`{name}`"]))


def union_generations(generations: Iterable[DataFrame]) -> DataFrame:
    """All rows of generations, oldest first, in their merged schema."""
    parts = list(generations)
    schema = reduce(merged, (p.schema for p in parts))
    return reduce(DataFrame.unionAll, (conformed(p, schema) for p in parts))


def read_generations(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Parquet folders of one schema each, oldest first, as one table."""
    return union_generations(spark.read.parquet(p) for p in paths)
