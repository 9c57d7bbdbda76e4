"""One schema for rows whose column types changed over time.

A type is wider than another if it holds all values of it: whole numbers of more bytes, a double
for whole numbers of up to 32 bits and for floats, a decimal with as many digits on both sides of
the point, a timestamp for a date. Structures are compared field by field. Two types without a
common wider one are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
CLOCKS = (T.TimestampType, T.TimestampNTZType)
MOST_DIGITS = 38


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both, if there is one."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _wider_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = wider(a.elementType, b.elementType)
        return element and T.ArrayType(element, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = wider(a.keyType, b.keyType), wider(a.valueType, b.valueType)
        both = key is not None and value is not None
        return T.MapType(key, value, a.valueContainsNull or b.valueContainsNull) if both else None
    return _wider_value(a, b) or _wider_value(b, a)


def _wider_struct(a: T.StructType, b: T.StructType) -> T.StructType | None:
    found = T.StructType()
    for name in [*a.names, *[n for n in b.names if n not in a.names]]:
        sides = [s[name] for s in (a, b) if name in s.names]
        kind = wider(sides[0].dataType, sides[-1].dataType)
        if kind is None:
            return None
        found = found.add(name, kind, len(sides) < 2 or any(f.nullable for f in sides))
    return found


def _wider_value(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The wider of two simple types, where ``a`` is the one that comes first below."""
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return max(a, b, key=lambda t: WHOLE.index(type(t)))
    if isinstance(a, T.FloatType) and isinstance(b, T.DoubleType):
        return b
    if isinstance(a, (T.ByteType, T.ShortType)) and isinstance(b, (T.FloatType, T.DoubleType)):
        return b
    if isinstance(a, T.IntegerType) and isinstance(b, T.DoubleType):
        return b
    if isinstance(a, T.DateType) and isinstance(b, CLOCKS):
        return b
    if isinstance(a, WHOLE) and isinstance(b, T.DecimalType):
        a = T.DecimalType(DIGITS[type(a)], 0)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= MOST_DIGITS else None
    return None


def reconciled(a: T.StructType, b: T.StructType, name: str) -> T.StructType:
    """The columns of both, each of a type that holds the values of both."""
    found = T.StructType()
    for column in [*a.names, *[n for n in b.names if n not in a.names]]:
        kinds = [s[column].dataType for s in (a, b) if column in s.names]
        kind = wider(kinds[0], kinds[-1])
        if kind is None:
            old, new = (k.simpleString() for k in kinds)
            raise ValueError(f"{name}: {column} was {old} and is {new}, no type holds both")
        found = found.add(column, kind)
    return found


def cast_to(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """The columns ``fields``, of their types; null where ``df`` has none."""
    own = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in fields:
        column = F.col(f"`{field.name}`") if field.name in own else F.lit(None)
        if own.get(field.name) != field.dataType:
            column = column.cast(field.dataType).alias(field.name)
        columns.append(column)
    return df.select(*columns)


@dataclass(frozen=True)
class Group:
    """Neighbouring pieces of a table that have one schema."""

    names: tuple[str, ...]
    schema: T.StructType


def groups(names: Sequence[str], read: Callable[[Sequence[str]], DataFrame]) -> list[Group]:
    """``names``, in order, in groups that ``read`` can read together. They are halved until it
    can, so a few changes of type among many pieces cost few reads of schemas."""
    if not names:
        return []
    try:
        return [Group(tuple(names), read(names).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if len(names) == 1 or "CANNOT_MERGE" not in str(error):
            raise
    half = len(names) // 2
    found = groups(names[:half], read) + groups(names[half:], read)
    joined = [found[0]]
    for group in found[1:]:
        last = joined[-1]
        if {f.name: f.dataType for f in last.schema} == {f.name: f.dataType for f in group.schema}:
            joined[-1] = Group(last.names + group.names, last.schema)
        else:
            joined.append(group)
    return joined


def read_together(
    names: Sequence[str], read: Callable[[Sequence[str]], DataFrame], narrower: str = "error"
) -> DataFrame:
    """Rows of all pieces, in the order in which they were written, with the wider type of each
    column. A piece that has a narrower type than one before it is an error that names it,
    unless ``narrower`` is ``"widen"``."""
    found = groups(names, read)
    schema = found[0].schema
    for group in found[1:]:
        wanted = reconciled(schema, group.schema, group.names[0])
        kinds = {f.name: f.dataType for f in group.schema}
        before = {f.name: f.dataType for f in schema}
        for field in wanted:
            narrow = field.name in kinds and field.name in before and kinds[field.name] != field.dataType
            if narrow and narrower == "error":
                old, new = before[field.name].simpleString(), kinds[field.name].simpleString()
                raise ValueError(f"{group.names[0]}: {field.name} was {old} before and is only {new}")
        schema = wanted
    rows = None
    for group in found:
        part = cast_to(read(group.names), list(schema))
        rows = part if rows is None else rows.unionByName(part)
    return rows
