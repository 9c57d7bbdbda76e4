"""Change-event envelopes: build, parse, reject, flatten."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "rejected"
# Fixed value: the only operation a poll can see.
OPERATION = "insert"


def table_schema(schema: T.StructType | str) -> T.StructType:
    """A ``StructType`` from a ``StructType``, DDL text or schema JSON."""
    if isinstance(schema, T.StructType):
        return schema
    if schema.lstrip().startswith("{"):
        return T.StructType.fromJson(json.loads(schema))
    return T.StructType.fromDDL(schema)


def envelope_schema(schema: T.StructType | str) -> T.StructType:
    """Envelope of a table: all fields nullable, ``before`` kept as JSON text."""
    text = T.StringType()
    source = T.StructType([T.StructField("db", text), T.StructField("table", text)])
    return T.StructType(
        [
            T.StructField("operation", text),
            T.StructField("before", text),
            T.StructField("after", table_schema(schema)),
            T.StructField("source", source),
            T.StructField("ts_ms", text),
        ]
    )


def event_schema(schema: T.StructType | str) -> T.StructType:
    """Envelope fields and ``rejected``: the columns of a raw table of events."""
    return T.StructType([*envelope_schema(schema), T.StructField(REJECTED, T.StringType())])


def build_envelope(df: DataFrame, database: str, table: str, ts_ms: int) -> Column:
    """JSON text of one insert event per row of ``df``.

    Instants are ISO 8601 without a zone, with a fraction only if there is one;
    decimals are exact text; null fields are written.
    """
    event = F.struct(
        F.lit(OPERATION).alias("operation"),
        F.create_map().cast("map<string,string>").alias("before"),
        F.struct(*[_json_ready(f) for f in df.schema]).alias("after"),
        F.struct(F.lit(database).alias("db"), F.lit(table).alias("table")).alias("source"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
    )
    return F.to_json(event, {"ignoreNullFields": "false"})


def _json_ready(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        column = _iso_instant(column)
    elif isinstance(field.dataType, T.DecimalType):
        column = column.cast("string")
    return column.alias(field.name)


def _iso_instant(column: Column) -> Column:
    """ISO 8601 text; the fraction has six digits, or is left out if zero. Works
    on the text form, which has no zone to shift a wall clock by."""
    text = column.cast("string")
    whole = F.replace(F.split_part(text, F.lit("."), F.lit(1)), F.lit(" "), F.lit("T"))
    fraction = F.split_part(text, F.lit("."), F.lit(2))
    return F.when(fraction == "", whole).otherwise(
        F.concat(whole, F.lit("."), F.rpad(fraction, 6, "0"))
    )


def parse_envelope(
    df: DataFrame,
    schema: T.StructType | str,
    column: str = "value",
    carry: Sequence[Column] = (),
) -> DataFrame:
    """Parse JSON text into envelope columns plus ``rejected``, then the columns ``carry``.

    Fields are matched by name: missing ones become null, extra ones are
    dropped. ``rejected`` holds the raw text of a message that is not an
    envelope (bad JSON, text after the JSON value, a value of the wrong type, no
    after-image, null in a field declared non-null) and is null for a good one, so both kinds pass
    through in one scan and no message is lost.
    """
    fields = envelope_schema(schema)
    # Nullability is checked below; the JSON reader itself does not enforce it.
    event = F.from_json(
        F.col(column), event_schema(schema), {"columnNameOfCorruptRecord": REJECTED}
    )
    # Generated columns are computed once per message: as plain expressions the
    # parser would run again for a filter on its result.
    kept = [c.alias(f"__kept_{k}") for k, c in enumerate(carry)]
    rows = df.select(F.col(column).alias("__text"), *kept, F.inline(F.array(event)))

    # The parser stops after the first JSON value; as array items, two show.
    items = F.json_array_length(F.concat(F.lit("["), F.col("__text"), F.lit("]")))
    faults = [F.col("after").isNull(), F.coalesce(items, F.lit(0)) != 1] + [
        F.col(f"after.`{f.name}`").isNull() for f in fields["after"].dataType if not f.nullable
    ]
    text = F.coalesce(F.col("__text"), F.lit(""))
    bad = F.when(reduce(lambda a, b: a | b, faults), text)
    names = df.select(*carry).columns if carry else []
    kept = [F.col(f"__kept_{k}").alias(name) for k, name in enumerate(names)]
    return rows.select(*fields.names, F.coalesce(F.col(REJECTED), bad).alias(REJECTED), *kept)


def accepted(events: DataFrame) -> DataFrame:
    return events.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(events: DataFrame) -> DataFrame:
    """Raw text of the messages that could not be parsed."""
    return events.filter(F.col(REJECTED).isNotNull()).select(REJECTED)


def flatten(events: DataFrame) -> DataFrame:
    """The columns of the after-image."""
    return events.select("after.*")
