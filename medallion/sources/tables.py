"""Relational tables to ingest from."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(\.[A-Za-z_][A-Za-z0-9_$]*)*")
FETCH_SIZE = "10000"


class TableSource(Protocol):
    """A place that has tables and can answer a query."""

    def table(self, name: str) -> DataFrame: ...

    def query(self, text: str, name: str | None = None) -> DataFrame: ...


@dataclass(frozen=True)
class CatalogSource:
    """Tables and views of the session's catalog."""

    spark: SparkSession

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def query(self, text: str, name: str | None = None) -> DataFrame:
        return self.spark.sql(text)


@dataclass(frozen=True)
class Split:
    """Parallel read of one table in ``tasks`` ranges of ``column``. The bounds
    only shape the ranges, rows outside them are read too; without them they
    are asked from the database."""

    column: str
    tasks: int
    lower: Any = None
    upper: Any = None


@dataclass(frozen=True)
class RemainderSplit:
    """Parallel read by the remainder of an integer ``column``: tasks of equal
    size also where most ids crowd in one range. Each task may cost the database
    a full scan."""

    column: str
    tasks: int

    def predicates(self) -> list[str]:
        column = _identifier(self.column)
        parts = [f"ABS(MOD({column}, {self.tasks})) = {i}" for i in range(self.tasks)]
        return [f"{parts[0]} OR {column} IS NULL", *parts[1:]]


@dataclass(frozen=True)
class QuantileSplit:
    """Parallel read in ranges of a numeric ``column`` that hold about equally many rows,
    wherever its values crowd. The database is asked for that column once; then each task reads
    a range, which an index on the column serves. ``error`` is the share of rows by which a
    range may differ."""

    column: str
    tasks: int
    error: float = 0.001

    def bounds(self, values: DataFrame) -> list[float]:
        """Where one range ends and the next begins, for the values of a one-column frame."""
        name, kind = values.columns[0], values.schema[0].dataType
        shares = [k / self.tasks for k in range(1, self.tasks)]
        if not isinstance(kind, T.NumericType):
            raise ValueError(f"{self.column}: {kind.simpleString()} has no quantiles")
        if isinstance(kind, T.DecimalType):
            values = values.select(F.col(f"`{name}`").cast("double").alias(name))
        found = values.approxQuantile(name, shares, self.error) if shares else []
        whole = isinstance(kind, T.IntegralType)
        return sorted({int(b) if whole else b for b in found})

    def predicates(self, bounds: list[float]) -> list[str]:
        """Ranges that hold every row once; a value that fills several ranges is one of its own."""
        column = _identifier(self.column)
        if not bounds:
            return ["1 = 1"]
        below = [f"{column} < {bounds[0]} OR {column} IS NULL"]
        pairs = zip(bounds, bounds[1:], strict=False)
        inner = [f"{column} >= {a} AND {column} < {b}" for a, b in pairs]
        return [*below, *inner, f"{column} >= {bounds[-1]}"]


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database. Predicates and column choice on the returned frame
    are pushed into the database by Spark."""

    spark: SparkSession
    url: str
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split | RemainderSplit | QuantileSplit] = field(default_factory=dict)

    def common_options(self) -> dict[str, str]:
        chosen = {"url": self.url, "fetchsize": FETCH_SIZE}
        if self.driver:
            chosen["driver"] = self.driver
        return {**chosen, **self.options}

    def table_options(self, name: str, split: Split | None = None) -> dict[str, str]:
        chosen = {**self.common_options(), "dbtable": _identifier(name)}
        if split is not None:
            chosen |= {
                "partitionColumn": _identifier(split.column),
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.tasks),
            }
        return chosen

    def query_options(
        self, text: str, split: Split | RemainderSplit | QuantileSplit | None = None
    ) -> dict[str, str]:
        if not isinstance(split, Split) or split.lower is None:
            return {**self.common_options(), "query": text}
        return {
            **self.common_options(),
            "dbtable": f"({text}) split_query",
            "partitionColumn": _identifier(split.column),
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.tasks),
        }

    def table(self, name: str) -> DataFrame:
        split = self.splits.get(name)
        if isinstance(split, RemainderSplit):
            return self._in_parts(name, split.predicates())
        if isinstance(split, QuantileSplit):
            values = self.query(f"SELECT {_identifier(split.column)} FROM {_identifier(name)}")
            return self._in_parts(name, split.predicates(split.bounds(values)))
        if split is not None and split.lower is None:
            split = self._bounded(name, split)
        reader = self.spark.read.format("jdbc")
        return reader.options(**self.table_options(name, split)).load()

    def _in_parts(self, name: str, predicates: list[str]) -> DataFrame:
        """The table with a task for each predicate."""
        properties = self.common_options()
        url = properties.pop("url")
        return self.spark.read.jdbc(
            url, _identifier(name), predicates=predicates, properties=properties
        )

    def query(self, text: str, name: str | None = None) -> DataFrame:
        """A query's rows, by one task unless there is a ``Split`` with bounds for ``name``."""
        options = self.query_options(text, self.splits.get(name) if name else None)
        return self.spark.read.format("jdbc").options(**options).load()

    def _bounded(self, name: str, split: Split) -> Split | None:
        """Ask the database for the range of the split column; an empty table
        needs no split."""
        column = _identifier(split.column)
        low, high = self.query(
            f"SELECT MIN({column}) AS low_value, MAX({column}) AS high_value "
            f"FROM {_identifier(name)}"
        ).first()
        return None if low is None else Split(split.column, split.tasks, low, high)


def _identifier(name: str) -> str:
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain table or column name: {name!r}")
    return name
