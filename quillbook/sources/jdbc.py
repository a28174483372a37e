"""JDBC reads and writes through Spark's own data source."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")


@dataclass(frozen=True)
class Database:
    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}


@dataclass(frozen=True)
class Ranges:
    """How to split a read into parallel queries."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def retried(action: Callable[[], T], tries: int = 5, wait: float = 10.0) -> T:
    """Run an action again after a pause that doubles each time."""
    for attempt in range(tries):
        try:
            return action()
        except Exception:
            if attempt == tries - 1:
                raise
            time.sleep(wait * 2**attempt)
    raise ValueError("tries must be positive")


def read_options(
    database: Database,
    query: str | None = None,
    table: str | None = None,
    fetch_size: int = 10_000,
    ranges: Ranges | None = None,
) -> dict[str, str]:
    if (query is None) == (table is None):
        raise ValueError("name either a query or a table")
    options = database.options() | {"fetchsize": str(fetch_size)}
    if ranges is None:
        return options | ({"query": query} if query else {"dbtable": table})
    # Spark splits tables only, so a query is wrapped as one.
    return options | {"dbtable": table or f"({query}) q"} | ranges.options()


def read(spark: SparkSession, database: Database, tries: int = 5, **what) -> DataFrame:
    options = read_options(database, **what)
    return retried(lambda: spark.read.format("jdbc").options(**options).load(), tries)


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as small control queries are compared."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def write(
    df: DataFrame,
    database: Database,
    table: str,
    mode: str = "append",
    columns: list[str] | None = None,
    batch_size: int = 10_000,
    tries: int = 1,
) -> None:
    """Write to a table. Retrying an append is only safe when the target is keyed."""
    rows = df.select(*columns) if columns else df
    options = database.options() | {"dbtable": table, "batchsize": str(batch_size)}
    retried(lambda: rows.write.format("jdbc").options(**options).mode(mode).save(), tries)
