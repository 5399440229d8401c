"""JDBC tables."""

from __future__ import annotations

import math
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from plumbline.functions.constants import BULK_BATCH


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with a column of numbers, dates or times it is read by ``partitions`` parallel range queries.

    The database itself is asked for the range first (one row), so that no part is left with most of the table by a
    stale bound. Spark pushes filters and columns into the queries.
    """
    properties = properties or {}
    if column is None or partitions <= 1:
        return spark.read.jdbc(url, table, properties=properties)
    query = f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds"
    low, high = spark.read.jdbc(url, query, properties=properties).first()
    if low is None or low == high:
        return spark.read.jdbc(url, table, properties=properties)
    dated = isinstance(low, date)  # a timestamp is one too
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=str(low) if dated else math.floor(Decimal(low)),
        upperBound=str(high) if dated else math.floor(Decimal(high)) + 1,
        numPartitions=partitions,
        properties=properties,
    )


def write_jdbc_overwrite(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, truncate: bool = True
) -> None:
    """Replace the rows of a table in bulk batches; ``truncate`` keeps the table itself."""
    writer = df.write.mode("overwrite").option("truncate", truncate).option("batchsize", BULK_BATCH)
    writer.jdbc(url, table, properties=properties or {})


class JdbcTables:
    """A database, usable as source or target of a copy.

    A table is read in parts along its split column; one without any is refused, unless it is listed in ``small``.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str] | None = None,
        split_columns: dict[str, str] | None = None,
        partitions: int = 16,
        small: tuple[str, ...] = (),
    ):
        self.spark, self.url, self.properties = spark, url, properties or {}
        self.split_columns, self.partitions, self.small = split_columns or {}, partitions, small

    def read(self, table: str) -> DataFrame:
        if table not in self.split_columns and table not in self.small:
            raise ValueError(f"{table} needs a split column")
        return read_jdbc_table(
            self.spark, self.url, table, self.properties, self.split_columns.get(table), self.partitions
        )

    def overwrite(self, df: DataFrame, table: str) -> None:
        write_jdbc_overwrite(df, self.url, table, self.properties)
