"""Readers: catalog tables, parquet folders and JDBC databases.

Readers return plain dictionaries of DataFrames by table name; nothing is read until
a query needs it, so filters and column pruning reach the scans.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulefold.schemas import TABLES, schema_of

# JDBC options of partitioned reads (times in seconds).
PARTITIONED_READ_OPTIONS = {
    "fetchsize": "50000",
    "queryTimeout": "1800",
    "loginTimeout": "120",
    "socketTimeout": "1800",
    "tcpKeepAlive": "true",
    "batchsize": "50000",
    "stringtype": "unspecified",
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Give ``df`` the table's declared columns and types; absent columns become NULL.

    Columns the schema does not know are kept, after the declared ones.
    """
    schema = schema_of(table)
    have = set(df.columns)
    declared = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return df.select(*declared, *[c for c in df.columns if c not in schema.names])


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema_of(table))


def catalog_tables(
    spark: SparkSession, prefix: str = "", names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    """The tables (or temp views) ``prefix + name`` that exist."""
    return {n: spark.table(prefix + n) for n in names if spark.catalog.tableExists(prefix + n)}


def parquet_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = TABLES
) -> dict[str, DataFrame]:
    """``folder/<name>`` read with the declared schemas, without inference."""
    return {n: spark.read.schema(schema_of(n)).parquet(f"{folder}/{n}") for n in names}


@dataclass(frozen=True)
class JdbcSource:
    """A relational database. ``table`` may be a name or an aliased subquery."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    reads_by_range: ClassVar[bool] = True

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """One connection."""
        return spark.read.jdbc(url=self.url, table=table, properties=dict(self.properties))

    def read_partitioned(
        self, spark: SparkSession, table: str, id_column: str, low: int, high: int, connections: int
    ) -> DataFrame:
        """``connections`` tasks, each reading a stride of ``[low, high]``."""
        return spark.read.jdbc(
            url=self.url,
            table=table,
            column=id_column,
            lowerBound=low,
            upperBound=high,
            numPartitions=connections,
            properties={**self.properties, **PARTITIONED_READ_OPTIONS},
        )

    def id_bounds(self, spark: SparkSession, table: str, id_column: str) -> tuple[int, int] | None:
        """Smallest and largest id, found by the database; None for an empty table."""
        query = f"(SELECT min({id_column}) AS low, max({id_column}) AS high FROM {table}) AS bounds"
        row = self.read(spark, query).first()
        return None if row["low"] is None else (int(row["low"]), int(row["high"]))

    def read_ids(
        self, spark: SparkSession, table: str, id_column: str, low: int, high: int, connections: int
    ) -> DataFrame:
        query = f"(SELECT * FROM {table} WHERE {id_column} BETWEEN {low} AND {high}) AS batch"
        return self.read_partitioned(spark, query, id_column, low, high, connections)

    def id_counts(
        self, spark: SparkSession, table: str, id_column: str, within: Sequence[tuple[int, int]], origin: int, width: int
    ) -> dict[int, int]:
        """Rows per slot of ``width`` ids, by the slot's first id, counted by the database."""
        inside = " OR ".join(f"{id_column} BETWEEN {low} AND {high}" for low, high in within)
        slots = f"SELECT {id_column} - MOD({id_column} - ({origin}), {width}) AS slot FROM {table} WHERE {inside}"
        query = f"(SELECT slot, count(*) AS table_rows FROM ({slots}) AS ids GROUP BY slot) AS counted"
        return {int(r["slot"]): int(r["table_rows"]) for r in self.read(spark, query).collect()}

    def read_ranges(
        self, spark: SparkSession, table: str, id_column: str, ranges: Sequence[tuple[int, int]]
    ) -> DataFrame:
        """One task per range."""
        conditions = [f"{id_column} BETWEEN {low} AND {high}" for low, high in ranges]
        properties = {**self.properties, **PARTITIONED_READ_OPTIONS}
        return spark.read.jdbc(url=self.url, table=table, predicates=conditions, properties=properties)

    def read_in_turn(
        self, spark: SparkSession, table: str, id_column: str, ranges: Sequence[tuple[int, int]], connections: int
    ) -> DataFrame:
        """Consecutive ranges over ``connections`` connections at a time: a task reads several, each
        with a statement of its own."""
        return self.read_ranges(spark, table, id_column, ranges).coalesce(connections)

    def has_null_ids(self, spark: SparkSession, table: str, id_column: str) -> bool:
        query = f"(SELECT count(*) AS missing FROM {table} WHERE {id_column} IS NULL) AS nulls"
        return self.read(spark, query).first()["missing"] > 0

    def read_null_ids(self, spark: SparkSession, table: str, id_column: str) -> DataFrame:
        """The rows no range holds, over one connection."""
        return self.read(spark, f"(SELECT * FROM {table} WHERE {id_column} IS NULL) AS batch")

    def read_empty(self, spark: SparkSession, table: str) -> DataFrame:
        return self.read(spark, f"(SELECT * FROM {table} WHERE 1 = 0) AS empty_{table}")


@dataclass(frozen=True)
class FrameSource:
    """DataFrames that stand in for a database, e.g. an export of its tables."""

    tables: Mapping[str, DataFrame]
    #: a range would scan the frame again: frames are written at once
    reads_by_range: ClassVar[bool] = False

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.tables[table]

    def id_bounds(self, spark: SparkSession, table: str, id_column: str) -> tuple[int, int] | None:
        row = self.tables[table].agg(F.min(id_column).alias("low"), F.max(id_column).alias("high")).first()
        return None if row["low"] is None else (int(row["low"]), int(row["high"]))

    def read_ids(
        self, spark: SparkSession, table: str, id_column: str, low: int, high: int, connections: int
    ) -> DataFrame:
        return self.tables[table].where(F.col(id_column).between(low, high))

    def id_counts(
        self, spark: SparkSession, table: str, id_column: str, within: Sequence[tuple[int, int]], origin: int, width: int
    ) -> dict[int, int]:
        slot = F.col(id_column) - F.pmod(F.col(id_column) - F.lit(origin), F.lit(width))
        counts = self.read_ranges(spark, table, id_column, within).groupBy(slot.alias("slot")).count()
        return {int(r["slot"]): r["count"] for r in counts.collect()}

    def read_ranges(
        self, spark: SparkSession, table: str, id_column: str, ranges: Sequence[tuple[int, int]]
    ) -> DataFrame:
        inside = [F.col(id_column).between(low, high) for low, high in ranges]
        return self.tables[table].where(reduce(Column.__or__, inside))

    def read_in_turn(
        self, spark: SparkSession, table: str, id_column: str, ranges: Sequence[tuple[int, int]], connections: int
    ) -> DataFrame:
        """Consecutive ranges in one scan."""
        return self.read_ids(spark, table, id_column, ranges[0][0], ranges[-1][1], connections)

    def has_null_ids(self, spark: SparkSession, table: str, id_column: str) -> bool:
        return not self.read_null_ids(spark, table, id_column).isEmpty()

    def read_null_ids(self, spark: SparkSession, table: str, id_column: str) -> DataFrame:
        return self.tables[table].where(F.col(id_column).isNull())

    def read_empty(self, spark: SparkSession, table: str) -> DataFrame:
        return self.tables[table].limit(0)


def parquet_source(spark: SparkSession, folder: str) -> FrameSource:
    """Every parquet file or folder in ``folder``, by name."""
    return FrameSource({p.stem: spark.read.parquet(str(p)) for p in Path(folder).glob("*.parquet")})
