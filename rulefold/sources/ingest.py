"""Import of the findings tables from a database into the catalog."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulefold.schemas import id_column
from rulefold.sources.ranges import IdRange, equal_ranges, id_ranges
from rulefold.sources.sinks import save_table

# The import plan. Large tables are read in id ranges, medium ones over
# a few connections, small ones over one.
LARGE_TABLES = [
    "findings", "findings_scores", "user_status", "findings_info",
    "findings_additional_data", "plain_resources",
]
MEDIUM_TABLES = ["finding_sla_rule_connections"]
SMALL_TABLES = [
    "statuses", "aggregation_groups", "aggregation_rules",
    "aggregation_rules_findings_excluder", "scoring_rules", "selection_rules",
    "resource_to_scopes", "scope_groups", "finding_ticket_associations", "tickets",
    "user_sla",
]
# Of the small tables, those that grow with the findings, and the column to range over:
# one connection would read the whole of each in one task.
GROWING_TABLES = {
    "finding_ticket_associations": "id", "tickets": "id", "aggregation_groups": "id",
    "aggregation_rules_findings_excluder": "finding_id", "resource_to_scopes": "resource_id",
    "user_sla": "id",
}
IDS_PER_BATCH = 3_200_000
CONNECTIONS_PER_BATCH = 32
MEDIUM_CONNECTIONS = 4
# A write lists all files of its table, so that one per batch would take time with the square of
# the batches: from here on, consecutive batches share one.
WRITES_PER_TABLE = 8


@dataclass(frozen=True)
class TableImport:
    """How one table is read: in ranges of ``batch_size`` ids, or whole where that is None.

    ``rows_per_batch`` replaces ranges of equal width by batches of about so many rows, each read
    in ``connections`` ranges of about as many rows: on sparse ids no task is empty and none reads
    a multiple of the others. ``buckets`` stores the table bucketed by its id column. ``key`` is the column to range
    over where that is not the id column of the schema.
    """

    table: str
    connections: int = 1
    batch_size: int | None = None
    buckets: int | None = None
    key: str | None = None
    rows_per_batch: int | None = None

    def batches(
        self, spark: SparkSession, source, bounds: tuple[int, int] | None, max_id: int | None = None
    ) -> list[IdRange]:
        """The id ranges of the table's batches, in order and without gaps within ``bounds``."""
        if bounds is None or (max_id is not None and max_id < bounds[0]):
            return []
        low, high = bounds[0], bounds[1] if max_id is None else min(bounds[1], max_id)
        if high < low:
            return []
        if self.rows_per_batch is None:
            return id_ranges((low, high), self.batch_size or max(high - low + 1, 1))
        counts = partial(source.id_counts, spark, self.table, self.key or id_column(self.table))
        return equal_ranges(counts, IdRange(low, high), rows=self.rows_per_batch)

    def read(self, spark: SparkSession, source, ids: IdRange) -> DataFrame:
        """One batch, in ``connections`` tasks."""
        key = self.key or id_column(self.table)
        if self.rows_per_batch is None:
            return source.read_ids(spark, self.table, key, ids.low, ids.high, self.connections)
        parts = equal_ranges(partial(source.id_counts, spark, self.table, key), ids, ranges=self.connections)
        return source.read_ranges(spark, self.table, key, [(p.low, p.high) for p in parts])

    def read_batches(self, spark: SparkSession, source, batches: Sequence[IdRange]) -> DataFrame:
        """Consecutive batches at once, in ``connections`` tasks that read one range after another:
        ranges are as narrow, and as many are open at a time, as in a batch alone."""
        if len(batches) == 1:
            return self.read(spark, source, batches[0])
        key = self.key or id_column(self.table)
        ids, strides = IdRange(batches[0].low, batches[-1].high), self.connections * len(batches)
        if self.rows_per_batch is None:
            parts = id_ranges((ids.low, ids.high), max(1, ceil((ids.high - ids.low + 1) / strides)))
        else:
            parts = equal_ranges(partial(source.id_counts, spark, self.table, key), ids, ranges=strides)
        return source.read_in_turn(spark, self.table, key, [(p.low, p.high) for p in parts], self.connections)

    def run(self, spark: SparkSession, source, prefix: str = "", max_id: int | None = None,
            file_format: str = "parquet") -> int:
        """Import the table and return the number of batches written.

        The first batch replaces the table and the others append to it, over ``WRITES_PER_TABLE``
        batches several at a time. What is written at once is committed as a whole or not at all, so an import that stopped is run again
        from its start and leaves no row twice. ``max_id`` holds for large and medium
        tables; small ones are imported whole, also where they are read in ranges. Where no
        cap holds, rows without a key are a batch of their own.
        """
        target = prefix + self.table
        if self.table in SMALL_TABLES:
            max_id = None
        if self.connections == 1:
            save_table(source.read(spark, self.table), target, file_format=file_format)
            return 1
        key = self.key or id_column(self.table)
        layout = {"file_format": file_format, "bucket_by": (self.buckets, key) if self.buckets else None}
        if not source.reads_by_range:
            whole = source.read(spark, self.table)
            save_table(whole if max_id is None else whole.where(F.col(key) <= max_id), target, **layout)
            return 1
        bounds = source.id_bounds(spark, self.table, key)
        batches = self.batches(spark, source, bounds, max_id)
        size = ceil(len(batches) / WRITES_PER_TABLE) or 1
        writes = [self.read_batches(spark, source, batches[n : n + size]) for n in range(0, len(batches), size)]
        keyless = max_id is None and source.has_null_ids(spark, self.table, key)
        if keyless:
            writes.append(source.read_null_ids(spark, self.table, key))
        if not writes:
            save_table(source.read_empty(spark, self.table), target, **layout)
        for number, rows in enumerate(writes):
            mode = "overwrite" if number == 0 else "append"
            save_table(rows, target, mode=mode, **layout)
        return len(batches) + int(keyless)


def import_plan(
    ids_per_batch: int = IDS_PER_BATCH,
    connections: int = CONNECTIONS_PER_BATCH,
    buckets: int | None = None,
) -> list[TableImport]:
    """All tables; those that grow are read in ranges. With ``buckets`` (the session's number of shuffle partitions), the large
    and medium ones are stored bucketed by id, so the base view does not shuffle them."""
    return [
        *[TableImport(t, connections, ids_per_batch, buckets) for t in LARGE_TABLES],
        *[TableImport(t, MEDIUM_CONNECTIONS, None, buckets) for t in MEDIUM_TABLES],
        *[TableImport(t, connections, ids_per_batch, key=k) for t, k in GROWING_TABLES.items()],
        *[TableImport(t) for t in SMALL_TABLES if t not in GROWING_TABLES],
    ]


def import_findings(
    spark: SparkSession,
    source,
    prefix: str = "",
    plan: list[TableImport] | None = None,
    max_id: int | None = None,
    file_format: str = "parquet",
) -> dict[str, int]:
    """Import every table of the plan; returns the batches written by table.

    ``max_id`` caps the ids of large and medium tables only.
    """
    steps = plan if plan is not None else import_plan()
    return {step.table: step.run(spark, source, prefix, max_id, file_format) for step in steps}

