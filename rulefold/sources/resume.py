"""Imports that go on where they stopped.

A ledger folder holds, per table, its plan (the id ranges, fixed by the first run) and one folder
per range. A range is finished when its folder has the mark that Spark's commit of a write leaves
there last; an unfinished one is written again from its start, in place. So no range is read
twice and no row is imported twice, wherever an import stopped. Ids above the planned ranges,
which the source got since, become further ranges of the next run.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulefold.schemas import id_column
from rulefold.sources.ingest import SMALL_TABLES, TableImport
from rulefold.sources.ranges import IdRange
from rulefold.sources.sinks import save_table

WHOLE, NO_ID = "whole", "no-id"
FINISHED = "_SUCCESS"


@dataclass(frozen=True)
class Ledger:
    """What has been imported, in a folder that all executors share."""

    spark: SparkSession
    folder: str

    def _path(self, *parts: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder.rstrip("/"), *parts]))

    def _files(self) -> Any:
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def planned(self, table: str) -> list[str] | None:
        """The parts of a table, None before its first run."""
        rows = f"{self.folder.rstrip('/')}/{table}/_plan"
        if not self._files().exists(self._path(table, "_plan", FINISHED)):
            return None
        return json.loads(self.spark.read.text(rows, wholetext=True).first()["value"])

    def plan(self, table: str, parts: Sequence[str]) -> None:
        row = self.spark.createDataFrame([(json.dumps(list(parts)),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{self.folder.rstrip('/')}/{table}/_plan")

    def is_finished(self, table: str, part: str) -> bool:
        return self._files().exists(self._path(table, part, FINISHED))

    def write(self, table: str, part: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder.rstrip('/')}/{table}/{part}")

    def read(self, table: str) -> DataFrame:
        """The finished parts of a table."""
        done = [p for p in self.planned(table) or [] if self.is_finished(table, p)]
        if not done:
            raise LookupError(f"no part of {table} has been imported")
        return self.spark.read.parquet(*(f"{self.folder.rstrip('/')}/{table}/{p}" for p in done))


def _name(ids: IdRange) -> str:
    return f"{ids.low}_{ids.high}"


def _parts(spark: SparkSession, source: Any, step: TableImport, ledger: Ledger, max_id: int | None) -> list[str]:
    """The parts of a table: those of earlier runs, then ranges of the ids above them."""
    known = ledger.planned(step.table) or []
    if step.connections == 1 or known == [WHOLE]:
        parts = [WHOLE]
    else:
        key = step.key or id_column(step.table)
        bounds = source.id_bounds(spark, step.table, key)
        upto = max((int(p.rpartition("_")[2]) for p in known if p != NO_ID), default=None)
        if bounds and upto is not None:
            bounds = (upto + 1, bounds[1])
        parts = known + [_name(ids) for ids in step.batches(spark, source, bounds, max_id)]
        if NO_ID not in parts and max_id is None and source.has_null_ids(spark, step.table, key):
            parts.append(NO_ID)
    if parts != known:
        ledger.plan(step.table, parts)
    return parts


def resume_import(
    spark: SparkSession, source: Any, plan: Sequence[TableImport], folder: str, max_id: int | None = None
) -> dict[str, int]:
    """Imports what is not finished yet; the number of parts read, by table.

    As ``import_findings``, but into ``Ledger(spark, folder)``. Each part is read in
    ``connections`` tasks and committed before the next one begins.
    """
    ledger, read = Ledger(spark, folder), {}
    for step in plan:
        key = step.key or id_column(step.table)
        cap = None if step.table in SMALL_TABLES else max_id
        read[step.table] = 0
        for part in _parts(spark, source, step, ledger, cap):
            if ledger.is_finished(step.table, part):
                continue
            if part == WHOLE:
                rows = source.read(spark, step.table)
            elif part == NO_ID:
                rows = source.read_null_ids(spark, step.table, key)
            else:
                low, _, high = part.rpartition("_")
                rows = step.read(spark, source, IdRange(int(low), int(high)))
            ledger.write(step.table, part, rows)
            read[step.table] += 1
        if not ledger.planned(step.table):
            ledger.plan(step.table, [WHOLE])
            ledger.write(step.table, WHOLE, source.read_empty(spark, step.table))
    return read


def save_imported(spark: SparkSession, folder: str, plan: Sequence[TableImport], prefix: str = "", file_format: str = "parquet") -> None:
    """The imported tables as catalog tables, laid out as their plan says."""
    ledger = Ledger(spark, folder)
    for step in plan:
        key = step.key or id_column(step.table)
        save_table(ledger.read(step.table), prefix + step.table, file_format=file_format, bucket_by=(step.buckets, key) if step.buckets else None)


def imported_rows(spark: SparkSession, folder: str, tables: Sequence[str]) -> DataFrame:
    """``table_name, table_rows`` of what is finished."""
    ledger = Ledger(spark, folder)
    counts = [ledger.read(t).agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(t).alias("table_name"), "table_rows") for t in tables]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
