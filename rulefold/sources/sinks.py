"""Writers: catalog tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _laid_out(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Few files per partition; adaptive execution splits what is too large for one task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    file_format: str = "parquet",
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Write a managed table. Overwriting replaces the schema too.

    ``file_format="delta"`` works where the session has it. ``bucket_by`` is a number of
    buckets and a column: tables bucketed alike join on that column without a shuffle. Rows
    are dealt by bucket before they are written, so that a batch makes one file per bucket.
    """
    if bucket_by:
        df = df.repartition(*bucket_by)
    writer = _laid_out(df, partition_by).write.format(file_format).mode(mode)
    if mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, column = bucket_by
        writer = writer.bucketBy(buckets, column).sortBy(column)
    writer.saveAsTable(name)


def save_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write files. Overwriting a partitioned path replaces only the partitions written."""
    writer = _laid_out(df, partition_by).write.format(file_format).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
