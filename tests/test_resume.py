"""Imports that stop and go on."""

import pytest
from pyspark.sql import functions as F

from rulefold.sources.ingest import TableImport
from rulefold.sources.resume import Ledger, imported_rows, resume_import, save_imported
from rulefold.sources.tables import FrameSource
from tests.helpers import rows_of


class Source(FrameSource):
    """Counts its reads and fails at one of them."""

    reads_by_range = True

    def __init__(self, tables, fail_at=None):
        super().__init__(tables)
        object.__setattr__(self, "reads", [])
        object.__setattr__(self, "fail_at", fail_at)

    def _note(self, what):
        if len(self.reads) == self.fail_at:
            raise ConnectionError
        self.reads.append(what)

    def read(self, spark, table):
        self._note((table, "whole"))
        return super().read(spark, table)

    def read_ids(self, spark, table, id_column, low, high, connections):
        self._note((table, low, high))
        return super().read_ids(spark, table, id_column, low, high, connections)

    def read_null_ids(self, spark, table, id_column):
        return super().read_null_ids(spark, table, id_column)


@pytest.fixture
def tables(spark):
    ids = [(i, f"p{i}") for i in [*range(1, 20), 35, 36]] + [(None, "none")]
    return {
        "findings": spark.createDataFrame(ids, "id long, package_name string"),
        "statuses": spark.createDataFrame([(1, "OPEN")], "key int, category string"),
        "findings_info": spark.createDataFrame([], "id long"),
    }


PLAN = [TableImport("findings", 2, 10), TableImport("statuses"), TableImport("findings_info", 2, 10)]


@pytest.mark.parametrize("fail_at", range(6))
def test_goes_on_wherever_it_stopped(spark, tables, tmp_path, fail_at):
    folder = f"file://{tmp_path}/ledger"
    first, second = Source(tables, fail_at), Source(tables)
    try:
        resume_import(spark, first, PLAN, folder)
    except ConnectionError:
        assert len(first.reads) == fail_at
    resume_import(spark, second, PLAN, folder)
    assert len(set(first.reads + second.reads)) == len(first.reads + second.reads) == 5  # none twice
    ledger = Ledger(spark, folder)
    assert rows_of(ledger.read("findings")) == rows_of(tables["findings"])
    assert rows_of(imported_rows(spark, folder, list(tables))) == [("findings", 22), ("findings_info", 0), ("statuses", 1)]
    assert resume_import(spark, Source(tables), PLAN, folder) == {"findings": 0, "statuses": 0, "findings_info": 0}


def test_a_part_that_broke_off_is_written_again(spark, tables, tmp_path):
    folder = f"file://{tmp_path}/ledger"
    resume_import(spark, Source(tables), PLAN, folder)
    (tmp_path / "ledger" / "findings" / "11_20" / "_SUCCESS").unlink()  # files, but no commit
    assert Ledger(spark, folder).read("findings").count() == 22 - 9
    again = Source(tables)
    assert resume_import(spark, again, PLAN, folder)["findings"] == 1 and again.reads == [("findings", 11, 20)]
    assert rows_of(Ledger(spark, folder).read("findings")) == rows_of(tables["findings"])


def test_later_ids_are_further_ranges(spark, tables, tmp_path):
    folder = f"file://{tmp_path}/ledger"
    resume_import(spark, Source(tables), PLAN, folder)
    grown = {**tables, "findings": tables["findings"].unionByName(spark.range(37, 50).select("id", F.lit("new").alias("package_name")))}
    source = Source(grown)
    assert resume_import(spark, source, [TableImport("findings", 2, 5)], folder) == {"findings": 3}
    assert source.reads[0] == ("findings", 37, 41)
    assert rows_of(Ledger(spark, folder).read("findings")) == rows_of(grown["findings"])


def test_caps_and_catalog_tables(spark, tables, tmp_path):
    folder = f"file://{tmp_path}/ledger"
    resume_import(spark, Source(tables), PLAN, folder, max_id=15)
    save_imported(spark, folder, PLAN, "resumed_")
    assert spark.table("resumed_findings").agg(F.max("id"), F.count("*")).first() == (15, 15)
    assert spark.table("resumed_statuses").count() == 1 and spark.table("resumed_findings_info").count() == 0
    with pytest.raises(LookupError):
        Ledger(spark, folder).read("tickets")
