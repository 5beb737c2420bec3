"""Import, rules, readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from checks import registry
from rulefold import Rule, group_findings, load_rules, parse_rules, publish_files, publish_tables, read_rules_file
from rulefold.plans.runs import export_updates
from rulefold.sources import ingest
from rulefold.sources.ingest import GROWING_TABLES, IdRange, TableImport, id_ranges, import_findings, import_plan
from rulefold.sources.rules import load_rules_by_tenant
from rulefold.sources.sinks import save_table
from rulefold.sources.tables import FrameSource, JdbcSource, catalog_tables, conform, empty_table, parquet_source, parquet_tables
from tests.helpers import rows_of, small_tables, table


class RecordingReader:
    """Stands in for a session; remembers what would be read over JDBC."""

    def __init__(self, answer=None):
        self.calls, self.read, self.answer = [], self, answer

    def jdbc(self, **options):
        self.calls.append(options)
        return self

    def first(self):
        return self.answer


def test_jdbc_reads_state_their_options():
    source = JdbcSource("jdbc:x", {"user": "u"})
    spark = RecordingReader({"low": 3, "high": 9})
    source.read(spark, "statuses")
    assert spark.calls.pop() == {"url": "jdbc:x", "table": "statuses", "properties": {"user": "u"}}
    source.read_ids(spark, "findings", "id", 5, 8, 32)
    call = spark.calls.pop()
    assert call["table"] == "(SELECT * FROM findings WHERE id BETWEEN 5 AND 8) AS batch"
    assert (call["column"], call["lowerBound"], call["upperBound"], call["numPartitions"]) == ("id", 5, 8, 32)
    assert call["properties"] == {
        "user": "u", "fetchsize": "50000", "queryTimeout": "1800", "loginTimeout": "120",
        "socketTimeout": "1800", "tcpKeepAlive": "true", "batchsize": "50000", "stringtype": "unspecified",
    }
    assert source.id_bounds(spark, "findings", "id") == (3, 9)
    assert source.id_bounds(RecordingReader({"low": None, "high": None}), "findings", "id") is None
    assert source.properties == {"user": "u"}


def test_id_ranges_cover_every_id_once():
    assert id_ranges((3, 11), 4) == [IdRange(3, 6), IdRange(7, 10), IdRange(11, 11)]
    assert id_ranges((3, 11), 4, max_id=8) == [IdRange(3, 6), IdRange(7, 8)]
    assert id_ranges((0, 0), 4) == [IdRange(0, 0)]
    assert id_ranges(None, 4) == [] and id_ranges((5, 9), 4, max_id=2) == []


def test_the_import_plan_has_18_tables_by_size():
    plan = import_plan()
    assert len(plan) == 18
    assert [s.table for s in plan if s.batch_size] == [
        "findings", "findings_scores", "user_status", "findings_info", "findings_additional_data", "plain_resources",
        "finding_ticket_associations", "tickets", "aggregation_groups", "aggregation_rules_findings_excluder",
        "resource_to_scopes", "user_sla",
    ]
    assert {(s.connections, s.batch_size) for s in plan} == {(32, 3_200_000), (4, None), (1, None)}


class RangedSource(FrameSource):
    """Frames read range by range, as a database is."""

    reads_by_range = True


def test_frames_are_written_at_once(spark):
    tables = small_tables(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS at_once")
    plan = [TableImport("findings", 4, 3), TableImport("user_sla", 4, 3), TableImport("resource_to_scopes", 4, 3, key="resource_id")]
    batches = import_findings(spark, FrameSource(tables), "at_once.", plan, max_id=6)
    assert batches == {"findings": 1, "user_sla": 1, "resource_to_scopes": 1}
    assert rows_of(spark.table("at_once.findings"), "id") == [(n,) for n in range(1, 7)]


def test_import_keeps_every_batch(spark):
    tables = small_tables(spark)
    tables["findings_info"] = table(spark, "findings_info", [{"id": 0}])
    spark.sql("CREATE DATABASE IF NOT EXISTS imported")
    plan = [TableImport("findings", 4, 3), TableImport("findings_info", 4, 3), TableImport("user_sla", 4, 3),
            TableImport("finding_sla_rule_connections", 4), TableImport("statuses")]
    batches = import_findings(spark, RangedSource(tables), "imported.", plan)
    assert batches == {"findings": 4, "findings_info": 1, "user_sla": 0, "finding_sla_rule_connections": 0, "statuses": 1}
    stored = catalog_tables(spark, "imported.")
    assert set(stored) == set(batches)
    assert rows_of(stored["findings"], "id") == rows_of(tables["findings"], "id")
    assert stored["findings_info"].count() == 1
    assert stored["user_sla"].columns == tables["user_sla"].columns and stored["user_sla"].count() == 0
    # again, with a cap: nothing of the first import stays
    import_findings(spark, RangedSource(tables), "imported.", plan[:1], max_id=5)
    assert rows_of(spark.table("imported.findings"), "id") == [(1,), (2,), (3,), (4,), (5,)]


@pytest.mark.parametrize("options", [{"batch_size": 1}, {"rows_per_batch": 1}])
def test_many_narrow_batches_share_a_bounded_number_of_writes(spark, monkeypatch, options):
    ids = [None, *range(-7, 40, 2), 39, 39]
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(ids)], "id long, number long")
    spark.sql("CREATE DATABASE IF NOT EXISTS narrow")
    writes = []
    monkeypatch.setattr(ingest, "save_table", lambda *a, **k: (writes.append(k["mode"]), save_table(*a, **k)))
    step = TableImport("findings", 4, **options)
    batches = step.run(spark, RangedSource({"findings": rows}), "narrow.")
    assert batches == 1 + len(step.batches(spark, RangedSource({"findings": rows}), (-7, 39))) > 20
    assert writes == ["overwrite"] + ["append"] * (len(writes) - 1) and len(writes) <= ingest.WRITES_PER_TABLE + 1
    assert rows_of(spark.table("narrow.findings")) == rows_of(rows)


def test_batches_that_share_a_write_are_read_over_as_many_connections():
    class Reader(RecordingReader):
        def coalesce(self, number):
            self.calls.append(number)
            return self

    spark = Reader()
    TableImport("findings", 2, 10).read_batches(spark, JdbcSource("jdbc:x"), [IdRange(1, 10), IdRange(11, 20), IdRange(21, 25)])
    at_once, call = spark.calls.pop(), spark.calls.pop()
    assert at_once == 2
    assert call["predicates"] == [f"id BETWEEN {n} AND {min(n + 4, 25)}" for n in range(1, 26, 5)]


@pytest.mark.parametrize("ranged", [True, False])
def test_a_capped_import_keeps_every_row_of_the_growing_tables(spark, ranged):
    keys = (2, 7, 30, None)
    tables = {
        t: spark.createDataFrame([(k, f"row {n}") for n, k in enumerate(keys)], f"{key} long, extra string")
        for t, key in GROWING_TABLES.items()
    } | {"findings": spark.createDataFrame([(k,) for k in keys], "id long")}
    tables["tickets"] = tables["tickets"].where("id > 5 OR id IS NULL")
    tables["user_sla"] = tables["user_sla"].where("id IS NULL")
    database = f"capped_{ranged}".lower()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    plan = [s for s in import_plan(10, 4) if s.table in tables]
    source = (RangedSource if ranged else FrameSource)(tables)
    import_findings(spark, source, f"{database}.", plan, max_id=5)
    for name, df in tables.items():
        kept = df if name in GROWING_TABLES else df.where("id <= 5")
        assert rows_of(spark.table(f"{database}.{name}")) == rows_of(kept)
    # without a cap, no table loses rows
    import_findings(spark, source, f"{database}.", plan)
    assert rows_of(spark.table(f"{database}.findings")) == rows_of(tables["findings"])


def test_bucketed_imports_join_by_id_without_shuffling_the_tables(spark, no_broadcast):
    tables = small_tables(spark)
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    plan = [s for s in import_plan(4, 4, buckets=4) if s.table in ("findings_scores", "user_status")]
    assert import_findings(spark, RangedSource(tables), "bucketed.", plan) == {"findings_scores": 3, "user_status": 3}
    scores, status = spark.table("bucketed.findings_scores"), spark.table("bucketed.user_status")
    joined = scores.join(status, scores["finding_id"] == status["id"])
    assert joined.count() == 10
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()


def test_overwriting_a_table_replaces_its_schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS replaced")
    save_table(spark.range(3), "replaced.t")
    save_table(spark.range(2).selectExpr("id AS other"), "replaced.t")
    assert spark.table("replaced.t").columns == ["other"]


def test_parquet_folders_are_read_with_the_declared_schemas(spark, tmp_path):
    tables = small_tables(spark)
    tables["findings"].select("id", "package_name").write.parquet(str(tmp_path / "findings"))
    got = parquet_tables(spark, str(tmp_path), ["findings"])["findings"]
    assert len(got.columns) == 32 and got.where("package_name = 'lib-c'").count() == 4
    spark.range(2).write.parquet(str(tmp_path / "other.parquet"))
    assert list(parquet_source(spark, str(tmp_path)).tables) == ["other"]


def test_conform_casts_adds_and_keeps(spark):
    df = spark.createDataFrame([("7", "x")], "id string, is_fixable string")
    got = conform(df, "findings")
    assert got.columns[0] == "id" and got.columns[-1] == "is_fixable" and len(got.columns) == 33
    assert dict(got.dtypes)["id"] == "bigint" and got.first()["title"] is None
    assert empty_table(spark, "tickets").columns == conform(spark.range(0), "tickets").columns


RULE_ROWS = [
    (3, 20, "AGG", json.dumps({"group_by": ["a"], "filters_config": {"x": "y"}}), False, None),
    (1, 10, "AGG", json.dumps({"group_by": None, "field_calculation": {"k": 1}}), True, False),
    (2, None, "AGG", None, None, True),
    (4, 5, "OTHER", "{}", False, False),
    (5, 20, "AGG", " ", False, False),
]
RULE_SCHEMA = "id int, `order` int, type string, aggregation_query string, disabled boolean, is_deleted boolean"


def test_rules_load_in_order_from_a_table(spark):
    rules = spark.createDataFrame(RULE_ROWS, RULE_SCHEMA)
    loaded = load_rules(rules)
    assert [r.id for r in loaded] == [1, 3, 5, 2]
    assert loaded[1] == Rule(3, 20, ("a",), {"x": "y"})
    assert loaded[0].group_by == () and loaded[0].field_calculation == {"k": 1}
    assert [r.id for r in load_rules(rules, active_only=True)] == [3, 5]
    by_tenant = load_rules_by_tenant(rules.withColumn("tenant", F.expr("id % 2")))
    assert {t: [r.id for r in some] for t, some in by_tenant.items()} == {0: [2], 1: [1, 3, 5]}


def test_rules_parse_from_files(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps([{"group_by": ["findings.a"], "finding_filter": "a=1"}, {}]))
    first, second = read_rules_file(str(path))
    assert first.group_by == ("findings.a",) and first.sql_filter == "a=1" and (second.id, second.order) == (1, 1)
    assert parse_rules('{"group_by": ["b"]}')[0].group_by == ("b",)


def tenant_run(spark, names):
    df = spark.createDataFrame(
        [(t, n, "p", "a") for t in names for n in range(3)],
        "tenant string, finding_id long, package_name string, cloud_account string",
    )
    return group_findings(df, [Rule(1, 1, ("package_name",))], tenant="tenant")


def test_publishing_files_replaces_only_the_tenants_of_the_run(spark, tmp_path):
    publish_files(tenant_run(spark, ["one", "two"]), str(tmp_path), tenant="tenant")
    before = rows_of(spark.read.parquet(str(tmp_path / "finding_group_association")))
    publish_files(tenant_run(spark, ["two"]), str(tmp_path), tenant="tenant")
    assert rows_of(spark.read.parquet(str(tmp_path / "finding_group_association"))) == before and len(before) == 6
    assert spark.read.parquet(str(tmp_path / "finding_group_rollup")).count() == 2


def test_publishing_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS published")
    publish_tables(tenant_run(spark, ["one", "two"]), "published.", tenant="tenant")
    publish_tables(tenant_run(spark, ["two"]), "published.")
    assert spark.table("published.finding_group_association").count() == 3
    assert spark.table("published.finding_group_rollup").count() == 1


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_change_plans_are_exported_by_kind(spark, tmp_path, file_format):
    plan = spark.createDataFrame([("a", "new"), ("b", "vanished")], "group_identifier string, change string")
    export_updates(plan, str(tmp_path), file_format)
    assert {p.name for p in tmp_path.iterdir() if p.is_dir()} == {"change=new", "change=vanished"}


def test_the_import_query_reads_ranges_and_compares_all_columns(spark, monkeypatch):
    read_ids, calls = FrameSource.read_ids, []

    def damaged(self, session, name, key, low, high, connections):
        calls.append(name)
        batch = read_ids(self, session, name, key, low, high, connections)
        return batch.withColumn("source", F.lit("?")) if name == "findings" else batch

    monkeypatch.setattr(FrameSource, "read_ids", damaged)
    ids = {r.table_name: r.ids for r in registry.import_round_trip(spark, "/root/testdata/sf0.01").collect()}
    assert calls.count("findings") == 5 and calls.count("findings_info") == 1
    assert ids["findings"] is None and ids["findings_info"] is not None
