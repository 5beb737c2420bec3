"""The findings tables, derived with Spark from the test tables.

Orders play the findings, customers the resources, line items whatever hangs off a
finding. Every frame grows with its source. ``checks.oracle`` states the same tables in
SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulefold.operators.skew import skew_join

# Types of the test tables, so that reading them infers nothing.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def finding_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders, customer, nation, region, lineitem, part = (
        source(spark, sf_dir, t)
        for t in ("orders", "customer", "nation", "region", "lineitem", "part")
    )
    return {
        "findings": findings(orders),
        "plain_resources": resources(customer, nation, region),
        "findings_scores": scores(orders),
        "user_status": user_status(orders),
        "statuses": statuses(orders),
        "aggregation_groups": existing_groups(orders),
        "finding_sla_rule_connections": lineitem.selectExpr(
            "CASE WHEN l_orderkey % 3 = 0 AND l_linenumber <= 2 THEN l_orderkey ELSE -1 - l_orderkey END AS finding_id"
        ),
        "findings_additional_data": additional_data(lineitem),
        "findings_info": orders.selectExpr(
            "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -1 - o_orderkey END AS id"
        ),
        "scoring_rules": nation.selectExpr("n_nationkey % 20 AS id", "n_nationkey % 6 AS selection_rule_id"),
        "selection_rules": nation.selectExpr("n_nationkey % 23 AS id", "n_regionkey AS scope_group"),
        "aggregation_rules_findings_excluder": excluder(orders),
        "resource_to_scopes": customer.selectExpr(
            "CASE WHEN c_custkey % 4 <> 0 THEN c_custkey ELSE -1 - c_custkey END AS resource_id",
            "CASE WHEN c_custkey % 8 = 1 THEN array() ELSE array(c_nationkey, c_nationkey + 1) END AS scope_ids",
        ),
        "scope_groups": nation.selectExpr("n_nationkey AS id", "concat('scope ', n_name) AS name"),
        "finding_ticket_associations": lineitem.selectExpr(
            "l_orderkey * 10 + l_linenumber AS id",
            "CASE WHEN l_returnflag = 'R' THEN l_orderkey ELSE -1 - l_orderkey END AS finding_id",
            "l_partkey AS ticket_id",
        ),
        "tickets": part.selectExpr("p_partkey - p_partkey % 2 AS id"),
        "user_sla": orders.selectExpr(
            "CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey ELSE -1 - o_orderkey END AS id"
        ),
    }


def findings(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS id",
        "CAST(o_orderkey % 4 AS int) AS datasource_id",
        "CAST(o_custkey % 3 AS int) AS datasource_definition_id",
        "o_orderstatus AS source",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS created_time",
        "date_format(date_add(CAST(o_orderdate AS date), CAST(o_orderkey % 10 AS int)), 'yyyy-MM-dd')"
        " AS discovered_time",
        "date_format(date_add(CAST(o_orderdate AS date), CAST(30 + o_orderkey % 7 AS int)), 'yyyy-MM-dd')"
        " AS last_reported_time",
        "CASE WHEN o_orderkey % 9 <> 0 THEN lower(o_orderstatus) END AS original_status",
        "CASE o_orderkey % 3 WHEN 0 THEN 'Cloud Security' WHEN 1 THEN 'Vulnerability' ELSE 'Identity' END"
        " AS category",
        "CASE WHEN o_orderkey % 5 <> 0 THEN concat('sub', o_orderkey % 8) END AS sub_category",
        "CASE WHEN o_orderkey % 13 <> 0 THEN concat('rule-', o_orderkey % 17) END AS rule_id",
        "CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS resource_reported_not_exist",
        "CASE WHEN o_orderkey % 7 = 0 THEN o_custkey END AS aggregation_group_id",
        "o_custkey AS main_resource_id",
        "nullif(o_orderpriority, '4-NOT SPECIFIED') AS package_name",
        "concat('img', o_custkey % 10) AS image_id",
        "CASE WHEN o_orderkey % 4 <> 0 THEN concat('scan', o_orderkey % 3) END AS scan_id",
        "CASE o_orderkey % 4 WHEN 0 THEN 'Agent Vulnerabilities' WHEN 1 THEN 'Image Vulnerabilities'"
        " WHEN 2 THEN 'Cloud Posture' ELSE 'Identity Risk' END AS finding_type_str",
        "CASE WHEN o_orderkey % 6 <> 0 THEN concat('KB', o_orderkey % 29) END AS fix_id",
        "concat('V', o_custkey % 5) AS fix_vendor_id",
        "CASE o_orderkey % 4 WHEN 0 THEN 'Patch' WHEN 1 THEN 'Upgrade' WHEN 2 THEN 'Config' END AS fix_type",
        "CASE WHEN o_orderkey % 8 < 3 THEN 'Security Updates' WHEN o_orderkey % 8 < 6 THEN 'Other' END"
        " AS fix_subtype",
        "concat('T', o_orderkey % 2) AS rule_type",
        "CASE o_orderkey % 5 WHEN 0 THEN 'Malware' WHEN 1 THEN 'Suspicious_activity'"
        " WHEN 2 THEN 'Misconfiguration' WHEN 3 THEN 'Exposure' END AS rule_family",
        "o_orderkey % 6 = 1 AS cisa_kev",
        "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END AS is_fixable",
        "CAST(o_orderdate AS date) AS vulnerability_reported_date",
    )


def resources(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return placed.selectExpr(
        "c_custkey AS id",
        "c_mktsegment AS r1_resource_type",
        "c_name AS r1_resource_name",
        "r_name AS cloud_provider",
        "CASE WHEN c_custkey % 10 <> 0 THEN n_name END AS cloud_account",
        "concat('acct ', n_name) AS cloud_account_friendly_name",
        "array(c_mktsegment, r_name) AS tags_values",
        "CASE WHEN c_custkey % 12 <> 0 THEN"
        " array(concat('Segment:', c_mktsegment), concat('Region:', r_name)) END AS tags_key_values",
    )


def scores(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS finding_id",
        "CAST(o_orderkey % 100 AS string) AS original_score",
        "CAST(o_orderkey % 1000 AS double) AS normalized_score",
        "CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 20 END AS scoring_rule_id",
        "CAST(o_orderkey % 500 AS double) AS factorized_score",
        "CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_orderkey % 10 AS double) END AS user_score",
        "o_totalprice AS score",
        "CAST(o_orderkey % 5 AS int) AS severity",
    )


def user_status(orders: DataFrame) -> DataFrame:
    key = "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END"
    return orders.selectExpr(
        "o_orderkey AS id",
        f"{key} AS system_status_key",
        f"CASE WHEN o_orderkey % 3 = 0 THEN CAST(10 * ({key}) + o_orderkey % 4 AS int) END AS user_status_key",
        f"{key} AS actual_status_key",
    )


def statuses(orders: DataFrame) -> DataFrame:
    return orders.select("o_orderstatus").distinct().selectExpr(
        "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS key",
        "CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FIXED' ELSE 'IGNORED' END AS category",
    )


def existing_groups(orders: DataFrame) -> DataFrame:
    """One per customer with grouped orders, but for one customer in five: those dangle. All
    other orders make groups, under negative ids, that no finding names."""
    named = F.expr("CASE WHEN o_orderkey % 7 = 0 AND o_custkey % 5 <> 4 THEN o_custkey ELSE -1000000000 - o_custkey END")
    return (
        orders.groupBy(named.alias("id"))
        .agg(F.min("o_orderkey").alias("main_finding_id"))
        .selectExpr(
            "id",
            "main_finding_id",
            "md5(concat_ws('-', 'group', CAST(id AS string))) AS group_identifier",
            "id % 3 = 0 AS is_locked",
        )
    )


def with_package_groups(groups: DataFrame, findings: DataFrame) -> DataFrame:
    """The existing groups and one more per package and source, locked for one source."""
    packages = (
        findings.where("package_name IS NOT NULL")
        .groupBy("package_name", "source")
        .agg(F.min("id").alias("main_finding_id"))
        .selectExpr(
            "-1 - main_finding_id AS id",
            "main_finding_id",
            "md5(concat_ws('-', '1', package_name)) AS group_identifier",
            "source <> 'F' AS is_locked",
        )
    )
    return groups.unionByName(packages)


def additional_data(lineitem: DataFrame) -> DataFrame:
    cves = F.collect_set(
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("CVE-"), F.col("l_partkey") % 50))
    )
    return lineitem.groupBy(F.col("l_orderkey").alias("finding_id")).agg(F.array_sort(cves).alias("cve"))


def excluder(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey ELSE -1 - o_orderkey END AS finding_id",
        "CAST(101 + o_orderkey % 3 AS int) AS aggregation_rule_id",
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's segment and nation."""
    orders, customer, nation = (source(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    customers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_name", "n_regionkey"
    )
    return skew_join(orders, customers, "o_custkey", "c_custkey", "inner", "o_orderkey")


def published_groups(placed: DataFrame) -> DataFrame:
    """Groups of an earlier run over (source, account): some missing, locked or outdated."""
    return (
        placed.groupBy("o_orderstatus", "n_name")
        .agg(F.min("o_orderkey").alias("id"))
        .selectExpr(
            "id",
            "id AS main_finding_id",
            "md5(concat_ws('-', CASE WHEN id % 5 = 1 OR id % 4 = 0 THEN 'gone' ELSE '0' END, o_orderstatus, n_name))"
            " AS group_identifier",
            "id % 3 = 0 AS is_locked",
        )
    )
