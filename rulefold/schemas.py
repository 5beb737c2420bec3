"""Table schemas of the findings model: the tables that are read and the two
that are published.

Ids are 64-bit, because a store of this size outgrows 32-bit keys, and tags are
arrays of text, because rules test them with array conditions.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID_COLUMN = "id_column"
ALIAS = "alias"

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "strings": T.ArrayType(T.StringType()),
    "longs": T.ArrayType(T.LongType()),
}


def _table(columns: str, id_column: str | None = None, **aliases: str) -> T.StructType:
    """Build a schema from ``name:type`` words; untyped names are strings."""
    fields = []
    for word in columns.split():
        name, _, kind = word.partition(":")
        metadata = {}
        if name == id_column:
            metadata[ID_COLUMN] = True
        if name in aliases:
            metadata[ALIAS] = aliases[name]
        fields.append(T.StructField(name, _TYPES[kind or "string"], True, metadata))
    return T.StructType(fields)


# Table names, column names, their order, id columns and the names
# the id and type columns take in the joined view.
TABLES: dict[str, T.StructType] = {
    "findings": _table(
        """
        id:long datasource_id:int datasource_definition_id:int title source
        finding_id_str original_finding_id created_time discovered_time due_date
        last_collected_time last_reported_time original_status time_to_remediate
        category sub_category rule_id resource_reported_not_exist
        aggregation_group_id:long main_resource_id:long package_name image_id scan_id
        editable:boolean reopen_date finding_type_str fix_id fix_vendor_id fix_type
        fix_subtype rule_type rule_family
        """,
        id_column="id",
        id="finding_id",
        finding_type_str="finding_type",
    ),
    "plain_resources": _table(
        """
        id:long r1_resource_type r1_resource_name r1_resource_id r2_resource_type
        r2_resource_name r2_resource_id r3_resource_type r3_resource_name
        r3_resource_id r4_resource_type r4_resource_name r4_resource_id
        cloud_provider cloud_account cloud_account_friendly_name tags_values:strings
        seem_tags_values:strings tags_key_values:strings seem_tags_key_values:strings
        last_seen first_seen
        """,
        id_column="id",
        id="resource_id",
        r1_resource_type="resource_type",
        cloud_account_friendly_name="root_cloud_account_friendly_name",
    ),
    "findings_scores": _table(
        """
        finding_id:long original_score normalized_score:double scoring_rule_id:long
        factorized_score:double user_score:double user_score_set_by
        user_score_updated_time score:double severity:int updated_time
        """,
        id_column="finding_id",
        finding_id="score_finding_id",
    ),
    "user_status": _table(
        "id:long system_status_key:int user_status_key:int actual_status_key:int updated_time",
        id_column="id",
        id="user_status_id",
    ),
    "statuses": _table(
        """
        key:int category sub_status type reason description is_extended:boolean
        enabled:boolean editable:boolean created_by_user_id:int updated_by_user_id:int
        """,
        id_column="key",
        key="status_key",
    ),
    "aggregation_groups": _table(
        "id:long main_finding_id:long group_identifier is_locked:boolean",
        id_column="id",
        id="existing_group_id",
    ),
    "finding_sla_rule_connections": _table(
        "finding_id:long", id_column="finding_id", finding_id="sla_connection_id"
    ),
    "findings_additional_data": _table(
        "finding_id:long cve:strings", id_column="finding_id", finding_id="additional_data_id"
    ),
    "findings_info": _table("id:long", id_column="id", id="findings_info_id"),
    "scoring_rules": _table("id:long selection_rule_id:long"),
    "selection_rules": _table("id:long scope_group:long"),
    "aggregation_rules": _table(
        """
        id:int order:int type aggregation_query field_calculation disabled:boolean
        is_deleted:boolean version:int last_successful_run
        last_number_of_generated_groups:int created_by creation_time updated_by
        updated_time customer_description internal_description
        aggregation_rule_definition_id:int
        """
    ),
    "aggregation_rules_findings_excluder": _table("finding_id:long aggregation_rule_id:int"),
    "resource_to_scopes": _table("resource_id:long scope_ids:longs", id_column="resource_id"),
    "scope_groups": _table("id:long name editable:boolean created_by root:boolean", id_column="id"),
    "finding_ticket_associations": _table("id:long finding_id:long ticket_id:long", id_column="id"),
    "tickets": _table(
        """
        id:long finding_id:long ticket_endpoint_id:int ticket_provider_id:int
        field_mapping_definition_id:int field_mapping_id:int external_id
        external_status status failed_to_close:boolean failed_to_reopen:boolean
        assignee:int sprint created_by created_time:timestamp
        created_by_remediation_queue_id:int updated_by updated_time:timestamp
        sync_attachments:boolean last_attachment_time:timestamp
        last_status_update_time:timestamp due_date:date
        """,
        id_column="id",
    ),
    "user_sla": _table(
        "id:long new_due_date:date user_id:int updated_time:timestamp", id_column="id"
    ),
}

ASSOCIATION = _table("group_identifier group_identifier_readable finding_id:long")

ROLLUP = _table(
    """
    group_identifier group_identifier_readable finding_ids:longs cloud_accounts:strings
    findings_count:long rule_number:int
    """
)

BASE_VIEW_NAME = "base_findings_view"
ASSOCIATION_TABLE = "finding_group_association"
ROLLUP_TABLE = "finding_group_rollup"


def schema_of(table: str) -> T.StructType:
    published = {ASSOCIATION_TABLE: ASSOCIATION, ROLLUP_TABLE: ROLLUP}
    try:
        return published.get(table) or TABLES[table]
    except KeyError:
        raise ValueError(f"unknown table: {table}") from None


def id_column(table: str) -> str:
    """The column marked as id, or ``id`` where the schema marks none."""
    marked = [f.name for f in schema_of(table) if f.metadata.get(ID_COLUMN)]
    return marked[0] if marked else "id"


def view_name_of(table: str, column: str) -> str:
    """The name a table's column takes in the joined view."""
    schema = schema_of(table)
    return schema[column].metadata.get(ALIAS, column) if column in schema.names else column
