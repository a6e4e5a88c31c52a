"""Row layouts."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _row(**columns: str | T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind) for name, kind in columns.items()]
    )


REVISION = _row(
    page_id="string",
    page_title="string",
    namespace="int",
    rev_id="string",
    parent_rev_id="string",
    timestamp="string",
    contributor_username="string",
    is_anon="boolean",
    comment="string",
    text_bytes="bigint",
)

# Column order of the tab-separated history dump, all strings. fixed values
HISTORY_COLUMNS = (
    "wiki_db",
    "event_entity",
    "event_type",
    "event_timestamp",
    "event_comment",
    "event_user_id",
    "event_user_central_id",
    "event_user_text_historical",
    "event_user_text",
    "event_user_blocks_historical",
    "event_user_blocks",
    "event_user_groups_historical",
    "event_user_groups",
    "event_user_is_bot_by_historical",
    "event_user_is_bot_by",
    "event_user_is_created_by_self",
    "event_user_is_created_by_system",
    "event_user_is_created_by_peer",
    "event_user_is_anonymous",
    "event_user_is_temporary",
    "event_user_is_permanent",
    "event_user_registration_timestamp",
    "event_user_creation_timestamp",
    "event_user_first_edit_timestamp",
    "event_user_revision_count",
    "event_user_seconds_since_previous_revision",
    "page_id",
    "page_title_historical",
    "page_title",
    "page_namespace_historical",
    "page_namespace_is_content_historical",
    "page_namespace",
    "page_namespace_is_content",
    "page_is_redirect",
    "page_is_deleted",
    "page_creation_timestamp",
    "page_first_edit_timestamp",
    "page_revision_count",
    "page_seconds_since_previous_revision",
    "user_id",
    "user_central_id",
    "user_text_historical",
    "user_text",
    "user_blocks_historical",
    "user_blocks",
    "user_groups_historical",
    "user_groups",
    "user_is_bot_by_historical",
    "user_is_bot_by",
    "user_is_created_by_self",
    "user_is_created_by_system",
    "user_is_created_by_peer",
    "user_is_anonymous",
    "user_is_temporary",
    "user_is_permanent",
    "user_registration_timestamp",
    "user_creation_timestamp",
    "user_first_edit_timestamp",
    "revision_id",
    "revision_parent_id",
    "revision_minor_edit",
    "revision_deleted_parts",
    "revision_deleted_parts_are_suppressed",
    "revision_text_bytes",
    "revision_text_bytes_diff",
    "revision_text_sha1",
    "revision_content_model",
    "revision_content_format",
    "revision_is_deleted_by_page_deletion",
    "revision_deleted_by_page_deletion_timestamp",
    "revision_is_identity_reverted",
    "revision_first_identity_reverting_revision_id",
    "revision_seconds_to_identity_revert",
    "revision_is_identity_revert",
    "revision_is_from_before_page_creation",
    "revision_tags",
)

HISTORY = T.StructType([T.StructField(c, T.StringType()) for c in HISTORY_COLUMNS])

LABELED = _row(
    revision_id="string",
    page_title_historical="string",
    label="int",
    length_delta="double",
    is_anon_int="int",
    hour_of_day="int",
    day_of_week="int",
    comment_clean="string",
    title_clean="string",
)

EVENT = _row(
    id="bigint",
    type="string",
    namespace="int",
    title="string",
    comment="string",
    timestamp="bigint",
    user="string",
    bot="boolean",
    wiki="string",
    server_name="string",
    length=_row(old="int", new="int"),
    revision=_row(old="bigint", new="bigint"),
    meta=_row(dt="string", id="string"),
)

PREDICTION = _row(
    id="string",
    rev_id="string",
    page_title="string",
    namespace="int",
    user="string",
    is_anon="int",
    comment="string",
    length_delta="double",
    timestamp="string",
    wiki="string",
    risk_score="double",
    risk_label="string",
    scored="int",
    created_at="string",
)
PREDICTION_COLUMNS = PREDICTION.fieldNames()

EXPLANATION = _row(edit_id="string", explanation="string", model="string", generated_at="string")

RESCORE_INPUT = _row(
    id="string",
    comment_clean="string",
    title_clean="string",
    length_delta="double",
    is_anon_int="int",
    hour_of_day="int",
    day_of_week="int",
)
