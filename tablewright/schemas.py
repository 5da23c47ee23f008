"""Explicit schemas: configuration tables, dead letters, delivery attempts and
run events. Types follow the warehouse DDL mapped to Spark (strings unless
stated; JSON objects become maps of strings where the shape is known)."""

from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
TS, NTZ = T.TimestampType(), T.TimestampNTZType()
SMAP = T.MapType(S, S)


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


QUERY_VIEW_CONFIG = _schema(("view_name", S), ("query", S),
                            ("query_template_name", S), ("parameters", SMAP))
QUERY_ORDER_CONFIG = _schema(("view_name", S), ("execution_sequence", I),
                             ("query", S), ("query_template_name", S),
                             ("temp_table", S), ("parameters", SMAP))
QUERY_TEMPLATE_CONFIG = _schema(("query_template_name", S), ("query_template", S))
OBJECT_ATTR = _schema(
    ("process_name", S), ("process_desc", S), ("database_name", S),
    ("schema_name", S), ("object_name", S), ("object_type", S),
    ("stream_name", S), ("stream_properties", SMAP),
    ("target_name_list", SMAP), ("incremental_capture_flag", B),
    ("primary_table", S), ("transient_stg_table", S))
TARGET_ATTR = _schema(("process_name", S), ("target_name", S),
                      ("target_properties", SMAP))
COLUMN_ATTR = _schema(("process_name", S), ("target_name", S),
                      ("column_name", S), ("transform_rule", S),
                      ("target_column_name", S), ("object_category", S))
DEPLOY_ATTR = _schema(("sequence_number", L), ("process_name", S),
                      ("replace_existing_stream", B), ("commit_message", S),
                      ("status", S), ("log_message", S),
                      ("initiation_date_time", NTZ),
                      ("completion_date_time", NTZ))
PIPELINE = _schema(("process_name", S), ("pipeline_config", S),
                   ("runtime_params", S), ("comment_text", S),
                   ("create_user", S), ("create_date_time", TS),
                   ("update_user", S), ("update_date_time", TS))
RUN_EVENT = _schema(("process_name", S), ("run_id", L), ("event_seq", I),
                    ("restart_run_id", L), ("start_date_time", TS),
                    ("end_date_time", TS), ("status", S),
                    ("successful_record_count", L),
                    ("failed_record_count", L), ("failure_reason", S),
                    ("target_rows", T.MapType(S, L)))

# Dead letters keep the outbound document as JSON text: variant values cannot
# be written to every file format, text can, and parse_json restores it.
DEAD_LETTER = _schema(("request_date", S), ("request_ts", S), ("run_id", L),
                      ("status_code", I), ("failed_reason", S),
                      ("source_request_id", S), ("data", S))

# One row per send attempt of one request.
ATTEMPT = _schema(("request_id", S), ("attempt", I), ("status", I),
                  ("reason", S), ("retry_after", I), ("final", B),
                  ("data", S))
ATTEMPT_DDL = ("request_id string, attempt int, status int, reason string, "
               "retry_after int, final boolean, data string")
