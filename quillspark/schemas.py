"""Names, types and rules of the feedback data, as data."""

from __future__ import annotations

from pyspark.sql import types as T

# The data model's enumerations.
METRICS = ("primary_intent", "information_gain", "reasoning", "understanding", "implementation", "trajectory_robustness")
LABELS = ("LLM_RATED_BAD", "LLM_RATED_OK", "LLM_RATED_GOOD")
BAD = "LLM_RATED_BAD"
HUMAN_RATERS = ("curator_1", "curator_2", "reviewer_curator_1", "reviewer_curator_2")
AUTO_RATER = "auto_rater"
JSON_COLUMNS = ("execution_json", "violations", "curator_1_rating", "curator_2_rating", "reviewer_curator_1_rating", "reviewer_curator_2_rating", "auto_rater")
ERROR_CATEGORIES = ("AUTH", "IAM_PERMISSION", "SCHEMA_DRIFT", "DQ_FAILURE", "RUNTIME", "CONFIG", "DEPENDENCY", "NETWORK")
PROPOSAL_STEPS = (("DRAFT", "REVIEW"), ("REVIEW", "APPROVED"), ("REVIEW", "REJECTED"))
OPERATOR_ROLES = ("operator", "engineer", "approver", "admin")
APPROVER_ROLES = ("approver", "admin")
READER_ROLES = ("viewer", "analyst", "admin")

RATING_DDL = ", ".join([*(f"{m}: double" for m in METRICS), "overall_label: string"])
AUTO_DDL = f"scores: struct<{RATING_DDL}>, violations: array<string>, confidence: double, rubric_version: string, model_version: string, final_reviewer: string"
STEP_DDL = "step_index: int, step_type: string, tool_name: string, query: string, tool_output: string, partial_answer: string"
EXECUTION_DDL = f"prompt_id: string, query_text: string, steps: array<struct<{STEP_DDL}>>, final_answer: string, model_version: string"

#: Target type of each nested column, as DDL.
NESTED = {
    "execution_json": f"struct<{EXECUTION_DDL}>",
    "auto_rater": f"struct<{AUTO_DDL}>",
    **{f"{r}_rating": f"struct<{RATING_DDL}>" for r in HUMAN_RATERS},
}

META_DDL = "run_id string, ingest_ts string, source_type string, source_name string, source_file string, source_uri string, pod_name string, pod_type string, task_type string, schema_hash string, record_hash string, row_number bigint"
PAYLOAD_TEXT = ("pod_name", "pod_type", "task_type", "batch_id", "batch_name", "set_id", "prompt_id", "query_text", "step_index", "evaluated_step_index", "step_type", *JSON_COLUMNS, "reviewer_comments")
PAYLOAD_DDL = ", ".join(f"{c} string" for c in PAYLOAD_TEXT)
BRONZE_REQUIRED = ("run_id", "ingest_ts", "schema_hash", "record_hash", "source_type", "raw_path")

_RUN = "run_id string, stage string"
# Control tables with their columns, types and clustering columns, in order; all are partitioned by the day of created_ts.
OPS_TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "pipeline_runs": (
        f"{_RUN}, status string, start_ts timestamp, end_ts timestamp, duration_ms bigint, input_count bigint, output_count bigint, deadletter_count bigint, schema_hash string, "
        "dataproc_batch_id string, manifest_path string, error_category string, error_code string, error_summary string, code_version string, "
        "input_paths array<string>, output_paths array<string>, partition_keys array<string>, created_ts timestamp, updated_ts timestamp",
        ("run_id", "stage"),
    ),
    "dq_results": (f"{_RUN}, table_name string, rule_id string, severity string, failed_count bigint, sample_record_hashes array<string>, dq_pass boolean, created_ts timestamp", ("run_id", "stage", "table_name", "rule_id")),
    "schema_registry": ("schema_hash string, schema_json string, first_seen_run_id string, created_ts timestamp, source_type string", ("schema_hash", "source_type")),
    "deadletter_summary": (f"{_RUN}, rule_id string, failure_reason string, count bigint, created_ts timestamp", ("run_id", "stage", "rule_id")),
    "dq_rule_registry": ("rule_id string, name string, description string, severity string, target_table string, logic_reference string, owner string, enabled boolean, created_ts timestamp, updated_ts timestamp", ("rule_id", "target_table")),
    "agent_sessions": ("session_id string, user_id string, mode string, read_only boolean, created_ts timestamp", ("session_id", "mode")),
    "agent_tool_calls": ("event_id string, session_id string, route string, tool_name string, tool_args_json string, evidence_refs array<string>, created_ts timestamp", ("session_id", "route", "tool_name")),
    "agent_responses": ("event_id string, session_id string, route string, query_text string, response_text string, evidence_refs array<string>, read_only boolean, created_ts timestamp", ("session_id", "route")),
    "agent_proposals": ("proposal_id string, session_id string, route string, title string, proposal_text string, evidence_refs array<string>, status string, created_ts timestamp, updated_ts timestamp", ("proposal_id", "session_id", "status")),
}

# Contracts, with keys, required fields and lineage fields of published tables.
CONTRACTS = {
    "feedback_step": {"keys": ("run_id", "record_hash"), "required": ("ingest_date", "run_id", "record_hash", "schema_hash", "prompt_id", "evaluated_step_index"), "lineage": ("run_id", "ingest_ts", "schema_hash", "record_hash", "raw_path")},
    "training_supervised_examples": {"keys": ("run_id", "prompt_id"), "required": ("ingest_date", "run_id", "prompt_id", "task_type", "final_answer"), "lineage": ("run_id", "ingest_ts", "schema_hash", "record_hash")},
}


def parse(ddl: str) -> T.DataType:
    """A Spark type from DDL."""
    return T.DataType.fromDDL(ddl)
