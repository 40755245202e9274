"""Control-plane operators: registries, plans, schema differences, states, audit."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import text as X
from quillspark.operators.latest import first_per_key, latest_per_key


def first_seen(rows: DataFrame, known: DataFrame | None, key: str = "schema_hash", needed: Sequence[str] = ("schema_hash", "schema_json", "first_seen_run_id")) -> DataFrame:
    """Rows with a key that is not registered yet, one for each; rows without the needed fields go."""
    for c in needed:
        rows = rows.where(F.col(c).isNotNull() & (F.col(c) != ""))
    rows = first_per_key(rows, [key], [F.col(c) for c in needed])
    return rows if known is None else rows.join(known.select(key).distinct(), key, "left_anti")


def stage_plan(runs: DataFrame, done: dict[str, DataFrame], force: bool = False) -> DataFrame:
    """(run_id, action): the stages that are left after what is done, or all by force.

    ``done``: run_ids with a manifest, by stage.
    """
    out = runs.select("run_id").distinct()
    for stage in ("bronze", "silver", "gold"):
        out = out.join(done[stage].select("run_id").distinct().withColumn(stage, F.lit(True)), "run_id", "left")
    action = F.when(F.col("gold"), "skip").when(F.col("silver"), "gold").when(F.col("bronze"), "silver,gold").otherwise("bronze,silver,gold")
    return out.select("run_id", F.lit("bronze,silver,gold").alias("action") if force else action.alias("action"))


def schema_fields(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields], "field string, type string")


def schema_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(field, change, expected, actual): added, removed and changed fields of two (field, type) tables.

    Additions pass a contract, the others break it.
    """
    e, a = expected.select("field", F.col("type").alias("expected")), actual.select("field", F.col("type").alias("actual"))
    change = F.when(F.col("expected").isNull(), "added").when(F.col("actual").isNull(), "removed").when(F.col("expected") != F.col("actual"), "type_change")
    out = e.join(a, "field", "full").withColumn("change", change).where("change is not null")
    return out.select("field", "change", "expected", "actual", (F.col("change") != "added").alias("breaking"))


def latest_state(versions: DataFrame, key: str = "proposal_id", by: str = "updated_ts", ties: Sequence[str] = ()) -> DataFrame:
    """The newest version of each key of an append-only table."""
    return latest_per_key(versions, [key], by, ties)


def judge_transitions(current: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (proposal_id, new_status, actor_role) with outcome: ok or why not, and the resulting status."""
    legal = requests.sparkSession.createDataFrame(list(schemas.PROPOSAL_STEPS), "status string, new_status string").withColumn("legal", F.lit(True))
    out = requests.join(current.select("proposal_id", "status"), "proposal_id", "left").join(F.broadcast(legal), ["status", "new_status"], "left")
    decides = F.col("new_status").isin("APPROVED", "REJECTED")
    outcome = (
        F.when(F.col("status").isNull(), "proposal_not_found")
        .when(F.col("legal").isNull(), "invalid_status_transition")
        .when(decides & ~F.col("actor_role").isin(*schemas.APPROVER_ROLES), "role_not_allowed_for_approval")
        .when(~decides & ~F.col("actor_role").isin(*schemas.OPERATOR_ROLES), "role_not_allowed_for_transition")
        .otherwise("ok")
    )
    out = out.withColumn("outcome", outcome)
    return out.select("proposal_id", "status", "new_status", "actor_role", "outcome", F.when(F.col("outcome") == "ok", F.col("new_status")).otherwise(F.col("status")).alias("resulting_status"))


def audit_summary(events: DataFrame, kinds: Sequence[str], session: str = "session_id", kind: str = "kind") -> DataFrame:
    """Events of each kind per session, one column a kind."""
    return events.groupBy(session).agg(*[F.count_if(F.col(kind) == k).alias(k) for k in kinds])


def batch_counts(df: DataFrame, key: str = "batch_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def authorize(role: str, allowed: Iterable[str], action: str = "read") -> None:
    if role not in set(allowed):
        raise PermissionError(f"role_not_allowed_for_{action}:{role}")


def allowlisted(name: str, allowed: Iterable[str], what: str = "table") -> str:
    if name not in set(allowed):
        raise ValueError(f"{what}_not_allowlisted:{name}")
    return name


def error_rows(failures: DataFrame, message: str = "message", code: str = "code") -> DataFrame:
    """Failures with category, upper-case code and trimmed summary."""
    return failures.withColumns({"error_category": X.error_category(F.col(message)), "error_code": F.upper(F.trim(F.coalesce(F.col(code), F.lit("UNKNOWN_ERROR")))), "error_summary": F.trim(F.coalesce(F.col(message), F.lit("")))})


# Texts of the drafts by layer.
DRAFT = {
    "B2S": "Transform Designer (B2S) draft proposal generated. This proposal is read-only and NOT auto-applied. Playbook focus: contract alignment, normalization, metadata propagation, deterministic dedup keys, and DQ/deadletter routing. Change type: %s. Source: %s. Target: %s. Problem: %s.",
    "S2G": "Transform Designer (S2G) draft proposal generated. This proposal is read-only and NOT auto-applied. Playbook focus: KPI logic, curated dimensional outputs, publish-readiness checks, and partition/clustering suitability. Change type: %s. Source: %s. Target: %s. Problem: %s.",
}


def design_artifacts(proposals: DataFrame) -> DataFrame:
    """Paths and texts of the drafts of transform proposals, with a confidence by layer.

    Takes proposal_id, layer (B2S or S2G), change_type, source_table, target_table, run_id,
    env and, if there, problem_statement.
    """
    safe = lambda c: X.sanitize(F.col(c))
    prefix = F.format_string("gs://agent-proposals/env=%s/layer=%s/run_id=%s/proposal_id=%s", F.col("env"), safe("layer"), X.sanitize(F.coalesce(F.nullif("run_id", F.lit("")), F.lit("latest_failed_run"))), F.col("proposal_id"))
    stem = F.format_string("%s_%s_to_%s", safe("change_type"), safe("source_table"), safe("target_table"))
    files = F.array(*[F.concat(prefix, F.lit(f"/{kind}_"), stem, F.lit(end)) for kind, end in (("mapping_spec", ".json"), ("test_plan", ".md"), ("schema_preview", ".json"))])
    silver = F.col("layer") == "B2S"
    problem = F.coalesce(F.col("problem_statement"), F.lit("")) if "problem_statement" in proposals.columns else F.lit("")
    text = F.when(silver, F.format_string(DRAFT["B2S"], "change_type", "source_table", "target_table", problem)).otherwise(F.format_string(DRAFT["S2G"], "change_type", "source_table", "target_table", problem))
    return proposals.select("proposal_id", files.alias("generated_artifacts"), text.alias("proposal_text"), F.when(silver, 0.78).otherwise(0.8).alias("confidence_score"))


def in_session(events: DataFrame, session: str, key: str = "session_id") -> DataFrame:
    return events.where(F.col(key) == session)


def log_rows(events: DataFrame, name: str, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Events as rows of a control table: its columns in its order, absent ones from ``defaults`` or null, a time if there is none.

    Serves sessions, tool calls, responses and proposals alike; what it gives can be appended.
    """
    defaults = {"created_ts": F.current_timestamp(), "updated_ts": F.current_timestamp(), "event_id": F.expr("uuid()")} | (defaults or {})
    fields = schemas.parse(schemas.OPS_TABLES[name][0]).fields
    given = lambda f: F.col(f.name) if f.name in events.columns else defaults.get(f.name, F.lit(None))
    return events.select(*[F.coalesce(given(f), defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in fields])


def next_versions(current: DataFrame, judged: DataFrame, now: Column | None = None) -> DataFrame:
    """New versions of the proposals whose requests were granted, to be appended."""
    granted = judged.where("outcome = 'ok'").select("proposal_id", F.col("resulting_status").alias("status"))
    return current.drop("status", "updated_ts").join(granted, "proposal_id").withColumn("updated_ts", F.current_timestamp() if now is None else now)


def ops_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty control table."""
    return spark.createDataFrame([], schemas.OPS_TABLES[name][0])
