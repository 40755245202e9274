"""Data-quality rules as data: reasons, dead letters, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import columns as C


@dataclass(frozen=True)
class Rule:
    """``broken`` is SQL that is true for a bad row; null counts as fine."""

    reason: str
    broken: str
    rule_id: str
    severity: str
    description: str = ""
    enabled: bool = True


def required(name: str, rule_id: str, severity: str) -> Rule:
    return Rule(f"missing_{name}", f"{name} IS NULL OR length(trim({name})) = 0", rule_id, severity, f"{name} must be present and non-empty")


# Reasons, rule ids, severities and descriptions of the feedback table's rules, in the order in which reasons are listed.
FEEDBACK_RULES = (
    required("run_id", "DQ_RUN_ID_REQUIRED", "CRITICAL"),
    required("record_hash", "DQ_RECORD_HASH_REQUIRED", "CRITICAL"),
    required("prompt_id", "DQ_PROMPT_ID_REQUIRED", "HIGH"),
    required("query_text", "DQ_QUERY_TEXT_REQUIRED", "HIGH"),
    Rule("missing_evaluated_step_index", "evaluated_step_index IS NULL", "DQ_EVALUATED_STEP_INDEX_VALID", "HIGH", "evaluated_step_index must be non-null and >= 0"),
    Rule("invalid_evaluated_step_index", "evaluated_step_index < 0", "DQ_EVALUATED_STEP_INDEX_VALID", "HIGH", "evaluated_step_index must be non-null and >= 0"),
    Rule("invalid_final_overall_label", f"final_overall_label NOT IN {schemas.LABELS}", "DQ_FINAL_OVERALL_LABEL_ALLOWED", "HIGH", "final_overall_label must be one of allowed labels"),
    *(Rule(f"out_of_range_{m}", f"final_{m} < 0 OR final_{m} > 5", "DQ_METRIC_RANGE_0_5", "HIGH", "resolved metric fields must be in range [0, 5]") for m in schemas.METRICS),
)


def apply_rules(df: DataFrame, rules: Sequence[Rule] = FEEDBACK_RULES) -> DataFrame:
    """``df`` with dq_reasons (of the rules broken, in order) and dq_pass."""
    reasons = F.array_compact(F.array(*[F.when(F.expr(r.broken), F.lit(r.reason)) for r in rules if r.enabled], F.lit(None).cast("string")))
    return df.withColumn("dq_reasons", reasons).withColumn("dq_pass", F.size("dq_reasons") == 0)


def rule_id_of(reason: Column, rules: Sequence[Rule] = FEEDBACK_RULES) -> Column:
    known = F.create_map(*[F.lit(x) for r in rules for x in (r.reason, r.rule_id)])
    return F.coalesce(F.try_element_at(known, reason), F.lit("DQ_UNKNOWN"))


def severity_of(rule_id: Column, rules: Sequence[Rule] = FEEDBACK_RULES) -> Column:
    known = F.create_map(*[F.lit(x) for i, s in sorted({(r.rule_id, r.severity) for r in rules}) for x in (i, s)])
    return F.coalesce(F.try_element_at(known, rule_id), F.lit("MEDIUM"))


def evidence_ref(raw_path: Column, record_hash: Column) -> Column:
    parts = [F.lit("raw_path="), F.coalesce(raw_path, F.lit("unknown")), F.lit(";record_hash="), F.coalesce(record_hash, F.lit("unknown"))]
    return F.concat(*parts)


def dead_letters(checked: DataFrame, rules: Sequence[Rule] = FEEDBACK_RULES, carry: Sequence[str] = ("ingest_date", "run_id", "record_hash", "schema_hash", "raw_path", "prompt_id", "evaluated_step_index", "ingest_ts"), stage: str = "silver") -> DataFrame:
    """One row per failed record and reason, with rule, severity, evidence and the record as JSON."""
    have = [c for c in carry if c in checked.columns]
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in checked.columns if c not in ("dq_reasons", "dq_pass")]))
    path = F.col("raw_path") if "raw_path" in have else F.lit(None).cast("string")
    digest = F.col("record_hash") if "record_hash" in have else F.lit(None).cast("string")
    # an inner explode would make Spark test the size of the reasons first, and push that test with all rules in it down to the scan
    out = checked.select(*have, F.explode_outer("dq_reasons").alias("failure_reason"), record.alias("raw_record_json")).where(F.col("failure_reason").isNotNull())
    out = out.withColumn("rule_id", rule_id_of(F.col("failure_reason"), rules))
    return out.withColumns({"severity": severity_of(F.col("rule_id"), rules), "evidence_ref": evidence_ref(path, digest), "failure_stage": F.lit(stage)})


def dead_letter_summary(letters: DataFrame, stage: str = "silver") -> DataFrame:
    return letters.groupBy("run_id", F.lit(stage).alias("stage"), "rule_id", "failure_reason").agg(F.count(F.lit(1)).alias("count"))


def rule_results(letters: DataFrame, stage: str = "silver", table: str = "feedback_step", samples: int = 20) -> DataFrame:
    """Failures per run and rule, with the first ``samples`` distinct hashes in order.

    The letters are counted by hash once; the counts add up to those of the rules, and the first hashes
    are a rank over the same counts that Spark cuts before its shuffle, so no task holds all hashes of a rule.
    """
    keys = ["run_id", "rule_id", "severity"]
    each = letters.groupBy(*keys, "record_hash").agg(F.count(F.lit(1)).alias("__n"))
    counts = each.groupBy(*keys).agg(F.sum("__n").alias("failed_count"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("record_hash").asc_nulls_last()))
    # the test of the count keeps it, so that both sides read one and the same exchange
    first = each.where("__n > 0").withColumn("__at", place).where(F.col("__at") <= samples)
    first = first.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.array_sort(F.collect_set("record_hash")).alias("sample_record_hashes"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    out = counts.join(first, same, "left")
    return out.select(
        "run_id", F.lit(stage).alias("stage"), F.lit(table).alias("table_name"), "rule_id", "severity", "failed_count", F.coalesce("sample_record_hashes", F.array().cast("array<string>")).alias("sample_record_hashes"), F.lit(False).alias("dq_pass")
    )


def rule_registry(spark, rules: Sequence[Rule] = FEEDBACK_RULES, table: str = "feedback_step", owner: str = "data-platform") -> DataFrame:
    """The rules as a table, one row per rule id."""
    rows = {r.rule_id: (r.rule_id, r.rule_id.removeprefix("DQ_").lower(), r.description, r.severity, table, r.broken, owner, r.enabled) for r in reversed(rules)}
    return spark.createDataFrame(sorted(rows.values()), "rule_id string, name string, description string, severity string, target_table string, logic_reference string, owner string, enabled boolean")


def check_contract(df: DataFrame, contract: dict) -> DataFrame:
    """(problem, field, rows): required fields that are missing or null, lineage that is missing, keys that repeat."""
    spark = df.sparkSession
    gone = [("missing_required", c, None) for c in contract["required"] if c not in df.columns] + [("missing_lineage", c, None) for c in contract["lineage"] if c not in df.columns]
    out = spark.createDataFrame(gone, "problem string, field string, rows long")
    if have := [c for c in contract["required"] if c in df.columns]:
        nulls = df.agg(*[F.count_if(C.blank(F.col(c).cast("string"))).alias(c) for c in have])
        out = out.union(nulls.unpivot([], have, "field", "rows").where("rows > 0").select(F.lit("null_required"), "field", "rows"))
    if all(c in df.columns for c in contract["keys"]):
        twice = df.groupBy(*contract["keys"]).count().where("count > 1").agg(F.sum("count").alias("rows")).where("rows > 0")
        out = out.union(twice.select(F.lit("repeated_key"), F.lit(",".join(contract["keys"])), "rows"))
    return out
