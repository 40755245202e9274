"""Wide to long and nested to flat, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import columns as C

RECORD_KEYS = ("ingest_date", "run_id", "record_hash", "prompt_id", "evaluated_step_index", "step_type", "task_type")


def wide_to_long(df: DataFrame, keys: Sequence[str | Column], groups: dict[str, dict[str, Column]], group: str, metric: str, value: str, label: dict[str, Column] | None = None, label_name: str = "label") -> DataFrame:
    """A row per key, group and metric, where the value or the group's label is there.

    ``groups``: value expressions by group and metric; ``label``: one per group.
    """
    label = label or {}
    one = [
        F.struct(F.lit(g).alias(group), label.get(g, F.lit(None).cast("string")).alias(label_name), F.array(*[F.struct(F.lit(m).alias(metric), v.cast("double").alias(value)) for m, v in ms.items()]).alias("m"))
        for g, ms in groups.items()
    ]
    names = df.select(*keys).columns
    long = df.select(*keys, F.explode(F.array(*one)).alias("g")).select(*names, f"g.{group}", f"g.{label_name}", F.explode("g.m").alias("v"))
    long = long.select(*names, group, label_name, f"v.{metric}", f"v.{value}").where(F.col(value).isNotNull() | F.col(label_name).isNotNull())
    return long if label else long.drop(label_name)


def ratings_long(df: DataFrame) -> DataFrame:
    """Ratings of five raters in six metrics as rows."""
    raters = {r: f"{r}_rating" for r in schemas.HUMAN_RATERS} | {schemas.AUTO_RATER: "auto_rater.scores"}
    return wide_to_long(
        df,
        RECORD_KEYS,
        {r: {m: F.col(f"{path}.{m}") for m in schemas.METRICS} for r, path in raters.items()},
        "rater_type",
        "metric_name",
        "metric_score",
        {r: F.col(f"{path}.overall_label") for r, path in raters.items()},
        "overall_label",
    )


def execution_steps(df: DataFrame, distinct: bool = False) -> DataFrame:
    """Steps of the trajectories; ``distinct`` drops the repeats that each evaluated step carries."""
    own = {"execution_step_index": "step_index", "execution_step_type": "step_type", "tool_name": "tool_name", "tool_query": "query", "tool_output": "tool_output", "partial_answer": "partial_answer"}
    keys = ["ingest_date", "run_id", "record_hash", "prompt_id", "evaluated_step_index", "step_type"]
    out = df.select(*keys, F.col("execution_json.model_version").alias("model_version"), F.explode("execution_json.steps").alias("s"))
    out = out.where("s.step_index is not null").select(*keys, "model_version", *[F.col(f"s.{f}").alias(n) for n, f in own.items()])
    return out.dropDuplicates(["run_id", "prompt_id", "execution_step_index"]).drop("record_hash", "evaluated_step_index", "step_type") if distinct else out


def tagged_items(df: DataFrame, keys: Sequence[str], sources: dict[str, Column], tag: str, item: str) -> DataFrame:
    """Non-blank items of several arrays as rows, tagged by their source."""

    def tagged(name: str):
        return lambda x: F.struct(F.lit(name).alias(tag), x.cast("string").alias(item))

    each = [F.transform(F.coalesce(a, F.array().cast("array<string>")), tagged(name)) for name, a in sources.items()]
    return df.select(*keys, F.explode(F.concat(*each)).alias("x")).select(*keys, f"x.{tag}", f"x.{item}").where(~C.blank(F.col(item)))


def violations(df: DataFrame) -> DataFrame:
    keys = ["ingest_date", "run_id", "record_hash", "prompt_id", "evaluated_step_index"]
    return tagged_items(df, keys, {"record": F.col("violations"), "auto_rater": F.col("auto_rater.violations")}, "violation_source", "violation")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns that one lacks are null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def with_final_scores(df: DataFrame) -> DataFrame:
    """final_<metric> of curators and reviewers, and final_overall_label by precedence."""
    side = lambda i, m: [F.col(f"reviewer_curator_{i}_rating.{m}"), F.col(f"curator_{i}_rating.{m}")]
    label = F.coalesce(*[F.col(f"{p}.overall_label") for p in ("reviewer_curator_1_rating", "reviewer_curator_2_rating", "curator_1_rating", "curator_2_rating", "auto_rater.scores")])
    return df.withColumns({f"final_{m}": C.two_source_mean(side(1, m), side(2, m)) for m in schemas.METRICS} | {"final_overall_label": label})


def feedback_step(df: DataFrame) -> DataFrame:
    """Clean records as the flat feedback table; columns that are absent are null."""
    plain = ["ingest_date", "run_id", "record_hash", "schema_hash", "source_type", "raw_path", "ingest_ts", "batch_id", "batch_name", "pod_name", "pod_type", "task_type", "set_id", "prompt_id", "query_text", "step_index", "evaluated_step_index", "step_type"]
    nested = {"model_version": "execution_json.model_version", "final_answer": "execution_json.final_answer", "auto_rater_model_version": "auto_rater.model_version", "rubric_version": "auto_rater.rubric_version", "auto_rater_confidence": "auto_rater.confidence"}
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in plain], *[F.col(p).alias(n) for n, p in nested.items()], *[f"final_{m}" for m in schemas.METRICS], "final_overall_label", "dq_pass", "dq_reasons"
    )
