"""Deterministic feedback batches for tests and demonstrations, made by Spark from row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import columns as C


def _draw(n: int, *parts) -> Column:
    return F.pmod(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), F.lit(n)).cast("int")


def _label(mean: Column) -> Column:
    return F.when(mean < 2.0, schemas.LABELS[0]).when(mean < 3.5, schemas.LABELS[1]).otherwise(schemas.LABELS[2])


def _rating(seed: int, *parts) -> Column:
    scores = {m: _draw(6, seed, m, *parts).cast("double") for m in schemas.METRICS}
    total = F.lit(0.0)
    for s in scores.values():
        total = total + s
    return F.struct(*[s.alias(m) for m, s in scores.items()], _label(total / len(scores)).alias("overall_label"))


def feedback_rows(spark: SparkSession, kind: str = "auto", prompts: int = 30, seed: int = 42, task: str = "NEXT_STEPS") -> DataFrame:
    """Typed source rows: for each prompt 3 to 8 steps, each evaluated once.

    ``auto`` rows have an automatic rating, ``human`` rows four human ones, of
    which 30 % of the reviewers' differ from the curators'; ``both`` has all.
    """
    p = spark.range(prompts).withColumn("steps", 3 + _draw(6, seed, F.col("id")))
    rows = p.select("id", "steps", F.explode(F.sequence(F.lit(0), (F.col("steps") - 1).cast("int"))).alias("at"))
    step = lambda i, last: F.when(i == last, "final").when(i == 0, "search").otherwise(F.when(_draw(2, seed, "kind", F.col("id"), i) == 0, "tool").otherwise("search"))
    last = (F.col("steps") - 1).cast("int")
    prompt, asked = F.format_string("prompt_%04d", "id"), F.concat(F.lit("Provide next steps for scenario "), F.col("id").cast("string"), F.lit("."))
    steps = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("step_index"),
            step(i, last).alias("step_type"),
            F.when(step(i, last) == "search", "search").when(step(i, last) == "tool", "python").alias("tool_name"),
            F.when(step(i, last) == "search", F.concat(F.lit("Search notes for: "), asked)).alias("query"),
            F.when(step(i, last) != "final", F.lit("done")).alias("tool_output"),
            F.concat(F.lit("Result "), i.cast("string")).alias("partial_answer"),
        ),
    )
    some = lambda share, *parts: F.when(_draw(100, seed, *parts) < share, F.array(F.element_at(F.array(*map(F.lit, ("TOXICITY", "HALLUCINATION", "POLICY"))), 1 + _draw(3, seed, "which", *parts)))).otherwise(F.array().cast("array<string>"))
    key = (F.col("id"), F.col("at"))
    auto = F.struct(_rating(seed, "auto", *key).alias("scores"), some(20, "auto", *key).alias("violations"), (0.6 + _draw(36, seed, "sure", *key) / 100.0).alias("confidence"), F.lit("rubric_v1").alias("rubric_version"), F.lit("auto-rater-v2").alias("model_version"), F.lit("auto").alias("final_reviewer"))
    none = lambda ddl: F.lit(None).cast(schemas.parse(ddl))
    curators = {i: _rating(seed, f"curator{i}", *key) if kind != "auto" else none(schemas.NESTED[f"curator_{i}_rating"]) for i in (1, 2)}
    reviewers = {i: F.when(_draw(100, seed, f"tweak{i}", *key) < 30, _rating(seed, f"reviewer{i}", *key)).otherwise(curators[i]) if kind != "auto" else curators[i] for i in (1, 2)}
    return rows.select(
        F.lit("pod_a").alias("pod_name"),
        F.lit("vertical").alias("pod_type"),
        F.lit(task).alias("task_type"),
        F.lit(f"batch_{kind}").alias("batch_id"),
        F.lit(f"batch_{kind}").alias("batch_name"),
        F.when(F.lit(kind != "auto"), F.format_string("set_%03d", 1 + F.col("id") % 4)).alias("set_id"),
        prompt.alias("prompt_id"),
        asked.alias("query_text"),
        F.col("at").alias("step_index"),
        F.col("at").alias("evaluated_step_index"),
        step(F.col("at"), last).alias("step_type"),
        F.struct(prompt.alias("prompt_id"), asked.alias("query_text"), steps.alias("steps"), F.lit("Summarize findings.").alias("final_answer"), F.lit("model-1").alias("model_version")).alias("execution_json"),
        some(15, "row", *key).alias("violations"),
        *[curators[i].alias(f"curator_{i}_rating") for i in (1, 2)],
        *[reviewers[i].alias(f"reviewer_curator_{i}_rating") for i in (1, 2)],
        (auto if kind != "human" else none(schemas.NESTED["auto_rater"])).alias("auto_rater"),
        F.lit(None).cast("string").alias("reviewer_comments"),
    )


# What each metric adds to a rater's base, each rater's base, and the least base of the best label.
_ADDED = {"primary_intent": 0.0, "information_gain": 0.1, "reasoning": 0.2, "understanding": 0.1, "implementation": 0.15, "trajectory_robustness": 0.05}
_BASES = {"curator_1": 3.6, "curator_2": 3.7, "reviewer_curator_1": 3.8, "reviewer_curator_2": 3.9, "auto_rater": 3.75}
_GOOD_FROM = 3.5


def _steady_rating(base: float) -> Column:
    scores = [F.lit(round(base + _ADDED[m], 2)).alias(m) for m in schemas.METRICS]
    return F.struct(*scores, F.lit(schemas.LABELS[2] if base >= _GOOD_FROM else schemas.LABELS[1]).alias("overall_label"))


def source_batches(spark: SparkSession, records: int = 12, auto_batch: str = "auto_batch", human_batch: str = "human_batch", task: str = "NEXT_STEPS") -> dict[str, DataFrame]:
    """The same records twice, without any draw: ``json`` with nested values, ``csv`` with them as JSON text.

    Three prompts share a set; a record evaluates step 0 to 5 in turn, behind one
    search step; all raters rate all records, each metric a fixed step above the rater's base.
    """
    i = F.col("id")
    at, prompt = (i % 6).cast("int"), F.concat(F.lit("prompt_"), (1000 + i).cast("string"))
    asked = F.concat(F.lit("Provide next steps for scenario "), (1000 + i).cast("string"), F.lit("."))
    step = lambda n, kind, tool, query, output, answer: F.struct(n.alias("step_index"), F.lit(kind).alias("step_type"), F.lit(tool).alias("tool_name"), query.alias("query"), F.lit(output).alias("tool_output"), F.lit(answer).alias("partial_answer"))
    steps = F.array(
        step(F.greatest(F.lit(0), at - 1), "search", "search", F.concat(F.lit("Search for context for "), prompt), "Snippets found.", "Draft."),
        step(at, "tool", "calculator", F.lit("Compute the final score"), "Score=4.2", "Refined."),
    )
    none = F.array().cast("array<string>")
    auto = F.struct(_steady_rating(_BASES["auto_rater"]).alias("scores"), none.alias("violations"), F.lit(0.87).alias("confidence"), F.lit("v1").alias("rubric_version"), F.lit("auto-rater-v1").alias("model_version"), F.lit("auto").alias("final_reviewer"))
    rows = spark.range(records).select(
        F.lit("pod_a").alias("pod_name"),
        F.lit("vertical").alias("pod_type"),
        F.lit(task).alias("task_type"),
        F.format_string("set_%03d", 1 + F.floor(i / 3)).alias("set_id"),
        prompt.alias("prompt_id"),
        asked.alias("query_text"),
        at.alias("step_index"),
        at.alias("evaluated_step_index"),
        F.when(i % 2 == 0, "tool").otherwise("search").alias("step_type"),
        F.struct(prompt.alias("prompt_id"), asked.alias("query_text"), steps.alias("steps"), F.concat(F.lit("Next steps for "), prompt).alias("final_answer"), F.lit("model-1").alias("model_version")).alias("execution_json"),
        none.alias("violations"),
        *[_steady_rating(_BASES[r]).alias(f"{r}_rating") for r in schemas.HUMAN_RATERS],
        auto.alias("auto_rater"),
    )
    named = lambda df, batch: df.withColumns({"batch_id": F.lit(batch), "batch_name": F.lit(batch)})
    return {"json": named(rows, auto_batch), "csv": named(C.jsonify(rows), human_batch)}
