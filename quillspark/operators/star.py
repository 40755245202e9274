"""Star schema with hashed keys: dimensions are distinct values, facts carry keys made alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import columns as C
from quillspark.operators.marts import FINAL


def hashed_dimension(df: DataFrame, column: str, key: str) -> DataFrame:
    value = F.coalesce(F.col(column).cast("string"), F.lit("unknown"))
    return df.select(value.alias(column)).distinct().select(C.dimension_key(F.col(column)).alias(key), column)


def date_dimension(df: DataFrame, column: str = "ingest_date") -> DataFrame:
    """Distinct days with their parts; day_of_week is 1 on Sunday."""
    day = F.try_to_date(F.col(column).cast("string").substr(1, 10))
    out = df.select(day.alias("date_key")).distinct()
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "day_of_week": F.dayofweek}
    return out.select("date_key", *[f("date_key").cast("long").alias(n) for n, f in parts.items()])


def hashed_fact(df: DataFrame, keys: dict[str, str], carry: list[str], date: str = "ingest_date") -> DataFrame:
    return df.select(F.col(date).alias("date_key"), *[C.dimension_key(F.col(c)).alias(k) for k, c in keys.items()], *carry)


def star(step_metrics: DataFrame, breakdown: DataFrame) -> dict[str, DataFrame]:
    """The five dimensions and two facts."""
    dims = {"dim_model": ("model_version", "model_key"), "dim_task": ("task_type", "task_key"), "dim_step_type": ("step_type", "step_type_key"), "dim_label": ("final_overall_label", "label_key")}
    keys = {"model_key": "model_version", "task_key": "task_type"}
    out = {"dim_date": date_dimension(step_metrics)} | {n: hashed_dimension(step_metrics, c, k) for n, (c, k) in dims.items()}
    out["fact_model_eval_step"] = hashed_fact(step_metrics, keys | {"step_type_key": "step_type", "label_key": "final_overall_label"}, ["run_id", "prompt_id", "evaluated_step_index", *FINAL, "is_bad"])
    out["fact_failure_breakdown"] = hashed_fact(breakdown, keys, ["run_id", "failure_type", "failure_value", "failure_count"])
    return out
