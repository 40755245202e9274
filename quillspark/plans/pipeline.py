"""The layered feedback pipeline: raw, bronze, silver, gold, star.

Each stage works on any number of runs at once, writes by dynamic partition
overwrite and then leaves a manifest per run and day, so that it can be repeated
after a crash.  What a stage's tables share is computed once, each table is
evaluated once, and its rows are counted by run in the job that writes them.  Each
execution leaves rows in ``pipeline_runs``, a failed one too, and registers new schemas.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import columns as C
from quillspark.operators import control, ingest, latest, marts, metadata, places, quality, reshape, star
from quillspark.plans import lifecycle
from quillspark.sources import readers, writers


@dataclass(frozen=True)
class Lake:
    """Roots of the layers below one folder."""

    root: str

    def __getattr__(self, layer: str) -> str:
        if layer not in ("raw", "bronze", "silver", "gold", "star", "ops", "manifests"):
            raise AttributeError(layer)
        return f"{self.root.rstrip('/')}/{layer}"


def land_raw(spark: SparkSession, lake: Lake, rows: DataFrame, run_id: str, day: str, source_type: str = "json", source_name: str = "feedback", source_uri: str = "memory", code_version: str | None = None) -> str:
    """Source rows as raw JSONL envelopes; payload values as text or JSON text, with all fields that the source has."""
    batch = ingest.batch_id(ingest.normalize_payload(rows, "variant"), source_uri)
    # small files hold many rows, whose parsing is the work
    typed = ingest.normalize_payload(places.dealt(rows, "__at"), "variant")
    seen = Observation()
    kinds = dict(typed.dtypes)
    value = lambda c: F.try_variant_get(F.col(c), "$", "string") if kinds[c] == "variant" else F.col(c).cast("string")
    text = typed.observe(seen, *ingest.nested_types(typed).values()).select(*[value(c).alias(c) for c in schemas.PAYLOAD_TEXT], "__at")
    meta = {"run_id": run_id, "ingest_ts": f"{day}T00:00:00Z", "source_type": source_type, "source_name": source_name, "source_file": source_uri.rpartition("/")[2], "source_uri": source_uri}
    path = f"{lake.raw}/{source_name}/dt={day}/run_id={run_id}/batch_id={batch}"
    with lifecycle.Stage(spark, lake.ops, "raw", code_version, [source_uri], [path]) as stage:
        stage.expect([(run_id, day)])
        numbered = places.dense_places_of(text, "__at", "__place").withColumn("__place", F.col("__place") + 1)
        n = writers.write_jsonl(ingest.raw_envelope(numbered, meta, "__place"), path)
        # the fields as the one evaluation of the source saw them
        types = {c: t for c, t in seen.get.items() if t and t.startswith("OBJECT")}
        drift = [list(f) for f in ingest.undeclared(types)]
        register_schemas(spark, lake, run_id, rows, source_type, types)
        # a run's batches land one after another and share its manifest
        before = writers.manifest_path(lake.manifests, "raw", day, run_id)
        batches = json.loads(writers.get_text(spark, before)).get("batches", {}) if readers.path_exists(spark, before) else {}
        batches[path] = n
        written = writers.write_manifest(spark, lake.manifests, "raw", day, run_id, output_paths=sorted(batches), batches=batches, counts={source_name: sum(batches.values())}, undeclared_fields=drift)
        stage.done((run_id, day), input_count=n, output_count=n, deadletter_count=0, manifest_path=written)
    return path


def landed(raw: DataFrame, day: str | None = None) -> DataFrame:
    """Raw envelopes as flat rows."""
    rows = metadata.with_ingest_date(metadata.normalize_raw(raw), day)
    return metadata.trim_strings(metadata.require(rows))


def bronze(raw: DataFrame, day: str | None = None) -> DataFrame:
    """Raw envelopes as flat, deduplicated rows."""
    return _unique(landed(raw, day))


def _unique(rows: DataFrame) -> DataFrame:
    return latest.deduplicate(rows, ["run_id", "record_hash"], ["raw_path", "ingest_ts"])


def checked(rows: DataFrame) -> DataFrame:
    """Bronze rows with typed columns, final scores and rule results."""
    rows = latest.deduplicate(rows, ["run_id", "record_hash"], ["raw_path"])
    typed = {n: C.as_struct(rows, n, ddl) for n, ddl in schemas.NESTED.items()} | {"violations": C.as_strings(rows, "violations")}
    typed |= {n: F.col(n).try_cast("int") for n in ("step_index", "evaluated_step_index")}
    return quality.apply_rules(reshape.with_final_scores(rows.withColumns(typed)))


def silver(rows: DataFrame) -> dict[str, DataFrame]:
    """Bronze rows as the silver tables."""
    return silver_tables(checked(rows))


def silver_tables(tested: DataFrame) -> dict[str, DataFrame]:
    """Tested rows as the silver tables."""
    clean = tested.where("dq_pass")
    return {
        "feedback_step": reshape.feedback_step(clean),
        "ratings_long": reshape.ratings_long(clean),
        "execution_steps": reshape.execution_steps(clean),
        "violations": reshape.violations(clean),
        "deadletter": quality.dead_letters(tested),
    }


def gold(feedback: DataFrame, ratings: DataFrame, violations: DataFrame) -> dict[str, DataFrame]:
    """Silver tables as the marts."""
    return {
        "training_supervised_examples": marts.training_examples(feedback, violations),
        "model_eval_step_metrics": marts.step_metrics(feedback),
        "model_eval_failure_breakdown": marts.failure_breakdown(feedback, violations),
        "model_comparison_daily": marts.model_comparison_daily(feedback),
        "rater_agreement": marts.rater_agreement(ratings, feedback, metrics=schemas.METRICS),
    }


Run = lifecycle.Run


def _runs(df: DataFrame) -> dict[Run, int]:
    """Rows by (run_id, day), of those that have both: one for each manifest to write."""
    counts = df.where("run_id is not null and ingest_date is not null").groupBy(F.col("run_id").cast("string").alias("run_id"), F.col("ingest_date").cast("string").alias("ingest_date")).count()
    return {(r["run_id"], r["ingest_date"]): r["count"] for r in counts.collect()}


def _done(spark: SparkSession, lake: Lake, stage: str, runs: Iterable[Run]) -> set[Run]:
    return {(r, d) for r, d in runs if readers.path_exists(spark, writers.manifest_path(lake.manifests, stage, d, r))}


def _manifests(lake: Lake, stage: lifecycle.Stage, main: str, counts: dict[str, dict[tuple, int]], inputs: dict[Run, int], schema_hash: str) -> dict[str, int]:
    """Writes each run's counts to its manifest and row; the totals of the tables."""
    for r, d in sorted(stage.expected):
        own = {t: by.get((r, d), by.get((d,), 0)) for t, by in counts.items()}
        facts = {"input_count": inputs.get((r, d), 0), "output_count": own[main], "deadletter_count": own.get("deadletter", 0), "schema_hash": schema_hash}
        path = writers.write_manifest(stage.spark, lake.manifests, stage.name, d, r, counts=own, **{k: v for k, v in stage.facts.items() if k != "stage"}, **stage.times(), **facts)
        stage.done((r, d), manifest_path=path, **facts)
    return {t: sum(by.values()) for t, by in counts.items()}


def run_bronze(spark: SparkSession, lake: Lake, days: list[str] | None = None, force: bool = False, code_version: str | None = None) -> int:
    """Lands what has no manifest of its run and day yet; rows without a run always, for the rules to tell."""
    with lifecycle.Stage(spark, lake.ops, "bronze", code_version, [lake.raw], [lake.bronze]) as stage:
        read = writers.Counts(landed(readers.read_raw(spark, lake.raw, days)), ["run_id", "ingest_date"])
        rows = _unique(read.df).withColumn("bronze_ingest_ts", F.current_timestamp()).persist(StorageLevel.DISK_ONLY)
        try:
            runs = _runs(rows)
            done = set() if force else _done(spark, lake, "bronze", runs)
            stage.expect(runs.keys() - done)
            left = rows
            if done:
                known = spark.createDataFrame(sorted(done), "__run string, __day string")
                left = rows.join(known, (F.col("run_id") == F.col("__run")) & (F.col("ingest_date").cast("string") == F.col("__day")), "left_anti")
            counts = {"feedback": writers.write_layer(left, lake.bronze, "feedback", ("ingest_date", "run_id", "source_type"))}
            return _manifests(lake, stage, "feedback", counts, read.get(), _registered(spark, lake, stage, rows))["feedback"]
        finally:
            rows.unpersist()


def run_silver(spark: SparkSession, lake: Lake, run_ids: list[str] | None = None, code_version: str | None = None) -> dict[str, int]:
    """The silver tables of some runs, or of all; rows per table."""
    with lifecycle.Stage(spark, lake.ops, "silver", code_version, [lake.bronze], [lake.silver]) as stage:
        stage.expect((r, None) for r in run_ids or ())
        rows = spark.read.parquet(f"{lake.bronze}/feedback")
        rows = metadata.nonempty(rows if run_ids is None else rows.where(F.col("run_id").isin(*run_ids)), "bronze rows of these runs")
        tested = checked(rows).persist(StorageLevel.DISK_ONLY)
        try:
            inputs = _runs(tested)
            stage.expected = set(inputs)
            tables, counts = silver_tables(tested), {}
            for name, df in tables.items():
                counts[name] = writers.write_layer(df.withColumn("silver_processed_ts", F.current_timestamp()), lake.silver, name)
            letters = tables["deadletter"]
            writers.replace_ops(spark, lake.ops, "deadletter_summary", quality.dead_letter_summary(letters))
            writers.replace_ops(spark, lake.ops, "dq_results", quality.rule_results(letters))
            return _manifests(lake, stage, "feedback_step", counts, inputs, _registered(spark, lake, stage, tables["feedback_step"]))
        finally:
            tested.unpersist()


def _silver_table(spark: SparkSession, lake: Lake, name: str, like: DataFrame) -> DataFrame:
    """A silver table, empty with the right columns if it has no rows."""
    path = f"{lake.silver}/{name}"
    return spark.read.parquet(path) if readers.has_rows(spark, path) else like


def run_gold(spark: SparkSession, lake: Lake, run_ids: list[str] | None = None, code_version: str | None = None) -> dict[str, int]:
    """The marts; the daily mart is made over whole days, whatever the runs."""
    with lifecycle.Stage(spark, lake.ops, "gold", code_version, [lake.silver], [lake.gold]) as stage:
        stage.expect((r, None) for r in run_ids or ())
        feedback = spark.read.parquet(f"{lake.silver}/feedback_step")
        keys = "ingest_date date, run_id string, record_hash string, prompt_id string, evaluated_step_index int"
        ratings = _silver_table(spark, lake, "ratings_long", spark.createDataFrame([], f"{keys}, step_type string, task_type string, rater_type string, overall_label string, metric_name string, metric_score double"))
        violations = _silver_table(spark, lake, "violations", spark.createDataFrame([], f"{keys}, violation_source string, violation string"))
        days = feedback
        if run_ids is not None:
            ours = F.col("run_id").isin(*run_ids)
            days = feedback.join(feedback.where(ours).select("ingest_date").distinct(), "ingest_date", "left_semi")
            feedback, ratings, violations = feedback.where(ours), ratings.where(ours), violations.where(ours)
        inputs = _runs(metadata.nonempty(feedback, "silver rows of these runs"))
        stage.expected = set(inputs)
        tables = gold(feedback, ratings, violations) | {"model_comparison_daily": marts.model_comparison_daily(days)}
        counts = {name: writers.write_layer(df.withColumn("gold_processed_ts", F.current_timestamp()), lake.gold, name) for name, df in tables.items()}
        return _manifests(lake, stage, "training_supervised_examples", counts, inputs, _registered(spark, lake, stage, tables["training_supervised_examples"]))


def run_star(spark: SparkSession, lake: Lake) -> None:
    breakdown = f"{lake.gold}/model_eval_failure_breakdown"
    steps = spark.read.parquet(f"{lake.gold}/model_eval_step_metrics")
    empty = spark.createDataFrame([], "ingest_date date, run_id string, task_type string, model_version string, failure_type string, failure_value string, failure_count bigint")
    tables = star.star(steps, spark.read.parquet(breakdown) if readers.has_rows(spark, breakdown) else empty)
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{lake.star}/{name}")


def register_schemas(spark: SparkSession, lake: Lake, run_id: str, df: DataFrame, source_type: str, nested: dict[str, str] | None = None) -> int:
    """Adds a schema, with the types seen in nested columns if they are given, to the registry if it is new; how many were added."""
    names = sorted(df.columns)
    rows = spark.createDataFrame([(json.dumps({"columns": names, "nested": nested} if nested else names, sort_keys=True), run_id, source_type)], "schema_json string, first_seen_run_id string, source_type string")
    rows = rows.withColumn("schema_hash", F.sha2("schema_json", 256))
    path = f"{lake.ops}/schema_registry"
    new = control.first_seen(rows, spark.read.parquet(path) if readers.has_rows(spark, path) else None)
    return writers.append_ops(spark, lake.ops, "schema_registry", [r.asDict() for r in new.collect()])


def _registered(spark: SparkSession, lake: Lake, stage: lifecycle.Stage, df: DataFrame) -> str:
    """The schema's hash; it is registered under the first of the stage's runs."""
    run = min((r for r, _ in stage.expected), default=None)
    if run is not None:
        register_schemas(spark, lake, run, df, stage.name)
    return hashlib.sha256(json.dumps(sorted(df.columns)).encode()).hexdigest()


def plan(spark: SparkSession, lake: Lake, days: Iterable[str], force: bool = False) -> DataFrame:
    """(run_id, ingest_date, action): the stages that each run of these days still needs, by raw files and manifests."""
    runs = [(r, d) for d in days for r in readers.list_runs(spark, lake.raw, d)]
    name = lambda run: json.dumps(run)
    table = lambda some: spark.createDataFrame([(name(x),) for x in sorted(some)], "run_id string")
    done = {stage: table(_done(spark, lake, stage, runs)) for stage in ("bronze", "silver", "gold")}
    out = control.stage_plan(table(runs), done, force).select(F.from_json("run_id", "array<string>").alias("run"), "action")
    return out.select(F.col("run")[0].alias("run_id"), F.col("run")[1].alias("ingest_date"), "action")


def run_planned(spark: SparkSession, lake: Lake, days: list[str], force: bool = False, code_version: str | None = None) -> dict[Run, str]:
    """Carries out the plan of some days: each stage over the runs that need it, then the star; the actions by run."""
    actions = {(r["run_id"], r["ingest_date"]): r["action"] for r in plan(spark, lake, days, force).collect()}
    needs = lambda stage: sorted({r for (r, _), a in actions.items() if stage in a.split(",")})
    if needs("bronze"):
        run_bronze(spark, lake, days, force, code_version)
    if runs := needs("silver"):
        run_silver(spark, lake, runs, code_version)
    if runs := needs("gold"):
        run_gold(spark, lake, runs, code_version)
        run_star(spark, lake)
    return actions


def reconcile(spark: SparkSession, lake: Lake, stage: str, day: str, run_id: str, tables: Iterable[str]) -> DataFrame:
    """(table, expected, actual): a manifest's counts against the rows that a layer holds of its run and day.

    A table without runs, as the daily mart, is counted over the day.
    """
    manifest = json.loads(writers.get_text(spark, writers.manifest_path(lake.manifests, stage, day, run_id)))
    counts, rows, root = manifest.get("counts", {}), [], getattr(lake, stage)
    for t in tables:
        actual = 0
        if readers.has_rows(spark, f"{root}/{t}"):
            have = readers.read_table(spark, root, t, ingest_date=day)
            actual = (have.where(F.col("run_id") == run_id) if "run_id" in have.columns else have).count()
        rows.append((t, counts.get(t), actual))
    return spark.createDataFrame(rows, "table string, expected bigint, actual bigint")


def ingest_rest(spark: SparkSession, lake: Lake, urls: Iterable[str], schema: str, run_id: str, day: str, fetch=readers.fetch_json_list, legacy: bool = False) -> str:
    """REST sources to the raw layer in one go; ``legacy`` rows come under their old names."""
    rows = readers.read_rest(spark, urls, schema, fetch)
    if legacy:
        old = ingest.normalize_legacy(rows)
        rows = old.select(F.col("feedback_id").alias("prompt_id"), F.col("comment").alias("query_text"), F.col("rating").cast("string").alias("reviewer_comments"))
    return land_raw(spark, lake, rows, run_id, day, source_type="rest", source_uri=next(iter(urls), "rest") if isinstance(urls, (list, tuple)) else "rest")
