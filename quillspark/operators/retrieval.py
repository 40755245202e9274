"""Evidence retrieval over tables, and its evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators import blocks, places

# The built-in evidence documents, in order.
EVIDENCE = (
    ("ops_pipeline_runs", "bq://ops.pipeline_runs", "Pipeline stage status, timings, counts, manifest path, code_version and partition lineage.", ["ops"]),
    ("ops_schema_registry", "bq://ops.schema_registry", "Schema hash snapshots and first-seen lineage for bronze silver gold outputs.", ["ops"]),
    ("ops_dq_results", "bq://ops.dq_results", "Rule-level data quality results including failed count, severity, and sample record hashes.", ["dq"]),
    ("ops_deadletter_summary", "bq://ops.deadletter_summary", "Aggregated deadletter distribution by rule and failure reason with counts.", ["dq"]),
    ("dq_rules_registry", "gcs://dq/dq_rules.yaml", "DQ rule registry with rule_id, severity, owner, and logic reference.", ["dq"]),
    ("manifest_convention", "gcs://manifests/<stage>/dt=<date>/run_id=<run_id>/manifest.json", "Manifest location convention for raw bronze silver gold publish stages.", ["ops", "dq"]),
)
_RUNS, _REGISTRY, _RESULTS, _LETTERS, _RULES, _MANIFEST = (e[1] for e in EVIDENCE)
# Labelled cases of retrieval.
CASES = (
    ("ops_01", "show me the latest pipeline run status", "ops", None, [_RUNS]),
    ("ops_02", "what are the current schema registry snapshots", "ops", None, [_REGISTRY]),
    ("ops_03", "which stages completed in the last run", "ops", None, [_RUNS, _MANIFEST]),
    ("ops_04", "show manifest path and code version for bronze stage", "ops", None, [_RUNS, _MANIFEST]),
    ("ops_05_hint", "diagnose the pipeline run failure", "ops", "ops", [_RUNS]),
    ("dq_01", "why did deadletter counts increase last run", "dq", None, [_LETTERS]),
    ("dq_02", "which dq rule violations are highest severity", "dq", None, [_RESULTS, _RULES]),
    ("dq_03", "show failing quality checks for feedback data", "dq", None, [_RESULTS]),
    ("dq_04", "list records quarantined by nullability rule", "dq", None, [_LETTERS, _RESULTS]),
    ("dq_05_hint", "investigate quality violation anomaly", "dq", "dq", [_RESULTS]),
)
#: Least (or, for unsupported, greatest) values that pass.
THRESHOLDS = {"recall_at_k": 0.8, "route_accuracy": 1.0, "grounding_rate": 1.0, "unsupported_rate": 0.0}


def evidence(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*e, i) for i, e in enumerate(EVIDENCE)], "doc_id string, uri string, text string, tags array<string>, position int")


def cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CASES), "case_id string, query string, expected_route string, intent_hint string, expected_uris array<string>")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query among the best of each task."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), blocks.TIE))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hybrid_top_k(queries: DataFrame, docs: DataFrame, k: int, tag: Column | None = None, query_id: str = "query_id", block: int = 1000) -> DataFrame:
    """(query_id, doc_id, uri, score, rank) of the ``k`` best documents of each query.

    Score: 0.7 cosine (0 where there are no ``embedding`` columns) + 0.3 lexical
    overlap + 1 / (place + 1000), the place counting candidates with the tag from 0.
    Every document with the tag is scored, however many there are; places are numbered
    once per tag, before queries and documents meet by blocks of about ``block`` queries, and each task keeps its best ``k``.
    """
    k = max(1, k)
    vectors, tagged = "embedding" in docs.columns and "query_embedding" in queries.columns, tag is not None
    asked = queries.select(F.col(query_id).alias("query"), X.tokens(F.col("query")).alias("tokens"), *([F.col("query_embedding").alias("vector")] if vectors else []), *([tag.alias("tag")] if tagged else []))
    items = docs.select("doc_id", "uri", F.col("position").alias(blocks.TIE), X.tokens(F.col("text")).alias("tokens"), *([F.col("embedding").alias("vector")] if vectors else []), *([F.explode(F.array_distinct("tags")).alias("tag")] if tagged else []))
    items = places.dense_places(items.where("tag is not null") if tagged else items, [F.col(blocks.TIE)], "tag" if tagged else None)

    def score(own: blocks.Asked, part, pairs=None):
        lexical = own.overlap(part.column("tokens"))
        rows = 1.0 / (part.column("place").to_numpy() + 1000)
        out = 0.3 * lexical + rows[:, None] if pairs is None else 0.3 * lexical[pairs] + rows[pairs[0]]
        if vectors:
            out = 0.7 * own.cosine(part.column("vector"), pairs) + out
        if tagged and pairs is None:
            have = np.array(part.column("tag").to_pylist(), dtype=object)
            out = np.where(have[:, None] == own.tags[None, :], out, -np.inf)
        return out

    found = blocks.top_k(asked, items, k, score, ["doc_id", "uri"], block)
    return _best(found, k).select(F.col("query").alias(query_id), "doc_id", "uri", "score", "rank")


def overlaps(queries: DataFrame, docs: DataFrame, query_id: str = "query_id", doc_id: str = "doc_id", block: int = 1000, shared: bool = False) -> DataFrame:
    """(query_id, doc_id, overlap) of every query with every document, none left out: the share of the query's tokens that the text has.

    ``shared`` gives the pairs that share a token; all others have 0.  Each text is cut into tokens once and looked up
    in the words of a block of queries.
    """
    asked = queries.select(F.col(query_id).alias("query"), X.tokens(F.col("query")).alias("tokens"))
    items = docs.select(F.col(doc_id).alias("item"), X.tokens(F.col("text")).alias("tokens"))
    out = blocks.overlaps(asked, _spread(items, "item"), block, all_pairs=not shared)
    return out.select(F.col("query").alias(query_id), F.col("item").alias(doc_id), "overlap")


def _spread(items: DataFrame, key: str, rows: int = 20_000) -> DataFrame:
    """A table in so few files that only some cores would read it, over more tasks; others as they are."""
    spark = items.sparkSession
    if items.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return items
    return items.repartition(max(1, min(2 * spark.sparkContext.defaultParallelism, -(-items.count() // rows))), key)


def cosine_top_k(queries: DataFrame, items: DataFrame, k: int, block: int = 1000) -> DataFrame:
    """(query_id, item_id, cosine, rank): the ``k`` nearest items of each query, ties by id.

    One pass over the items against blocks of about ``block`` queries; each task keeps its best ``k``.
    """
    asked = queries.select(F.col("query_id").alias("query"), F.col("query_embedding").alias("vector"))
    filed = items.select(F.col("item_id").alias(blocks.TIE), F.col("embedding").alias("vector"))
    found = blocks.top_k(asked, filed, k, lambda own, part, pairs=None: own.cosine(part.column("vector"), pairs), [], block)
    return _best(found, k).select(F.col("query").alias("query_id"), F.col(blocks.TIE).alias("item_id"), F.col("score").alias("cosine"), "rank")


def evaluate(spark: SparkSession, k: int = 3, routed: bool = True, labelled: DataFrame | None = None, docs: DataFrame | None = None) -> DataFrame:
    """Each case with what retrieval returned, its route and whether it hit; the built-in cases and documents if no others are given."""
    labelled, docs = cases(spark) if labelled is None else labelled, evidence(spark) if docs is None else docs
    asked = labelled.withColumn("route", X.route(F.col("query"), F.col("intent_hint")))
    tag = F.col("route") if routed else F.col("expected_route")
    found = hybrid_top_k(asked, docs, k, tag, "case_id").groupBy("case_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "uri"))), lambda x: x["uri"]).alias("uris"))
    out = asked.join(found, "case_id", "left").withColumn("uris", F.coalesce("uris", F.array().cast("array<string>")))
    return out.select(
        "case_id", "route", "uris", F.arrays_overlap("uris", "expected_uris").alias("recall_hit"), (F.col("route") == F.col("expected_route")).alias("route_hit"), (F.size("uris") > 0).alias("grounded")
    )


def evaluation_report(evaluated: DataFrame) -> DataFrame:
    """Rates over the cases, 0 without any, and whether all thresholds hold."""
    rate = lambda c: F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0))
    out = evaluated.agg(rate("recall_hit").alias("recall_at_k"), rate("route_hit").alias("route_accuracy"), rate("grounded").alias("grounding_rate"))
    out = out.withColumn("unsupported_rate", 1 - F.col("grounding_rate"))
    passed = [F.col(n) <= t if n == "unsupported_rate" else F.col(n) >= t for n, t in THRESHOLDS.items()]
    return out.withColumn("gate_passed", passed[0] & passed[1] & passed[2] & passed[3])
