"""Queries that run the core operators on the driver's tables, and their SQL.

The tables hold no feedback records, so generic operators run on what they
have, and the feedback operators run on records derived from ``lineitem`` and
``orders`` (see ``_records``).  Nothing depends on the clock; ties are settled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.functions import columns as C
from quillspark.functions import text as X
from quillspark.operators import control, ingest, latest, marts, metadata, quality, reshape, retrieval, star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- feedback records derived from line items -------------------------------------------------------------------

#: Each line item as an evaluated step of its order, scored by arithmetic on its numbers.
_SCORES = {
    "primary_intent": ("l_quantity % 6", "(l_quantity + 1) % 6"),
    "information_gain": ("l_partkey % 6", "(l_partkey + 2) % 6"),
    "reasoning": ("l_suppkey % 6", "(l_suppkey + 3) % 6"),
    "understanding": ("l_linenumber % 6", "(l_linenumber + 4) % 6"),
    "implementation": ("(l_orderkey + l_linenumber) % 6", "(l_orderkey + 5) % 6"),
    "trajectory_robustness": ("(l_partkey + l_linenumber) % 6", "(l_suppkey + l_linenumber) % 6"),
}
_LABEL = "CASE WHEN {0} % 3 = 0 THEN 'LLM_RATED_BAD' WHEN {0} % 3 = 1 THEN 'LLM_RATED_OK' ELSE 'LLM_RATED_GOOD' END"
_KEY_SQL = """CAST(l_shipdate AS DATE) AS ingest_date, 'run_' || CAST(l_orderkey % 3 AS VARCHAR) AS run_id, 'prompt_' || CAST(l_orderkey AS VARCHAR) AS prompt_id,
 CAST(l_linenumber AS INTEGER) AS evaluated_step_index, 'task_' || l_returnflag AS task_type, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE 'model_' || CAST(l_suppkey % 4 AS VARCHAR) END AS model_version,
 CASE WHEN l_linestatus = 'F' THEN 'final' ELSE 'search' END AS step_type, CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_extendedprice AS VARCHAR) AS record_hash"""


def _absent_sql(side: int) -> str:
    """Rows that a side did not rate, other ones on each side."""
    return f"((l_orderkey + l_linenumber) % {7 + 2 * side} = {side})"


def _score_sql(side: int, metric: str) -> str:
    return f"CASE WHEN {_absent_sql(side)} THEN NULL ELSE CAST({_SCORES[metric][side]} AS DOUBLE) END"


def _label_sql(side: int) -> str:
    return f"CASE WHEN {_absent_sql(side)} THEN NULL ELSE {_LABEL.format(f'(l_partkey + {side})')} END"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records: curators, no reviewers but for every fifth, an automatic rating, violations."""
    # each side's rating is made once, null as a whole; the filter, which is not compiled into its stage, keeps the stages' methods small enough to be compiled
    struct = lambda side: "named_struct(" + ", ".join(f"'{m}', CAST({_SCORES[m][side]} AS DOUBLE)" for m in schemas.METRICS) + f", 'overall_label', {_LABEL.format(f'(l_partkey + {side})')})"
    rating = lambda side: f"get(filter(array({struct(side)}), x -> NOT {_absent_sql(side)}), 0)"
    keys = _KEY_SQL.replace("AS VARCHAR", "AS STRING")
    made = _t(spark, sf_dir, "lineitem").selectExpr("*", f"{rating(0)} AS r0", f"{rating(1)} AS r1")
    return made.selectExpr(
        *_split(keys),
        "r0 AS curator_1_rating",
        "r1 AS curator_2_rating",
        "CASE WHEN l_orderkey % 5 = 0 THEN r1 END AS reviewer_curator_1_rating",
        "CASE WHEN l_orderkey % 5 = 1 THEN r0 END AS reviewer_curator_2_rating",
        "CASE WHEN l_linenumber % 2 = 0 THEN named_struct('scores', r1, 'violations', CASE WHEN l_quantity < 5 THEN array('HALLUCINATION', ' ') END) END AS auto_rater",
        "CASE WHEN l_discount >= 0.09 THEN array('POLICY') WHEN l_discount >= 0.08 THEN array('POLICY', 'TOXICITY') ELSE CAST(array() AS array<string>) END AS violations",
        "CASE WHEN l_tax = 0 THEN '' ELSE 'query ' || l_returnflag END AS query_text",
        "'answer ' || CAST(l_partkey AS STRING) AS final_answer",
    )


def _split(select_list: str) -> list[str]:
    """Top-level items of a select list."""
    out, depth, item = [], 0, ""
    for c in select_list:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(item)
            item = ""
        else:
            item += c
    return [*out, item]


def _feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.with_final_scores(_records(spark, sf_dir))


def _final_sql(metric: str) -> str:
    a = f"coalesce(CASE WHEN l_orderkey % 5 = 0 THEN {_score_sql(1, metric)} END, {_score_sql(0, metric)})"
    b = f"coalesce(CASE WHEN l_orderkey % 5 = 1 THEN {_score_sql(0, metric)} END, {_score_sql(1, metric)})"
    return f"coalesce(round(({a} + {b}) / 2, 4), {a}, {b})"


_FINAL_LABEL_SQL = f"coalesce(CASE WHEN l_orderkey % 5 = 0 THEN {_label_sql(1)} END, CASE WHEN l_orderkey % 5 = 1 THEN {_label_sql(0)} END, {_label_sql(0)}, {_label_sql(1)})"
_FEEDBACK_SQL = f"feedback AS (SELECT {_KEY_SQL}, 'answer ' || CAST(l_partkey AS VARCHAR) AS final_answer, {', '.join(f'{_final_sql(m)} AS final_{m}' for m in schemas.METRICS)}, {_FINAL_LABEL_SQL} AS final_overall_label FROM lineitem)"
_VIOLATIONS_SQL = f"""violations AS (
 SELECT {_KEY_SQL}, 'record' AS violation_source, unnest(CASE WHEN l_discount >= 0.09 THEN ['POLICY'] WHEN l_discount >= 0.08 THEN ['POLICY', 'TOXICITY'] ELSE [] END) AS violation FROM lineitem
 UNION ALL SELECT {_KEY_SQL}, 'auto_rater', 'HALLUCINATION' FROM lineitem WHERE l_linenumber % 2 = 0 AND l_quantity < 5)"""
_SIDES = (("curator_1", 0, "true"), ("curator_2", 1, "true"), ("reviewer_curator_1", 1, "l_orderkey % 5 = 0"), ("reviewer_curator_2", 0, "l_orderkey % 5 = 1"), ("auto_rater", 1, "l_linenumber % 2 = 0"))
_RATINGS_SQL = "ratings AS (SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {_KEY_SQL}, '{r}' AS rater_type, {_label_sql(s)} AS overall_label, '{m}' AS metric_name, {_score_sql(s, m)} AS metric_score FROM lineitem WHERE {w}" for r, s, w in _SIDES for m in schemas.METRICS
) + ") WHERE metric_score IS NOT NULL OR overall_label IS NOT NULL)"
_FINALS = ", ".join(f"final_{m}" for m in schemas.METRICS)


@query(f"WITH {_FEEDBACK_SQL} SELECT record_hash, prompt_id, evaluated_step_index, {_FINALS} FROM feedback")
def two_source_final(spark, sf_dir):
    return _feedback(spark, sf_dir).select("record_hash", "prompt_id", "evaluated_step_index", *marts.FINAL)


@query(f"WITH {_FEEDBACK_SQL} SELECT prompt_id, evaluated_step_index, record_hash, final_overall_label FROM feedback")
def label_precedence(spark, sf_dir):
    return _feedback(spark, sf_dir).select("prompt_id", "evaluated_step_index", "record_hash", "final_overall_label")


@query(f"WITH {_RATINGS_SQL} SELECT run_id, prompt_id, record_hash, evaluated_step_index, rater_type, overall_label, metric_name, metric_score FROM ratings")
def ratings_long(spark, sf_dir):
    return reshape.ratings_long(_records(spark, sf_dir)).select("run_id", "prompt_id", "record_hash", "evaluated_step_index", "rater_type", "overall_label", "metric_name", "metric_score")


@query(f"WITH {_VIOLATIONS_SQL} SELECT run_id, prompt_id, record_hash, evaluated_step_index, violation_source, violation FROM violations")
def violations(spark, sf_dir):
    return reshape.violations(_records(spark, sf_dir)).select("run_id", "prompt_id", "record_hash", "evaluated_step_index", "violation_source", "violation")


@query(f"""WITH {_FEEDBACK_SQL}, {_VIOLATIONS_SQL},
l AS (SELECT *, row_number() OVER (PARTITION BY run_id, prompt_id ORDER BY evaluated_step_index DESC NULLS LAST, record_hash, final_answer) AS pos FROM feedback),
c AS (SELECT run_id, prompt_id, count(*) AS n FROM violations GROUP BY 1, 2)
SELECT l.ingest_date, l.run_id, l.prompt_id, task_type, model_version, final_answer, {_FINALS}, final_overall_label,
 round(({' + '.join(f'coalesce(final_{m}, 0.0)' for m in schemas.METRICS)}) / 6, 4) AS avg_quality_score, coalesce(c.n, 0) AS violation_count
FROM l LEFT JOIN c ON c.run_id = l.run_id AND c.prompt_id = l.prompt_id WHERE pos = 1""")
def training_supervised_examples(spark, sf_dir):
    return marts.training_examples(_feedback(spark, sf_dir), reshape.violations(_records(spark, sf_dir))).drop("query_text", "record_hash")


_METRICS_SQL = f"SELECT ingest_date, run_id, prompt_id, evaluated_step_index, task_type, step_type, model_version, {_FINALS}, final_overall_label, CASE WHEN final_overall_label = 'LLM_RATED_BAD' THEN 1 ELSE 0 END AS is_bad FROM feedback"


@query(f"WITH {_FEEDBACK_SQL} {_METRICS_SQL}")
def model_eval_step_metrics(spark, sf_dir):
    return marts.step_metrics(_feedback(spark, sf_dir))


_BREAKDOWN_SQL = """SELECT ingest_date, run_id, task_type, model_version, 'overall_label' AS failure_type, 'LLM_RATED_BAD' AS failure_value, count(*) AS failure_count
 FROM feedback WHERE final_overall_label = 'LLM_RATED_BAD' GROUP BY ALL
UNION ALL SELECT v.ingest_date, v.run_id, f.task_type, f.model_version, 'violation', v.violation, count(*) FROM violations v
 LEFT JOIN feedback f ON f.run_id = v.run_id AND f.prompt_id = v.prompt_id AND f.evaluated_step_index = v.evaluated_step_index GROUP BY ALL"""


def _violations(spark, sf_dir):
    return reshape.violations(_records(spark, sf_dir))


@query(f"WITH {_FEEDBACK_SQL}, {_VIOLATIONS_SQL} {_BREAKDOWN_SQL}")
def failure_breakdown(spark, sf_dir):
    return marts.failure_breakdown(_feedback(spark, sf_dir), _violations(spark, sf_dir))


@query(f"""WITH {_FEEDBACK_SQL} SELECT ingest_date, task_type, model_version, count(*) AS step_count, avg(CASE WHEN final_overall_label = 'LLM_RATED_BAD' THEN 1.0::DOUBLE ELSE 0.0 END) AS bad_rate,
 {', '.join(f'round(avg(final_{m}), 6) AS avg_{m}' for m in schemas.METRICS)} FROM feedback GROUP BY ALL""")
def model_comparison_daily(spark, sf_dir):
    out = marts.model_comparison_daily(_feedback(spark, sf_dir))
    return out.withColumns({f"avg_{m}": F.round(f"avg_{m}", 6) for m in schemas.METRICS})


@query(f"""WITH {_FEEDBACK_SQL}, {_RATINGS_SQL},
h AS (SELECT ingest_date, run_id, prompt_id, evaluated_step_index, metric_name, avg(metric_score) AS human FROM ratings WHERE rater_type <> 'auto_rater' GROUP BY ALL),
d AS (SELECT h.*, f.task_type, f.model_version, abs(human - a.metric_score) AS diff FROM h
 JOIN ratings a ON a.rater_type = 'auto_rater' AND a.ingest_date = h.ingest_date AND a.run_id = h.run_id AND a.prompt_id = h.prompt_id AND a.evaluated_step_index = h.evaluated_step_index AND a.metric_name = h.metric_name
 LEFT JOIN feedback f ON f.ingest_date = h.ingest_date AND f.run_id = h.run_id AND f.prompt_id = h.prompt_id AND f.evaluated_step_index = h.evaluated_step_index)
SELECT ingest_date, run_id, task_type, model_version, metric_name, count(*) AS comparison_count, round(avg(diff), 6) AS avg_abs_diff FROM d GROUP BY ALL""")
def rater_agreement(spark, sf_dir):
    return marts.rater_agreement(reshape.ratings_long(_records(spark, sf_dir)), _feedback(spark, sf_dir), metrics=schemas.METRICS).withColumn("avg_abs_diff", F.round("avg_abs_diff", 6))


# ---- data quality --------------------------------------------------------------------------------------------------


def _checked(spark, sf_dir):
    odd = _feedback(spark, sf_dir).withColumns({
        "final_overall_label": F.when(F.col("model_version").isNull(), F.lit("UNKNOWN")).otherwise(F.col("final_overall_label")),
        "final_reasoning": F.when(F.col("step_type") == "final", F.col("final_reasoning") + 2).otherwise(F.col("final_reasoning")),
        "evaluated_step_index": F.when(F.col("evaluated_step_index") == 6, F.lit(-1)).when(F.col("evaluated_step_index") == 7, F.lit(None)).otherwise(F.col("evaluated_step_index")),
        "raw_path": F.lit(None).cast("string"),
    })
    return quality.apply_rules(odd)


_CHECKED_SQL = f"""{_FEEDBACK_SQL}, q AS (SELECT {_KEY_SQL}, CASE WHEN l_tax = 0 THEN '' ELSE 'query' END AS query_text, {_FINAL_LABEL_SQL} AS label, {_final_sql('reasoning')} AS reasoning FROM lineitem),
checked AS (SELECT *, CASE WHEN evaluated_step_index = 6 THEN -1 ELSE evaluated_step_index END AS shown, list_filter([
 CASE WHEN query_text = '' THEN 'missing_query_text' END,
 CASE WHEN evaluated_step_index = 7 THEN 'missing_evaluated_step_index' END,
 CASE WHEN evaluated_step_index = 6 THEN 'invalid_evaluated_step_index' END,
 CASE WHEN model_version IS NULL THEN 'invalid_final_overall_label' END,
 CASE WHEN step_type = 'final' AND reasoning + 2 > 5 THEN 'out_of_range_reasoning' END], lambda x: x IS NOT NULL) AS reasons FROM q),
letters AS (SELECT run_id, prompt_id, record_hash, unnest(reasons) AS failure_reason FROM checked),
ruled AS (SELECT *, CASE failure_reason WHEN 'missing_query_text' THEN 'DQ_QUERY_TEXT_REQUIRED' WHEN 'invalid_final_overall_label' THEN 'DQ_FINAL_OVERALL_LABEL_ALLOWED'
 WHEN 'out_of_range_reasoning' THEN 'DQ_METRIC_RANGE_0_5' ELSE 'DQ_EVALUATED_STEP_INDEX_VALID' END AS rule_id, 'HIGH' AS severity FROM letters)"""


@query(f"WITH {_CHECKED_SQL} SELECT run_id, prompt_id, record_hash, array_to_string(reasons, ',') AS dq_reasons, len(reasons) = 0 AS dq_pass FROM checked")
def dq_reasons(spark, sf_dir):
    return _checked(spark, sf_dir).select("run_id", "prompt_id", "record_hash", F.array_join("dq_reasons", ",").alias("dq_reasons"), "dq_pass")


@query(f"WITH {_CHECKED_SQL} SELECT run_id, prompt_id, record_hash, failure_reason, rule_id, severity, 'raw_path=unknown;record_hash=' || record_hash AS evidence_ref FROM ruled")
def dq_deadletter(spark, sf_dir):
    return quality.dead_letters(_checked(spark, sf_dir)).select("run_id", "prompt_id", "record_hash", "failure_reason", "rule_id", "severity", "evidence_ref")


@query(f"WITH {_CHECKED_SQL} SELECT run_id, 'silver' AS stage, rule_id, failure_reason, count(*) AS count FROM ruled GROUP BY ALL")
def dq_summary(spark, sf_dir):
    return quality.dead_letter_summary(quality.dead_letters(_checked(spark, sf_dir)))


@query(f"""WITH {_CHECKED_SQL} SELECT run_id, 'silver' AS stage, 'feedback_step' AS table_name, rule_id, severity, count(*) AS failed_count,
 array_to_string(list_sort(list(DISTINCT record_hash))[1:20], ',') AS sample_record_hashes, false AS dq_pass FROM ruled GROUP BY ALL""")
def dq_results(spark, sf_dir):
    return quality.rule_results(quality.dead_letters(_checked(spark, sf_dir))).withColumn("sample_record_hashes", F.array_join("sample_record_hashes", ","))


_LOGIC = {r.rule_id: r.broken for r in reversed(quality.FEEDBACK_RULES)}


@query(f"""WITH {_CHECKED_SQL}, n AS (SELECT rule_id, count(*) AS failures FROM ruled GROUP BY 1)
SELECT t.rule_id, lower(substr(t.rule_id, 4)) AS name, description, severity, 'feedback_step' AS target_table, logic_reference, 'data-platform' AS owner, true AS enabled, coalesce(failures, 0) AS failures FROM (VALUES
 ('DQ_RUN_ID_REQUIRED', 'run_id must be present and non-empty', 'CRITICAL'), ('DQ_RECORD_HASH_REQUIRED', 'record_hash must be present and non-empty', 'CRITICAL'),
 ('DQ_PROMPT_ID_REQUIRED', 'prompt_id must be present and non-empty', 'HIGH'), ('DQ_QUERY_TEXT_REQUIRED', 'query_text must be present and non-empty', 'HIGH'),
 ('DQ_EVALUATED_STEP_INDEX_VALID', 'evaluated_step_index must be non-null and >= 0', 'HIGH'), ('DQ_FINAL_OVERALL_LABEL_ALLOWED', 'final_overall_label must be one of allowed labels', 'HIGH'),
 ('DQ_METRIC_RANGE_0_5', 'resolved metric fields must be in range [0, 5]', 'HIGH')) t(rule_id, description, severity)
 JOIN (VALUES {', '.join("('" + i + "', '" + b.replace("'", "''") + "')" for i, b in _LOGIC.items())}) l(rule_id, logic_reference) ON l.rule_id = t.rule_id LEFT JOIN n ON n.rule_id = t.rule_id""")
def dq_rule_registry(spark, sf_dir):
    """The registry beside the failures of each rule."""
    failures = quality.dead_letters(_checked(spark, sf_dir)).groupBy("rule_id").agg(F.count(F.lit(1)).alias("failures"))
    return quality.rule_registry(spark).join(failures, "rule_id", "left").withColumn("failures", F.coalesce("failures", F.lit(0).cast("long")))


# ---- star ------------------------------------------------------------------------------------------------------------


def _star(spark, sf_dir):
    feedback = _feedback(spark, sf_dir)
    return star.star(marts.step_metrics(feedback), marts.failure_breakdown(feedback, _violations(spark, sf_dir)))


def _dimension(name: str, column: str, key: str) -> None:
    @query(f"WITH {_FEEDBACK_SQL} SELECT DISTINCT sha256(coalesce({column}, 'unknown')) AS {key}, coalesce({column}, 'unknown') AS {column} FROM feedback")
    def dimension(spark, sf_dir):
        return _star(spark, sf_dir)[name]

    QUERIES[f"star_{name}"] = QUERIES.pop("dimension")
    ORACLE_SQL[f"star_{name}"] = ORACLE_SQL.pop("dimension")


for _name, _column, _key in (("dim_model", "model_version", "model_key"), ("dim_task", "task_type", "task_key"), ("dim_step_type", "step_type", "step_type_key"), ("dim_label", "final_overall_label", "label_key")):
    _dimension(_name, _column, _key)


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day, dayofweek(o_orderdate) + 1 AS day_of_week FROM orders")
def star_dim_date(spark, sf_dir):
    return star.date_dimension(_t(spark, sf_dir, "orders"), "o_orderdate")


@query(f"""WITH {_FEEDBACK_SQL}, m AS ({_METRICS_SQL}) SELECT ingest_date AS date_key, sha256(coalesce(model_version, 'unknown')) AS model_key, sha256(coalesce(task_type, 'unknown')) AS task_key,
 sha256(coalesce(step_type, 'unknown')) AS step_type_key, sha256(coalesce(final_overall_label, 'unknown')) AS label_key, run_id, prompt_id, evaluated_step_index, {_FINALS}, is_bad FROM m""")
def star_fact_model_eval_step(spark, sf_dir):
    return _star(spark, sf_dir)["fact_model_eval_step"]


@query(f"""WITH {_FEEDBACK_SQL}, {_VIOLATIONS_SQL}, b AS ({_BREAKDOWN_SQL}) SELECT ingest_date AS date_key, sha256(coalesce(model_version, 'unknown')) AS model_key, sha256(coalesce(task_type, 'unknown')) AS task_key,
 run_id, failure_type, failure_value, failure_count FROM b""")
def star_fact_failure_breakdown(spark, sf_dir):
    return _star(spark, sf_dir)["fact_failure_breakdown"]


# ---- generic operators on the driver's own columns --------------------------------------------------------------------


@query("""SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS step_count, round(avg(CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS bad_rate, round(avg(value), 6) AS avg_value
 FROM events GROUP BY ALL""")
def daily_comparison(spark, sf_dir):
    events = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    out = marts.conditional_daily(events, ["day", "event_type"], F.col("value") > 50, {"avg_value": F.col("value")})
    return out.withColumns({c: F.round(c, 6) for c in ("bad_rate", "avg_value")})


@query("""SELECT * EXCLUDE pos FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem) WHERE pos = 1""")
def latest_per_key(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return latest.latest_per_key(rows, ["l_orderkey"], "l_linenumber", ["l_partkey", "l_suppkey", "l_extendedprice"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((coalesce(nullif(l_quantity, 5), 0.0) + coalesce(nullif(l_discount, 0.0), 0.0) + coalesce(l_tax, 0.0)) / 3, 4) AS score FROM lineitem")
def penalised_mean(spark, sf_dir):
    score = C.penalised_mean([F.nullif("l_quantity", F.lit(5.0)), F.nullif("l_discount", F.lit(0.0)), F.col("l_tax")])
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", score.alias("score"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, m AS measure, v AS amount FROM (
 SELECT *, 'quantity' AS m, nullif(l_quantity, 1) AS v FROM lineitem UNION ALL SELECT *, 'discount', nullif(l_discount, 0) FROM lineitem UNION ALL SELECT *, 'tax', nullif(l_tax, 0) FROM lineitem) WHERE v IS NOT NULL""")
def wide_to_long(spark, sf_dir):
    values = {"quantity": F.nullif("l_quantity", F.lit(1.0)), "discount": F.nullif("l_discount", F.lit(0.0)), "tax": F.nullif("l_tax", F.lit(0.0))}
    out = reshape.wide_to_long(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], {"all": values}, "g", "measure", "amount")
    return out.drop("g")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def ensure_struct(spark, sf_dir):
    props = C.as_struct(_t(spark, sf_dir, "events"), "props", "struct<k: int>")
    return _t(spark, sf_dir, "events").select("event_id", props.alias("p")).select("event_id", "p.k")


@query("SELECT page_id, 'url' AS part_of, x AS part FROM (SELECT page_id, unnest(string_split(url, '/')) AS x FROM pages) WHERE trim(x, ' ') <> ''")
def explode_child(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select("page_id", F.to_json(F.split("url", "/")).alias("parts"))
    rows = rows.select("page_id", C.as_strings(rows, "parts"))
    return reshape.tagged_items(rows, ["page_id"], {"url": F.col("parts")}, "part_of", "part")


@query("SELECT s_nationkey AS nationkey, 'supplier' AS party, s_name AS name FROM supplier UNION ALL SELECT c_nationkey, 'customer', c_name FROM customer")
def tag_union(spark, sf_dir):
    s, c = _t(spark, sf_dir, "supplier"), _t(spark, sf_dir, "customer")
    return reshape.union_by_name(s.select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("party"), F.col("s_name").alias("name")), c.select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("party"), F.col("c_name").alias("name")))


@query("SELECT o_orderkey, o_orderstatus, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS returned FROM orders")
def left_counts(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return marts.left_counts(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), items, ["o_orderkey"], "returned")


@query("""WITH h AS (SELECT l_partkey, avg(l_quantity) AS q FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1)
SELECT l.l_partkey, count(*) AS comparison_count, round(avg(abs(h.q - l.l_quantity)), 6) AS avg_abs_diff FROM lineitem l JOIN h ON h.l_partkey = l.l_partkey WHERE l.l_returnflag = 'N' GROUP BY 1""")
def paired_difference(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_quantity")
    pairs = marts.paired_difference(rows, ["l_partkey"], "l_returnflag", "l_quantity", ["A", "R"], "N")
    return pairs.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("comparison_count"), F.round(F.avg("abs_diff"), 6).alias("avg_abs_diff"))


@query("SELECT sha256(text) AS text_hash, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def dedupe_key(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_hash"), "doc_id")
    return latest.deduplicate(rows, ["text_hash"], ["doc_id"])


@query("""SELECT schema_hash, min(run) AS first_seen_run_id FROM (SELECT 'h' || CAST(l_partkey % 500 AS VARCHAR) AS schema_hash, 'run' || CAST(l_suppkey AS VARCHAR) AS run FROM lineitem)
 WHERE schema_hash NOT IN (SELECT 'h' || CAST(o_custkey % 400 AS VARCHAR) FROM orders) GROUP BY 1""")
def first_seen_anti(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.concat(F.lit("h"), (F.col("l_partkey") % 500).cast("string")).alias("schema_hash"), F.lit("{}").alias("schema_json"), F.concat(F.lit("run"), F.col("l_suppkey").cast("string")).alias("first_seen_run_id"))
    known = _t(spark, sf_dir, "orders").select(F.concat(F.lit("h"), (F.col("o_custkey") % 400).cast("string")).alias("schema_hash"))
    return control.first_seen(rows, known).select("schema_hash", "first_seen_run_id")


@query("""WITH e AS (SELECT n_name AS field, CAST(n_regionkey AS VARCHAR) AS t FROM nation WHERE n_nationkey % 5 <> 0), a AS (SELECT n_name AS field, CASE WHEN n_nationkey % 3 = 0 THEN 'x' ELSE CAST(n_regionkey AS VARCHAR) END AS t FROM nation WHERE n_nationkey % 4 <> 0)
SELECT coalesce(e.field, a.field) AS field, CASE WHEN e.t IS NULL THEN 'added' WHEN a.t IS NULL THEN 'removed' ELSE 'type_change' END AS change, e.t AS expected, a.t AS actual, e.t IS NOT NULL AS breaking
FROM e FULL JOIN a ON a.field = e.field WHERE e.t IS NULL OR a.t IS NULL OR e.t <> a.t""")
def schema_diff(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    kind = F.col("n_regionkey").cast("string")
    expected = nation.where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("field"), kind.alias("type"))
    actual = nation.where("n_nationkey % 4 <> 0").select(F.col("n_name").alias("field"), F.when(F.col("n_nationkey") % 3 == 0, "x").otherwise(kind).alias("type"))
    return control.schema_diff(expected, actual)


@query("SELECT n_name AS run_id, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey % 5 = 0 THEN 'skip' WHEN n_nationkey % 3 = 0 THEN 'gold' WHEN n_nationkey % 2 = 0 THEN 'silver,gold' ELSE 'bronze,silver,gold' END AS action FROM nation")
def stage_plan(spark, sf_dir):
    runs = _t(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("run_id"))
    return control.stage_plan(runs, {"bronze": runs.where("n_nationkey % 2 = 0"), "silver": runs.where("n_nationkey % 3 = 0"), "gold": runs.where("n_nationkey % 2 = 0 and n_nationkey % 5 = 0")})


# ---- text, vectors, retrieval -----------------------------------------------------------------------------------------

_EMAIL_SQL = r"regexp_replace(regexp_replace(regexp_replace({0}, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}\b', '[REDACTED_EMAIL]', 'g'), '\bsk-[A-Za-z0-9]{{20,}}\b', '[REDACTED_API_KEY]', 'g'), '(?i)\bBearer\s+[A-Za-z0-9._-]+\b', 'Bearer [REDACTED_TOKEN]', 'g')"


@query(f"SELECT doc_id, {_EMAIL_SQL.format('text')} AS text FROM documents")
def redact_documents(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", X.redact(F.col("text")).alias("text"))


@query(f"SELECT conv_id, turn, role, {_EMAIL_SQL.format('text')} AS text FROM conversations")
def redact_conversations(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", X.redact(F.col("text")).alias("text"))


_TOKENS_SQL = r"list_distinct(list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> ''))"


@query(f"SELECT item_id, len({_TOKENS_SQL.format('text')}) AS n_tokens FROM benchmark")
def tokenize(spark, sf_dir):
    return _t(spark, sf_dir, "benchmark").select("item_id", F.size(X.tokens(F.col("text"))).cast("long").alias("n_tokens"))


@query(f"""WITH q AS (SELECT item_id, {_TOKENS_SQL.format('text')} AS t FROM benchmark WHERE item_id % 100 = 0), d AS (SELECT page_id, {_TOKENS_SQL.format('html')} AS t FROM pages)
SELECT item_id, page_id, round(len(list_intersect(q.t, d.t)) / greatest(1, len(q.t)), 6) AS overlap FROM q, d""")
def lexical_overlap(spark, sf_dir):
    """A search: items with an id divisible by 100 against every page's whole text."""
    q = _t(spark, sf_dir, "benchmark").where("item_id % 100 = 0").select("item_id", F.col("text").alias("query"))
    d = _t(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return retrieval.overlaps(q, d, "item_id", "page_id").withColumn("overlap", F.round("overlap", 6))


@query(f"""WITH q AS (SELECT item_id, {_TOKENS_SQL.format('text')} AS t FROM benchmark), d AS (SELECT page_id, {_TOKENS_SQL.format('html')} AS t FROM pages)
SELECT item_id, page_id, round(len(list_intersect(q.t, d.t)) / greatest(1, len(q.t)), 6) AS overlap FROM q, d""")
def lexical_overlap_all(spark, sf_dir):
    q = _t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))
    d = _t(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return retrieval.overlaps(q, d, "item_id", "page_id").withColumn("overlap", F.round("overlap", 6))


@query(f"""WITH q AS (SELECT item_id, {_TOKENS_SQL.format('text')} AS t FROM benchmark), d AS (SELECT page_id, {_TOKENS_SQL.format('html')} AS t FROM pages)
SELECT page_id, count(*) AS items, round(sum(len(list_intersect(q.t, d.t)) / greatest(1, len(q.t))), 4) AS overlap FROM q, d WHERE len(list_intersect(q.t, d.t)) > 0 GROUP BY 1""")
def lexical_shared(spark, sf_dir):
    """Of each page, how many items it shares a token with, and their overlaps added up."""
    q = _t(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("query"))
    d = _t(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    pairs = retrieval.overlaps(q, d, "item_id", "page_id", shared=True)
    return pairs.groupBy("page_id").agg(F.count(F.lit(1)).alias("items"), F.round(F.sum("overlap"), 4).alias("overlap"))


_NEAR_SQL = "SELECT q.vec_id AS query_id, e.vec_id AS item_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS c FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 100 = 0) q"


@query(f"SELECT query_id, item_id, round(c, 6) AS cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, item_id) AS rank FROM ({_NEAR_SQL})) WHERE rank <= 10")
def cosine_topk(spark, sf_dir):
    items = _t(spark, sf_dir, "embeddings")
    queries = items.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    out = retrieval.cosine_top_k(queries, items.select(F.col("vec_id").alias("item_id"), "embedding"), 10)
    return out.withColumns({"cosine": F.round("cosine", 6), "rank": F.col("rank").cast("long")})


def _values(rows, names: str) -> str:
    text = lambda v: "NULL" if v is None else "[" + ", ".join(map(text, v)) + "]" if isinstance(v, list) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) t({names}))"


_CASES_SQL = _values(retrieval.CASES, "case_id, query, expected_route, intent_hint, expected_uris")
_EVIDENCE_SQL = _values([(*e, i) for i, e in enumerate(retrieval.EVIDENCE)], "doc_id, uri, text, tags, position")
_ROUTE_SQL = "CASE WHEN {1} IN ('ops', 'dq') THEN {1} WHEN " + " OR ".join(f"contains(lower({{0}}), '{w}')" for w in X.DQ_WORDS) + " THEN 'dq' ELSE 'ops' END"
@query(f"""WITH asked AS (SELECT conv_id, turn, conv_id || ':' || turn AS query_id, text AS query, {_ROUTE_SQL.format('text', 'role')} AS route FROM conversations WHERE conv_id % 100 = 0),
pairs AS (SELECT a.*, d.uri, d.position, row_number() OVER (PARTITION BY query_id ORDER BY position) - 1 AS place,
 len(list_intersect({_TOKENS_SQL.format('query')}, {_TOKENS_SQL.format('d.text')})) / greatest(1, len({_TOKENS_SQL.format('query')})) AS lexical FROM asked a JOIN {_EVIDENCE_SQL} d ON list_contains(d.tags, a.route)),
ranked AS (SELECT *, 0.3::DOUBLE * lexical + 1.0::DOUBLE / (place + 1000) AS score FROM pairs)
SELECT query_id, uri, round(score, 9) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, position) AS rank FROM ranked) WHERE rank <= 3""")
def hybrid_topk(spark, sf_dir):
    """The built-in evidence for every turn of a conversation whose id is divisible by 100, by the turn's route."""
    turns = _t(spark, sf_dir, "conversations").where("conv_id % 100 = 0")
    asked = turns.select(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("query_id"), F.col("text").alias("query"), X.route(F.col("text"), F.col("role")).alias("route"))
    out = retrieval.hybrid_top_k(asked, retrieval.evidence(spark), 3, F.col("route")).drop("doc_id")
    return out.withColumns({"score": F.round("score", 9), "rank": F.col("rank").cast("long")})


#: Each item of the benchmark as a document, and as a case that should find it.
_CASES_OF_ITEMS_SQL = f"""items AS (SELECT 'i' || item_id AS doc_id, 'item://' || item_id AS uri, text, [{_ROUTE_SQL.format('text', "''")}] AS tags, 100 + item_id AS position FROM benchmark),
cases AS (SELECT doc_id AS case_id, text AS query, tags[1] AS expected_route, CAST(NULL AS VARCHAR) AS intent_hint, [uri] AS expected_uris FROM items)"""


def _cases_of_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    docs = items.select(F.concat(F.lit("i"), F.col("item_id").cast("string")).alias("doc_id"), F.concat(F.lit("item://"), F.col("item_id").cast("string")).alias("uri"), "text", F.array(X.route(F.col("text"))).alias("tags"), (100 + F.col("item_id")).cast("int").alias("position"))
    return docs.select(F.col("doc_id").alias("case_id"), F.col("text").alias("query"), F.col("tags")[0].alias("expected_route"), F.lit(None).cast("string").alias("intent_hint"), F.array("uri").alias("expected_uris")), docs


@query(f"""WITH {_CASES_OF_ITEMS_SQL}, asked AS (SELECT *, {_ROUTE_SQL.format('query', 'intent_hint')} AS route FROM cases),
pairs AS (SELECT a.*, d.uri, d.position, row_number() OVER (PARTITION BY case_id ORDER BY d.position) - 1 AS place,
 len(list_intersect({_TOKENS_SQL.format('query')}, {_TOKENS_SQL.format('d.text')})) / greatest(1, len({_TOKENS_SQL.format('query')})) AS lexical FROM asked a LEFT JOIN items d ON list_contains(d.tags, a.route)),
found AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY 0.3::DOUBLE * lexical + 1.0::DOUBLE / (place + 1000) DESC, position) AS rank FROM pairs),
g AS (SELECT case_id, any_value(route) = any_value(expected_route) AS route_hit, coalesce(bool_or(list_contains(expected_uris, uri)), false) AS hit, count(uri) > 0 AS grounded FROM found WHERE rank <= 3 GROUP BY 1)
SELECT avg(CAST(hit AS DOUBLE)) AS recall_at_k, avg(CAST(route_hit AS DOUBLE)) AS route_accuracy, avg(CAST(grounded AS DOUBLE)) AS grounding_rate, 1 - avg(CAST(grounded AS DOUBLE)) AS unsupported_rate,
 avg(CAST(hit AS DOUBLE)) >= 0.8 AND avg(CAST(route_hit AS DOUBLE)) >= 1 AND avg(CAST(grounded AS DOUBLE)) >= 1 AS gate_passed FROM g""")
def eval_metrics(spark, sf_dir):
    """The suite's report over the benchmark: each item should find itself among all."""
    labelled, docs = _cases_of_items(_t(spark, sf_dir, "benchmark"))
    return retrieval.evaluation_report(retrieval.evaluate(spark, labelled=labelled, docs=docs))


@query(f"SELECT conv_id, turn, role, {_ROUTE_SQL.format('text', 'role')} AS route FROM conversations")
def route_intent(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", "role", X.route(F.col("text"), F.col("role")).alias("route"))


_CLASS_SQL = "CASE " + " ".join(f"WHEN {' OR '.join(f"contains(lower({{0}}), '{w}')" for w in words)} THEN '{c}'" for c, words in X.ERROR_WORDS) + " ELSE 'RUNTIME' END"


@query(f"SELECT event_id, {_CLASS_SQL.format('m')} AS error_category FROM (SELECT event_id, CASE CAST(event_id % 9 AS INTEGER) WHEN 0 THEN 'Access Denied' WHEN 1 THEN 'bad token' WHEN 2 THEN 'no such column' WHEN 3 THEN 'quality gate' WHEN 4 THEN 'missing value' WHEN 5 THEN 'connection lost' WHEN 6 THEN 'import failed' WHEN 7 THEN event_type END AS m FROM events)")
def classify_error(spark, sf_dir):
    slot = (F.col("event_id") % 9).cast("int")
    texts = F.array(*map(F.lit, ("Access Denied", "bad token", "no such column", "quality gate", "missing value", "connection lost", "import failed")))
    message = F.when(slot == 7, F.col("event_type")).when(slot < 7, F.get(texts, slot))
    return _t(spark, sf_dir, "events").select("event_id", X.error_category(message).alias("error_category"))


@query(r"SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace(lower(url), '[^\p{L}\p{N}]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'na') AS segment FROM pages")
def sanitize(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", X.sanitize(F.col("url")).alias("segment"))


# ---- ingest and metadata ----------------------------------------------------------------------------------------------


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS step_index, CASE WHEN event_id % 4 = 0 THEN 'int_parse_error:step_index' ELSE '' END || CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 4 = 0 THEN ',' ELSE '' END || 'json' ELSE '' END AS faults FROM events""")
def normalize_payload(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    rows = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("-"), k)).otherwise(k).alias("step_index"), F.when(F.col("event_id") % 3 == 0, F.lit('{"bad')).otherwise(F.lit("")).alias("execution_json"))
    out = ingest.normalize_payload(rows)
    faults = F.array_join(F.array_sort(F.transform("parse_errors", lambda e: F.when(e.startswith("json"), F.lit("json")).otherwise(e))), ",")
    return out.select("event_id", "step_index", faults.alias("faults"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'own' ELSE 'r' || CAST(event_id % 3 AS VARCHAR) END AS run_id, CASE WHEN event_id % 2 = 0 THEN 'csv' ELSE 'unknown' END AS source_type,
 sha256('["event_id","run_id","value"]') AS schema_hash, event_id % 5 = 0 AS kept_hash FROM events""")
def normalize_raw(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(
        F.struct(F.lit(None).cast("string").alias("run_id"), F.when(F.col("event_id") % 2 == 0, "csv").alias("source_type"), F.when(F.col("event_id") % 5 == 0, "kept").alias("record_hash")).alias("meta"),
        F.struct("event_id", "value", F.when(F.col("event_id") % 7 == 0, "own").alias("run_id")).alias("payload"),
        F.concat(F.lit("raw/a/dt=2026-01-01/run_id=r"), (F.col("event_id") % 3).cast("string"), F.lit("/part")).alias("raw_path"),
    )
    out = metadata.normalize_raw(rows, F.lit("2026-01-01").cast("timestamp"), unhashed=("pod_name", "pod_type", "task_type", "source_name"))
    return out.select("event_id", "run_id", "source_type", "schema_hash", (F.col("record_hash") == "kept").alias("kept_hash"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN DATE '2026-01-02' WHEN page_id % 3 = 1 THEN DATE '2026-01-03' END AS ingest_date FROM pages")
def path_dates(spark, sf_dir):
    path = F.when(F.col("page_id") % 3 == 0, "raw/dt=2026-01-02/x").when(F.col("page_id") % 3 == 1, "b/dt=2026-01-09/ingest_date=2026-01-03/x").otherwise("b/dt=2026-13-45/x")
    return _t(spark, sf_dir, "pages").select("page_id", C.date_of_path(path).alias("ingest_date"))


@query("SELECT c_custkey, sha256('{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\"}') AS record_hash FROM customer")
def record_hash(spark, sf_dir):
    rows = _t(spark, sf_dir, "customer")
    return rows.select("c_custkey", C.record_hash(rows, ["c_name", "c_custkey"]).alias("record_hash"))


@query("""SELECT o_orderkey, sha256('{"m":[' || o_custkey || ',null],"name":"a\\\\\\"b","price":' || CAST(o_totalprice AS VARCHAR) || ',"z":{"a":' || o_orderkey || ',"b":' || CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}}') AS record_hash FROM orders""")
def record_hash_nested(spark, sf_dir):
    """Nested values with nulls and fractions."""
    z = F.struct(F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("b"), F.col("o_orderkey").alias("a"))
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", z.alias("z"), F.col("o_totalprice").alias("price"), F.lit('a\\"b').alias("name"), F.array("o_custkey", F.lit(None)).alias("m"))
    return rows.select("o_orderkey", C.record_hash(rows, ["z", "price", "name", "m"]).alias("record_hash"))


@query("SELECT p_partkey, trim(p_name, ' ') AS p_name, coalesce(nullif(p_brand, ''), p_type) AS model FROM part")
def trim_and_fill(spark, sf_dir):
    rows = metadata.trim_strings(_t(spark, sf_dir, "part").withColumn("p_name", F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))))
    return rows.select("p_partkey", "p_name", C.first_filled(F.col("p_brand"), F.col("p_type")).alias("model"))


# ---- control plane ------------------------------------------------------------------------------------------------------


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT min(ts) FROM events) + INTERVAL 10 DAY")
def retention(spark, sf_dir):
    events = _t(spark, sf_dir, "events")
    edge = events.agg(F.min("ts")).first()[0]
    return latest.retained(events, 0, "ts", F.lit(edge) + F.make_dt_interval(days=F.lit(10))).select("event_id", "user_id")


@query("SELECT event_type, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-10 00:00:00') AS kept, count(*) FILTER (WHERE NOT ts >= TIMESTAMP '2024-01-10 00:00:00') AS purged FROM events GROUP BY 1")
def purge_report(spark, sf_dir):
    return latest.purge_report(_t(spark, sf_dir, "events"), "event_type", 86400, "ts", F.lit("2024-01-11 00:00:00").cast("timestamp"))


_VERSIONS_SQL = "SELECT user_id AS proposal_id, CASE CAST(event_id % 3 AS INTEGER) WHEN 0 THEN 'DRAFT' WHEN 1 THEN 'REVIEW' ELSE 'APPROVED' END AS status, ts AS updated_ts, event_id FROM events"


def _versions(spark, sf_dir):
    status = F.when(F.col("event_id") % 3 == 0, "DRAFT").when(F.col("event_id") % 3 == 1, "REVIEW").otherwise("APPROVED")
    return _t(spark, sf_dir, "events").select(F.col("user_id").alias("proposal_id"), status.alias("status"), F.col("ts").alias("updated_ts"), "event_id")


_STATE_SQL = f"state AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY proposal_id ORDER BY updated_ts DESC, event_id) AS pos FROM ({_VERSIONS_SQL})) WHERE pos = 1)"


@query(f"WITH {_STATE_SQL} SELECT proposal_id, status, event_id FROM state")
def proposal_state(spark, sf_dir):
    return control.latest_state(_versions(spark, sf_dir), ties=["event_id"]).select("proposal_id", "status", "event_id")


@query(f"""WITH {_STATE_SQL}, r AS (SELECT c_custkey AS proposal_id, CASE WHEN c_custkey % 2 = 0 THEN 'REVIEW' ELSE 'APPROVED' END AS new_status, CASE CAST(c_custkey % 3 AS INTEGER) WHEN 0 THEN 'viewer' WHEN 1 THEN 'operator' ELSE 'approver' END AS actor_role FROM customer),
o AS (SELECT r.*, s.status, CASE WHEN s.status IS NULL THEN 'proposal_not_found' WHEN NOT ((s.status = 'DRAFT' AND new_status = 'REVIEW') OR (s.status = 'REVIEW' AND new_status = 'APPROVED')) THEN 'invalid_status_transition'
 WHEN new_status = 'APPROVED' AND actor_role <> 'approver' THEN 'role_not_allowed_for_approval' WHEN new_status = 'REVIEW' AND actor_role = 'viewer' THEN 'role_not_allowed_for_transition' ELSE 'ok' END AS outcome FROM r LEFT JOIN state s ON s.proposal_id = r.proposal_id)
SELECT proposal_id, status, new_status, actor_role, outcome, CASE WHEN outcome = 'ok' THEN new_status ELSE status END AS resulting_status FROM o""")
def proposal_transitions(spark, sf_dir):
    requests = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("proposal_id"),
        F.when(F.col("c_custkey") % 2 == 0, "REVIEW").otherwise("APPROVED").alias("new_status"),
        F.when(F.col("c_custkey") % 3 == 0, "viewer").when(F.col("c_custkey") % 3 == 1, "operator").otherwise("approver").alias("actor_role"),
    )
    return control.judge_transitions(control.latest_state(_versions(spark, sf_dir), ties=["event_id"]), requests)


@query("SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS user, count(*) FILTER (WHERE role = 'assistant') AS assistant, count(*) FILTER (WHERE role = 'system') AS system FROM conversations GROUP BY 1")
def audit_summary(spark, sf_dir):
    return control.audit_summary(_t(spark, sf_dir, "conversations"), ["user", "assistant", "system"], "conv_id", "role")


@query("SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def batch_counts(spark, sf_dir):
    return control.batch_counts(_t(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 500")
def newest_rows(spark, sf_dir):
    return latest.newest_rows(_t(spark, sf_dir, "events").select("event_id", "ts", "event_type"), 100_000, "ts", ["event_id"])


@query("""SELECT p_partkey AS proposal_id, 'gs://agent-proposals/env=dev/layer=' || lower(layer) || '/run_id=latest_failed_run/proposal_id=' || p_partkey || '/' AS prefix, 'mapping_spec_add_column_' || s || '_to_gold_t.json' AS mapping_spec,
 'test_plan_add_column_' || s || '_to_gold_t.md' AS test_plan, 'schema_preview_add_column_' || s || '_to_gold_t.json' AS schema_preview, CASE layer WHEN 'B2S' THEN 0.78::DOUBLE ELSE 0.8::DOUBLE END AS confidence_score,
 'Transform Designer (' || layer || ') draft proposal generated. This proposal is read-only and NOT auto-applied. Playbook focus: ' || CASE layer WHEN 'B2S' THEN 'contract alignment, normalization, metadata propagation, deterministic dedup keys, and DQ/deadletter routing'
 ELSE 'KPI logic, curated dimensional outputs, publish-readiness checks, and partition/clustering suitability' END || '. Change type: add column. Source: ' || p_brand || '. Target: gold.t. Problem: ' || p_type || '.' AS proposal_text
 FROM (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'B2S' ELSE 'S2G' END AS layer, coalesce(nullif(regexp_replace(regexp_replace(lower(p_brand), '[^a-z0-9]', '_', 'g'), '^_+|_+$', '', 'g'), ''), 'na') AS s FROM part)""")
def design_artifacts(spark, sf_dir):
    layer = F.when(F.col("p_partkey") % 2 == 0, "B2S").otherwise("S2G")
    rows = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("proposal_id"), layer.alias("layer"), F.lit("add column").alias("change_type"), F.col("p_brand").alias("source_table"), F.lit("gold.t").alias("target_table"), F.lit("").alias("run_id"), F.lit("dev").alias("env"), F.col("p_type").alias("problem_statement"))
    name = lambda i: F.element_at(F.split(F.col("generated_artifacts")[i], "/"), -1)
    prefix = F.regexp_extract(F.col("generated_artifacts")[0], "^(.*/)", 1)
    return control.design_artifacts(rows).select("proposal_id", prefix.alias("prefix"), name(0).alias("mapping_spec"), name(1).alias("test_plan"), name(2).alias("schema_preview"), "confidence_score", "proposal_text")


# ---- trajectories, the flat feedback table, legacy rows ---------------------------------------------------------------


@query(f"""WITH s AS (SELECT {_KEY_SQL}, l_linenumber, unnest(range(0, CAST(l_linenumber AS BIGINT) % 4 + 1)) AS at_step FROM lineitem)
SELECT run_id, prompt_id, record_hash, evaluated_step_index, model_version, CAST(at_step AS INTEGER) AS execution_step_index, CASE WHEN at_step = 0 THEN 'search' ELSE 'tool' END AS execution_step_type, CASE WHEN at_step = 0 THEN 'q' || CAST(at_step AS VARCHAR) END AS tool_query FROM s WHERE at_step <> 2""")
def execution_steps(spark, sf_dir):
    step = "transform(sequence(0, l_linenumber % 4), i -> named_struct('step_index', if(i = 2, cast(null as int), i), 'step_type', if(i = 0, 'search', 'tool'), 'tool_name', cast(null as string), 'query', if(i = 0, 'q0', cast(null as string)), 'tool_output', cast(null as string), 'partial_answer', cast(null as string)))"
    keys = _split(_KEY_SQL.replace("AS VARCHAR", "AS STRING"))
    rows = _t(spark, sf_dir, "lineitem").selectExpr(*keys, "l_linenumber").selectExpr("*", f"named_struct('model_version', model_version, 'steps', {step}) AS execution_json")
    return reshape.execution_steps(rows).select("run_id", "prompt_id", "record_hash", "evaluated_step_index", "model_version", "execution_step_index", "execution_step_type", "tool_query")


@query(f"""WITH {_FEEDBACK_SQL} SELECT ingest_date, run_id, prompt_id, record_hash, evaluated_step_index, task_type, step_type, model_version, CAST(NULL AS VARCHAR) AS batch_id, CAST(NULL AS VARCHAR) AS rubric_version, {_FINALS}, final_overall_label FROM feedback""")
def feedback_step(spark, sf_dir):
    rows = quality.apply_rules(_feedback(spark, sf_dir), [])
    rating = schemas.NESTED["auto_rater"]
    rows = rows.withColumns({"execution_json": F.struct("model_version", "final_answer"), "auto_rater": F.lit(None).cast(schemas.parse(rating))})
    names = ["ingest_date", "run_id", "prompt_id", "record_hash", "evaluated_step_index", "task_type", "step_type", "model_version", "batch_id", "rubric_version", *marts.FINAL, "final_overall_label"]
    return reshape.feedback_step(rows).select(*names)


@query("""SELECT coalesce(CASE WHEN page_id % 2 = 0 THEN nullif(url, '') END, CAST(page_id AS VARCHAR)) AS feedback_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'c' END AS comment, CAST(NULL AS VARCHAR) AS model, page_id AS rating FROM pages""")
def normalize_legacy(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise("").alias("feedback_id"), F.col("page_id").cast("string").alias("id"), F.when(F.col("page_id") % 3 != 0, "c").alias("text"), F.col("page_id").alias("rating"))
    return ingest.normalize_legacy(rows).select("feedback_id", "comment", "model", "rating")


@query("""SELECT o_orderkey, o_orderpriority FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) UNION ALL
 SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 5 = 1""")
def run_filter(spark, sf_dir):
    """By day through the date operator, by run and by batch through theirs."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("ingest_date"), F.concat(F.lit("raw/batch_id="), (F.col("o_custkey") % 5).cast("string"), F.lit("/x")).alias("raw_path"))
    last = str(orders.agg(F.max("ingest_date")).first()[0])
    by_batch = metadata.in_batch(metadata.nonempty(orders, "orders"), "1").where("o_orderstatus = 'O'")
    return metadata.with_ingest_date(orders, last).select("o_orderkey", "o_orderpriority").union(by_batch.select("o_orderkey", "o_orderpriority"))


from quillspark.plans import layer_queries  # noqa: E402, F401  registers the queries of sources, sinks and layers
