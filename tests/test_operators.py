"""Operators on small rows whose results are worked out by hand."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.operators import control, latest, marts, places, quality, reshape, retrieval, star
from quillspark.plans import queries

FEEDBACK = "ingest_date string, run_id string, prompt_id string, evaluated_step_index int, task_type string, step_type string, model_version string, query_text string, final_answer string, " + ", ".join(f"final_{m} double" for m in schemas.METRICS) + ", final_overall_label string"


def feedback(spark, *rows):
    """Rows of (step, score, label, answer)."""
    return spark.createDataFrame([("2026-01-01", "r", "p", s, "t", "final", "m", "q", a, *[v] * 6, label) for s, v, label, a in rows], FEEDBACK)


def violation_rows(spark, *steps):
    return spark.createDataFrame([("2026-01-01", "r", "p", s, "record", "POLICY") for s in steps], "ingest_date string, run_id string, prompt_id string, evaluated_step_index int, violation_source string, violation string")


def test_rules_list_all_reasons_in_order(spark):
    schema = "run_id string, record_hash string, prompt_id string, query_text string, evaluated_step_index long, " + ", ".join(f"final_{m} double" for m in schemas.METRICS) + ", final_overall_label string"
    df = spark.createDataFrame([("", "", "", "", -1, 9.0, 3.0, 3.0, 3.0, 3.0, 3.0, "UNKNOWN"), ("r", "h", "p", "q", 0, *[None] * 6, None)], schema)
    bad, good = quality.apply_rules(df).collect()
    assert bad["dq_reasons"] == ["missing_run_id", "missing_record_hash", "missing_prompt_id", "missing_query_text", "invalid_evaluated_step_index", "invalid_final_overall_label", "out_of_range_primary_intent"]
    assert not bad["dq_pass"] and good["dq_pass"] and good["dq_reasons"] == []
    letters = quality.dead_letters(quality.apply_rules(df)).collect()
    assert {r["failure_reason"]: (r["rule_id"], r["severity"]) for r in letters}["missing_run_id"] == ("DQ_RUN_ID_REQUIRED", "CRITICAL")
    assert {r["evidence_ref"] for r in letters} == {"raw_path=unknown;record_hash="}
    off = [quality.Rule(r.reason, r.broken, r.rule_id, r.severity, enabled=False) for r in quality.FEEDBACK_RULES]
    assert quality.apply_rules(df, off).where("dq_pass").count() == 2


def test_unknown_reason_has_a_rule_and_severity(spark):
    row = spark.range(1).select(quality.rule_id_of(F.lit("other")).alias("r"), quality.severity_of(F.lit("other")).alias("s"), quality.rule_id_of(F.lit("out_of_range_reasoning")).alias("m")).first()
    assert list(row) == ["DQ_UNKNOWN", "MEDIUM", "DQ_METRIC_RANGE_0_5"]


def test_training_takes_the_latest_step(spark):
    rows = marts.training_examples(feedback(spark, (0, 4.0, "LLM_RATED_OK", "a1"), (1, 5.0, "LLM_RATED_GOOD", "a1b")), violation_rows(spark, 0)).collect()
    assert [(r["final_answer"], r["avg_quality_score"], r["violation_count"]) for r in rows] == [("a1b", 5.0, 1)]


def test_daily_comparison(spark):
    row = marts.model_comparison_daily(feedback(spark, (0, 4.0, "LLM_RATED_OK", "a"), (1, 2.0, "LLM_RATED_BAD", "b"))).first()
    assert (row["step_count"], row["bad_rate"], row["avg_primary_intent"]) == (2, 0.5, 3.0)


def test_breakdown_multiplies_only_where_asked(spark):
    twice = feedback(spark, (0, 1.0, "LLM_RATED_BAD", "a"), (0, 1.0, "LLM_RATED_OK", "b"))
    count = lambda one: {r["failure_type"]: r["failure_count"] for r in marts.failure_breakdown(twice, violation_rows(spark, 0), one).collect()}
    assert count(False) == {"overall_label": 1, "violation": 2} and count(True) == {"overall_label": 1, "violation": 1}


def test_agreement(spark):
    rows = [("2026-01-01", "r", "p", 0, "reasoning", t, v) for t, v in (("curator_1", 4.0), ("curator_2", 2.0), ("auto_rater", 5.0))]
    ratings = spark.createDataFrame(rows, "ingest_date string, run_id string, prompt_id string, evaluated_step_index int, metric_name string, rater_type string, metric_score double")
    row = marts.rater_agreement(ratings, feedback(spark, (0, 3.0, None, "a"))).first()
    assert (row["comparison_count"], row["avg_abs_diff"]) == (1, 2.0)


def test_agreement_of_known_metrics_is_the_same_and_shuffles_steps(spark):
    made = [("r", "p", 0, "reasoning", t, v) for t, v in (("curator_1", 4.0), ("curator_2", None), ("auto_rater", 5.0), ("auto_rater", 1.5), ("auto_rater", 1.0), ("auto_rater", None))]
    made += [("r", "p", 0, "information_gain", t, v) for t, v in (("curator_1", None), ("reviewer_curator_1", 1.0), ("auto_rater", 0.0))]
    # no score, no human, no automatic rating, keys and metrics that are null
    made += [("r", "p", 1, "reasoning", t, v) for t, v in (("curator_1", None), ("auto_rater", 2.0))] + [("r", "p", 1, "implementation", "auto_rater", 2.0), ("r", "p", 1, "understanding", "curator_2", 2.0)]
    made += [(k, "q", 2, m, t, 3.0) for k, m in ((None, "reasoning"), ("r", None)) for t in ("curator_1", "auto_rater")]
    schema = "ingest_date string, run_id string, prompt_id string, evaluated_step_index int, metric_name string, rater_type string, metric_score double"
    ratings = spark.createDataFrame([("2026-01-01", *r) for r in made], schema)
    steps = feedback(spark, (0, 3.0, None, "a"), (0, 3.0, None, "b"), (2, 3.0, None, "c"))
    for one in (False, True):
        plain, known = (marts.rater_agreement(ratings, steps, one=one, metrics=m) for m in (None, schemas.METRICS))
        assert sorted(map(str, known.collect())) == sorted(map(str, plain.collect()))
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*evaluated_step_index[^)]*metric_name", plan)
    other = spark.createDataFrame([("2026-01-01", "r", "p", 0, "tone", "curator_1", 1.0)], schema)
    with pytest.raises(Exception, match="unexpected metric: tone"):
        marts.rater_agreement(ratings.union(other), steps, metrics=schemas.METRICS).collect()


def test_agreement_query_and_marts_know_their_metrics(spark, sf_dir):
    plan = queries.QUERIES["rater_agreement"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*evaluated_step_index[^)]*metric_name", plan)


def test_step_metrics_and_star(spark):
    metrics = marts.step_metrics(feedback(spark, (0, 1.0, None, "a"), (1, 1.0, "LLM_RATED_BAD", "b")))
    assert sorted(r["is_bad"] for r in metrics.collect()) == [0, 1]
    tables = star.star(metrics, marts.failure_breakdown(feedback(spark, (0, 1.0, "LLM_RATED_BAD", "a")), violation_rows(spark)))
    assert {r["final_overall_label"] for r in tables["dim_label"].collect()} == {"unknown", "LLM_RATED_BAD"}
    assert tables["dim_date"].first().asDict() == {"date_key": dt.date(2026, 1, 1), "year": 2026, "month": 1, "day": 1, "day_of_week": 5}
    assert tables["fact_failure_breakdown"].first()["failure_count"] == 1


def test_first_seen_and_schema_diff(spark):
    rows = spark.createDataFrame([("known", "{}", "r1"), ("new", "{}", "r2"), ("new", "{}", "r1"), (None, "{}", "r1"), ("x", "", "r")], "schema_hash string, schema_json string, first_seen_run_id string")
    known = spark.createDataFrame([("known",)], "schema_hash string")
    assert [(r["schema_hash"], r["first_seen_run_id"]) for r in control.first_seen(rows, known).collect()] == [("new", "r1")]
    assert control.first_seen(rows, None).count() == 2
    t = "field string, type string"
    out = control.schema_diff(spark.createDataFrame([("a", "STRING"), ("b", "INT64")], t), spark.createDataFrame([("a", "STRING"), ("b", "FLOAT64"), ("c", "BOOL")], t))
    assert sorted(tuple(r) for r in out.collect()) == [("b", "type_change", "INT64", "FLOAT64", True), ("c", "added", None, "BOOL", False)]


def test_stage_plan(spark):
    runs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "run_id string")
    done = {"bronze": runs.where("run_id < 'd'"), "silver": runs.where("run_id < 'c'"), "gold": runs.where("run_id = 'a'")}
    plan = lambda f: {r["run_id"]: r["action"] for r in control.stage_plan(runs, done, f).collect()}
    assert plan(False) == {"a": "skip", "b": "gold", "c": "silver,gold", "d": "bronze,silver,gold"} and set(plan(True).values()) == {"bronze,silver,gold"}


def test_proposals_follow_the_states(spark):
    now = spark.createDataFrame([("a", "DRAFT"), ("b", "REVIEW")], "proposal_id string, status string")
    asked = spark.createDataFrame([("a", "REVIEW", "operator"), ("a", "APPROVED", "approver"), ("b", "APPROVED", "viewer"), ("b", "APPROVED", "admin"), ("z", "REVIEW", "operator"), ("a", "REVIEW", "viewer")], "proposal_id string, new_status string, actor_role string")
    out = {(r["proposal_id"], r["new_status"], r["actor_role"]): (r["outcome"], r["resulting_status"]) for r in control.judge_transitions(now, asked).collect()}
    assert out == {
        ("a", "REVIEW", "operator"): ("ok", "REVIEW"),
        ("a", "APPROVED", "approver"): ("invalid_status_transition", "DRAFT"),
        ("b", "APPROVED", "viewer"): ("role_not_allowed_for_approval", "REVIEW"),
        ("b", "APPROVED", "admin"): ("ok", "APPROVED"),
        ("z", "REVIEW", "operator"): ("proposal_not_found", None),
        ("a", "REVIEW", "viewer"): ("role_not_allowed_for_transition", "DRAFT"),
    }


def test_retention_and_limits(spark):
    now = F.lit("2026-01-02 00:00:00").cast("timestamp")
    df = spark.createDataFrame([(1, "a", dt.datetime(2026, 1, 1)), (2, "a", dt.datetime(2025, 1, 1)), (3, "b", None)], "id int, kind string, created_ts timestamp")
    assert [r["id"] for r in latest.retained(df, 86400, now=now).collect()] == [1]
    assert {tuple(r) for r in latest.purge_report(df, "kind", 86400, now=now).collect()} == {("a", 1, 1), ("b", 0, 1)}
    assert latest.newest_rows(df, 0).first()["id"] == 1 and latest.newest_rows(df, 9999).count() == 3


def test_guards():
    control.authorize("viewer", schemas.READER_ROLES)
    with pytest.raises(PermissionError):
        control.authorize("guest", schemas.READER_ROLES)
    with pytest.raises(ValueError, match="table_not_allowlisted"):
        control.allowlisted("x", schemas.OPS_TABLES)


def test_retrieval(spark):
    docs = spark.createDataFrame([("a", "ua", "pipeline status", [1.0, 0.0], 0), ("b", "ub", "schema lineage", [0.0, 1.0], 1)], "doc_id string, uri string, text string, embedding array<double>, position int")
    asked = spark.createDataFrame([(1, "pipeline", [0.99, 0.01])], "query_id int, query string, query_embedding array<double>")
    assert [r["doc_id"] for r in retrieval.hybrid_top_k(asked, docs, 1).collect()] == ["a"]
    assert [r["doc_id"] for r in retrieval.hybrid_top_k(asked, docs, 0).collect()] == ["a"]  # at least one
    both = [tuple(r) for r in retrieval.hybrid_top_k(asked, docs, 2).collect()]
    assert [r[1] for r in both] == ["a", "b"]  # b shares no token
    # on the other side of the bound, and in blocks
    assert [tuple(r) for r in retrieval.hybrid_top_k(asked.union(asked.selectExpr('7', 'query', 'query_embedding')), docs, 2, block=1).where('query_id = 1').collect()] == both
    report = retrieval.evaluation_report(retrieval.evaluate(spark)).first()
    assert report["gate_passed"] and report["recall_at_k"] == 1.0
    top = {r["case_id"]: r["uris"][0].rpartition(".")[2] for r in retrieval.evaluate(spark, 5, routed=False).collect()}
    assert top["ops_01"] == "pipeline_runs" and top["dq_03"] == "dq_results" and top["dq_01"] == "deadletter_summary"
    assert retrieval.evaluation_report(retrieval.evaluate(spark).limit(0)).first()["recall_at_k"] == 0.0


@pytest.mark.parametrize("block", [1000, 2])
def test_overlaps_cover_every_pair(spark, block):
    asked = [(i, t) for i, t in enumerate(["red green", "blue", "", "red red blue", "none"])]
    docs = [(i, t) for i, t in enumerate(["Red, blue", "green", "", "x " * 50 + "RED green blue"])]
    words = lambda t: set(re.findall(r"\w+", t.lower()))
    want = {(i, j): len(words(a) & words(b)) / max(1, len(words(a))) for i, a in asked for j, b in docs}
    out = retrieval.overlaps(spark.createDataFrame(asked, "query_id int, query string"), spark.createDataFrame(docs, "doc_id int, text string"), block=block).collect()
    assert len(out) == len(want) and {(r["query_id"], r["doc_id"]): r["overlap"] for r in out} == want


def test_overlap_query_leaves_no_page_out(spark, sf_dir):
    n = [spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("benchmark", "pages")]
    out = queries.QUERIES["lexical_overlap_all"](spark, sf_dir)
    assert out.count() == out.select("item_id", "page_id").distinct().count() == n[0] * n[1]


def test_cosine_blocks_change_nothing(spark):
    vectors = [(i, [float(i % 7), float(i % 5) - 2, 1.0]) for i in range(40)]
    items = spark.createDataFrame(vectors, "item_id int, embedding array<double>")
    asked = items.toDF("query_id", "query_embedding")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b)))  # noqa: E731, B905
    want = {(i, n + 1): j for i, a in vectors for n, (_, j) in enumerate(sorted((-cos(a, b), j) for j, b in vectors)[:3])}
    for block in (1000, 7):
        out = retrieval.cosine_top_k(asked, items, 3, block=block).collect()
        assert len(out) == 120 and {(r["query_id"], r["rank"]): r["item_id"] for r in out} == want


def test_cosine_query_asks_every_hundredth(spark, sf_dir):
    due = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 100 = 0").count()
    assert queries.QUERIES["cosine_topk"](spark, sf_dir).groupBy("query_id").count().where("count = 10").count() == due


def test_hybrid_scores_documents_that_share_no_token(spark):
    docs = spark.range(10_001).selectExpr("id doc_id", "concat('u', id) uri", "if(id = 1, 'pipeline', 'other') text", "if(id = 7000, array(1D, 0D), array(0D, 1D)) embedding", "int(id) position")
    asked = spark.createDataFrame([(1, "pipeline", [1.0, 0.0]), (2, "none", [1.0, 0.0])], "query_id int, query string, query_embedding array<double>")
    for block in (1000, 1):
        out = {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 9)) for r in retrieval.hybrid_top_k(asked, docs, 2, block=block).collect()}
        far = round(0.7 + 1 / 8000, 9)
        assert out == {(1, 1): (7000, far), (1, 2): (1, round(0.3 + 1 / 1001, 9)), (2, 1): (7000, far), (2, 2): (0, 0.001)}


def test_reshaping_keeps_label_only_rows(spark):
    df = spark.sql("select 1 id, cast(null as double) a, 2.0D b, 'L' lab, cast(null as string) none")
    out = reshape.wide_to_long(df, ["id"], {"x": {"a": F.col("a"), "b": F.col("b")}, "y": {"a": F.col("a"), "b": F.col("b")}}, "g", "m", "v", {"x": F.col("lab"), "y": F.col("none")}, "label")
    assert sorted((r["g"], r["m"], r["v"]) for r in out.collect()) == [("x", "a", None), ("x", "b", 2.0), ("y", "b", 2.0)]
    tagged = reshape.tagged_items(spark.sql("select 1 id, array('P', ' ') a, cast(null as array<string>) b, array('Q') c"), ["id"], {"a": F.col("a"), "b": F.col("b"), "c": F.col("c")}, "tag", "item")
    assert sorted((r["tag"], r["item"]) for r in tagged.collect()) == [("a", "P"), ("c", "Q")]


def test_errors_and_designs(spark):
    row = control.error_rows(spark.sql("select ' Connection lost ' message, 'oserror' code")).first()
    assert (row["error_category"], row["error_code"], row["error_summary"]) == ("NETWORK", "OSERROR", "Connection lost")
    p = spark.sql("select 'p1' proposal_id, 'S2G' layer, 'Add KPI' change_type, 'silver.x' source_table, 'gold.y' target_table, cast(null as string) run_id, 'dev' env")
    row = control.design_artifacts(p).first()
    assert row["generated_artifacts"][1] == "gs://agent-proposals/env=dev/layer=s2g/run_id=latest_failed_run/proposal_id=p1/test_plan_add_kpi_silver_x_to_gold_y.md" and row["confidence_score"] == 0.8


def test_plans_push_filters_and_prune_columns(spark, sf_dir):
    plan = latest.latest_per_key(spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_quantity > 40"), ["l_orderkey"], "l_linenumber").select("l_orderkey", "l_linenumber")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan and "WindowGroupLimit" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    long = reshape.wide_to_long(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey"], {"g": {"q": F.col("l_quantity"), "t": F.col("l_tax")}}, "g", "m", "v")._jdf.queryExecution().executedPlan().toString()
    assert long.count("FileScan") == 1


def test_rules_are_not_pushed_below_the_letters(spark, sf_dir):
    for name in ("dq_deadletter", "dq_summary", "dq_results"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert not any("missing_query_text" in line.partition("Filter")[2] for line in plan.splitlines() if line.lstrip(" +-:").startswith("Filter")), name


def test_rule_results_count_the_letters_once(spark):
    letters = spark.sql("select concat('r', id % 2) run_id, if(id % 3 = 0, null, concat('R', id % 5)) rule_id, 'HIGH' severity, if(id % 7 = 0, null, lpad(id % 50, 2, '0')) record_hash from range(300)")
    out = quality.rule_results(letters, samples=4)
    rows = [tuple(r) for r in letters.collect()]
    want = {}
    for *key, digest in rows:
        n, seen = want.get(tuple(key), (0, set()))
        want[tuple(key)] = (n + 1, seen | ({digest} - {None}))
    got = {(r["run_id"], r["rule_id"], r["severity"]): (r["failed_count"], r["sample_record_hashes"]) for r in out.collect()}
    assert got == {k: (n, sorted(seen)[:4]) for k, (n, seen) in want.items()}
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.partition("Initial Plan")[0] and "WindowGroupLimit" in plan


def test_matrices_are_one_pass_and_shuffle_the_best_alone(spark):
    items = spark.range(0, 5000, 1, 6).selectExpr("id item_id", "array(double(id % 91), double(id % 17) - 8, 1D) embedding")
    asked = items.where("item_id % 100 = 0").toDF("query_id", "query_embedding")
    want = [tuple(r) for r in retrieval.cosine_top_k(asked, items, 4).orderBy("query_id", "rank").collect()]
    for block in (1000, 7):
        out = retrieval.cosine_top_k(asked, items, 4, block=block)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Range (0, 5000") <= 2
        assert [tuple(r) for r in out.orderBy("query_id", "rank").collect()] == want
    docs = spark.range(0, 300, 1, 3).selectExpr("id doc_id", "'u' uri", "concat('w', id % 11, ' w', id % 7) text", "if(id % 3 = 0, array('a', 'b', 'a'), array('b', cast(null as string))) tags", "int(1000 - id) position")
    ask = spark.createDataFrame([(i, f"w{i} w{i + 1}", "ab"[i % 2]) for i in range(9)] + [(9, "w1", None), (10, "", "a")], "query_id int, query string, tag string")
    rows, words = docs.orderBy("position").collect(), lambda t: set(t.split())
    for block in (100, 2):
        got = {}
        for r in retrieval.hybrid_top_k(ask, docs, 5, F.col("tag"), block=block).orderBy("rank").collect():
            got.setdefault(r["query_id"], []).append((r["doc_id"], round(r["score"], 9)))
        for q in ask.collect():
            own = [r for r in rows if q["tag"] in [t for t in r["tags"] if t is not None]]
            scored = [(0.3 * len(words(q["query"]) & words(r["text"])) / max(1, len(words(q["query"]))) + 1 / (n + 1000), r) for n, r in enumerate(own)]
            best = sorted(scored, key=lambda x: (-x[0], x[1]["position"]))[:5]
            assert got.get(q["query_id"], []) == [(r["doc_id"], round(s, 9)) for s, r in best], q


def test_shared_overlaps_leave_out_zeros_alone(spark):
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(["red green", "blue", "", None, "red red blue", "none"])], "query_id int, query string")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["Red, blue", "green", "", None, "x " * 50 + "RED green blue"])], "doc_id int, text string")
    for block in (1000, 2):
        every, some = (sorted(map(tuple, retrieval.overlaps(asked, docs, block=block, shared=s).collect())) for s in (False, True))
        assert len(every) == 30 and [r for r in every if r[2]] == some and len(some) == 7


def test_dense_places_of_groups(spark):
    df = spark.range(0, 500, 1, 7).selectExpr("id", "if(id % 5 = 0, null, id % 3) g", "(id * 37) % 501 o").repartition(5, "g")
    out = places.dense_places(df, [F.col("o")], "g").collect()
    for g in (None, 0, 1, 2):
        own = sorted((r for r in out if r["g"] == g), key=lambda r: r["o"])
        assert [r["place"] for r in own] == list(range(len(own))) and own
    assert sorted(r["place"] for r in places.dense_places(df).collect()) == list(range(500))
    assert places.dense_places(df.limit(0), [F.col("o")]).collect() == []
