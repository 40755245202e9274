"""The layered pipeline end to end, on generated batches."""

import json

import pytest
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.operators import ingest, metadata, places, quality
from quillspark.plans import pipeline
from quillspark.sources import readers, sample, writers

DAY = "2026-01-15"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = pipeline.Lake(str(tmp_path_factory.mktemp("lake")))
    pipeline.land_raw(spark, lake, sample.feedback_rows(spark, "auto"), "run-auto", DAY)
    pipeline.land_raw(spark, lake, sample.feedback_rows(spark, "human", 10), "run-human", DAY)
    pipeline.land_raw(spark, lake, sample.feedback_rows(spark, "both", 12), "run-both", DAY)
    lake_counts = {"bronze": pipeline.run_bronze(spark, lake), "silver": pipeline.run_silver(spark, lake), "gold": pipeline.run_gold(spark, lake)}
    pipeline.run_star(spark, lake)
    return lake, lake_counts


def test_counts_follow_the_shape_of_the_data(spark, lake):
    lake, counts = lake
    steps = {k: sample.feedback_rows(spark, k, n).count() for k, n in (("auto", 30), ("human", 10), ("both", 12))}
    assert counts["bronze"] == sum(steps.values())
    assert counts["silver"]["feedback_step"] == sum(steps.values()) and counts["silver"]["deadletter"] == 0
    # six metrics from one rater, four raters, five raters
    assert counts["silver"]["ratings_long"] == 6 * (steps["auto"] + 4 * steps["human"] + 5 * steps["both"])
    assert counts["gold"]["training_supervised_examples"] == 52
    assert counts["gold"]["model_eval_step_metrics"] == sum(steps.values())
    agreement = spark.read.parquet(f"{lake.gold}/rater_agreement")
    assert {r["run_id"] for r in agreement.select("run_id").distinct().collect()} == {"run-both"}
    assert agreement.agg(F.sum("comparison_count")).first()[0] == 6 * steps["both"]


def test_stages_repeat_without_change(spark, lake):
    lake, counts = lake
    before = {t: spark.read.parquet(f"{lake.silver}/{t}").count() for t in ("feedback_step", "ratings_long")}
    assert pipeline.run_bronze(spark, lake) == 0  # manifests say done
    # a crash before the manifest leaves data behind; the repeat replaces it
    assert pipeline.run_bronze(spark, lake, force=True) == counts["bronze"]
    pipeline.run_silver(spark, lake)
    assert before == {t: spark.read.parquet(f"{lake.silver}/{t}").count() for t in before}


def test_one_run_at_a_time_gives_the_same_marts(spark, lake):
    lake, _ = lake
    whole = {r["model_version"]: r["step_count"] for r in spark.read.parquet(f"{lake.gold}/model_comparison_daily").collect()}
    pipeline.run_gold(spark, lake, ["run-human"])
    assert whole == {r["model_version"]: r["step_count"] for r in spark.read.parquet(f"{lake.gold}/model_comparison_daily").collect()}


def test_star_keys_meet(spark, lake):
    lake, _ = lake
    fact = spark.read.parquet(f"{lake.star}/fact_model_eval_step")
    for dim, key in (("dim_model", "model_key"), ("dim_task", "task_key"), ("dim_step_type", "step_type_key"), ("dim_label", "label_key"), ("dim_date", "date_key")):
        assert fact.join(spark.read.parquet(f"{lake.star}/{dim}"), key, "left_anti").isEmpty()
    assert spark.read.parquet(f"{lake.star}/dim_date").first().asDict()["day_of_week"] == 5  # a Thursday


def test_manifests_reconcile_and_tell_the_plan(spark, lake):
    lake, counts = lake
    per = {r: json.loads(writers.get_text(spark, writers.manifest_path(lake.manifests, "silver", DAY, r)))["counts"] for r in ("run-auto", "run-both", "run-human")}
    assert {t: sum(c[t] for c in per.values()) for t in per["run-auto"]} == counts["silver"]
    for r in per:
        for stage, tables in (("bronze", ["feedback"]), ("silver", list(counts["silver"])), ("gold", list(counts["gold"]))):
            assert all(x["expected"] == x["actual"] for x in pipeline.reconcile(spark, lake, stage, DAY, r, tables).collect()), (r, stage)
    assert readers.list_runs(spark, lake.raw, DAY) == ["run-auto", "run-both", "run-human"]
    out = pipeline.reconcile(spark, lake, "silver", DAY, "run-auto", ["feedback_step", "deadletter"]).collect()
    assert [r["actual"] for r in out] == [sample.feedback_rows(spark, "auto").count(), 0]


def test_bad_records_are_dead_letters(spark, tmp_path):
    lake = pipeline.Lake(str(tmp_path))
    rows = sample.feedback_rows(spark, "human", 2)
    bad = rows.withColumn("query_text", F.lit("  ")).withColumn("evaluated_step_index", F.lit(None).cast("int")).limit(3)
    pipeline.land_raw(spark, lake, rows.unionByName(bad), "r", DAY)
    pipeline.run_bronze(spark, lake)
    counts = pipeline.run_silver(spark, lake)
    assert counts["deadletter"] == 6 and counts["feedback_step"] == rows.count()
    summary = {(r["rule_id"], r["count"]) for r in spark.read.parquet(f"{lake.ops}/deadletter_summary").collect()}
    assert summary == {("DQ_QUERY_TEXT_REQUIRED", 3), ("DQ_EVALUATED_STEP_INDEX_VALID", 3)}
    results = spark.read.parquet(f"{lake.ops}/dq_results").collect()
    assert all(r["failed_count"] == 3 and r["dq_pass"] is False and r["sample_record_hashes"] for r in results)


def test_rows_without_a_run_and_late_days_are_kept(spark, tmp_path):
    lake = pipeline.Lake(str(tmp_path))
    rows = sample.feedback_rows(spark, "human", 2)
    pipeline.land_raw(spark, lake, rows, "r", DAY)
    stray = {"meta": {"source_type": "json", "ingest_ts": f"{DAY}T00:00:00Z"}, "payload": {"prompt_id": "p", "query_text": "q", "evaluated_step_index": "1"}}
    (tmp_path / f"raw/other/dt={DAY}").mkdir(parents=True)
    (tmp_path / f"raw/other/dt={DAY}/stray.json").write_text(json.dumps(stray))
    assert pipeline.run_bronze(spark, lake) == rows.count() + 1
    late = sample.feedback_rows(spark, "human", 3, seed=7)
    pipeline.land_raw(spark, lake, late, "r", "2026-01-16")
    # the run's first day is done, its second is not, and a row without a run is never done
    assert pipeline.run_bronze(spark, lake) == late.count() + 1
    assert spark.read.parquet(f"{lake.bronze}/feedback").count() == rows.count() + late.count() + 1
    for _ in range(2):
        counts = pipeline.run_silver(spark, lake)
        summary = {(r["run_id"], r["rule_id"], r["count"]) for r in spark.read.parquet(f"{lake.ops}/deadletter_summary").collect()}
        assert counts["deadletter"] == 1 and summary == {(None, "DQ_RUN_ID_REQUIRED", 1)}
        assert spark.read.parquet(f"{lake.ops}/dq_results").count() == 1
    assert pipeline.run_bronze(spark, lake, ["2026-02-01"]) == 0


def test_places_are_dense_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select(F.col("id").cast("string").alias("prompt_id")).where("id % 3 = 0")
    out = ingest.raw_envelope(df, {"run_id": "r"}).select("meta.row_number", "payload.prompt_id").collect()
    assert sorted((r[0], int(r[1])) for r in out) == [(i + 1, 3 * i) for i in range(334)]


def test_a_source_of_one_split_is_landed_by_several_tasks_in_its_order(spark, tmp_path):
    own = pipeline.Lake(str(tmp_path / "spread"))
    rows = spark.range(0, 60_000, 1, 1).select(F.col("id").cast("string").alias("prompt_id"), F.sha2(F.col("id").cast("string"), 512).alias("query_text"))
    path = pipeline.land_raw(spark, own, rows, "r1", DAY)
    raw = readers.read_raw(spark, own.raw).select(F.col("meta.row_number").alias("n"), F.col("payload.prompt_id").cast("long").alias("id"), "raw_path")
    facts = raw.agg(F.count(F.lit(1)), F.count_if(F.col("n") != F.col("id") + 1), F.count_distinct("raw_path")).first()
    assert facts[0] == 60_000 and facts[1] == 0 and facts[2] > 1, (path, facts)
    several = spark.range(0, 1000, 1, 7).select("id").where("id % 3 = 0")
    out = places.dense_places_of(places.dealt(several, "at"), "at").collect()
    assert sorted((r["place"], r["id"]) for r in out) == [(i, 3 * i) for i in range(334)]
    assert places.dense_places_of(places.dealt(several.limit(0), "at"), "at").collect() == []


def test_rows_of_few_bytes_are_dealt_over_several_tasks(spark):
    for n in (400, 20_000):
        at = places.dealt(spark.range(0, n, 1, 1), "at").select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
        assert len(at) == 4 and max(r["count"] for r in at) < n / 2


def test_only_objects_give_nested_types(spark):
    texts = [None, '{"a": 1}', '{"b": "x", "c": {"d": [1]}}', "{}", "{no json", '"{}"', "[1]", "7", "true", "null", "[{}]"]
    df = ingest.normalize_payload(spark.createDataFrame([(t,) for t in texts], "auto_rater string"), "variant")
    seen = df.agg(*ingest.nested_types(df).values()).first()
    assert seen["auto_rater"] == "OBJECT<a: BIGINT, b: STRING, c: OBJECT<d: ARRAY<BIGINT>>>"
    empty = df.where(~F.coalesce(F.schema_of_variant("auto_rater").startswith("OBJECT"), F.lit(False)))
    assert not (empty.agg(*ingest.nested_types(empty).values()).first()["auto_rater"] or "").startswith("OBJECT")



def test_rest_to_raw_in_one_go(spark, tmp_path):
    lake = pipeline.Lake(str(tmp_path))
    fetch = lambda url: [{"id": f"{url}{i}", "text": "fine", "rating": 4} for i in range(3)]
    pipeline.ingest_rest(spark, lake, ["a", "b"], "id string, text string, rating int", "r", DAY, fetch, legacy=True)
    rows = readers.read_raw(spark, lake.raw).select("meta.source_type", "payload.prompt_id", "payload.query_text", "meta.row_number").collect()
    assert sorted(map(tuple, rows))[0][:3] == ("rest", "a0", "fine") and sorted(r[3] for r in rows) == list(range(1, 7))


def test_schema_registry_takes_each_schema_once(spark, lake):
    lake, _ = lake
    df = spark.range(1)
    assert pipeline.register_schemas(spark, lake, "r1", df, "json") == 1
    assert pipeline.register_schemas(spark, lake, "r2", df, "json") == 0


def test_csv_and_json_sources_agree(spark, tmp_path):
    rows = sample.feedback_rows(spark, "both", 3)
    data = [r.asDict(recursive=True) for r in rows.collect()]
    (tmp_path / "rows.json").write_text(json.dumps(data))
    import csv

    with (tmp_path / "rows.csv").open("w", encoding="utf-8-sig", newline="") as f:
        out = csv.DictWriter(f, list(data[0]))
        out.writeheader()
        out.writerows({k: json.dumps(v) if isinstance(v, (dict, list)) else v for k, v in r.items()} for r in data)
    frames = [ingest.normalize_payload(readers.read_source(spark, k, str(tmp_path / f"rows.{k}"))) for k in ("json", "csv")]
    keys = ["prompt_id", "step_index", "execution_json", "auto_rater", "violations", "curator_1_rating"]
    left, right = (sorted(map(str, f.select(*keys).collect())) for f in frames)
    assert left == right and frames[1].where("size(parse_errors) > 0").isEmpty()
    (tmp_path / "object.json").write_text('{"a": 1}')
    with pytest.raises(ValueError, match="list"):
        readers.read_json_array(spark, str(tmp_path / "object.json"))
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_source(spark, "xml", "x")


def test_nested_and_text_batches_are_the_same_records(spark):
    batches = sample.source_batches(spark, 7)
    keys = ["prompt_id", "set_id", "step_index", "execution_json", "auto_rater", "violations", "curator_1_rating", "reviewer_curator_2_rating"]
    left, right = (sorted(map(str, ingest.normalize_payload(b).select(*keys).collect())) for b in batches.values())
    assert left == right and len(left) == 7
    assert dict(batches["csv"].dtypes)["execution_json"] == "string" and sample.source_batches(spark, 0)["json"].isEmpty()


def test_new_fields_are_registered_and_kept(spark, tmp_path):
    own = pipeline.Lake(str(tmp_path / "drift"))
    rows = spark.createDataFrame([("p", '{"final_answer":"x","novel":1}')], "prompt_id string, execution_json string")
    path = pipeline.land_raw(spark, own, rows, "r1", "2026-01-01")
    assert '\\"novel\\":1' in spark.read.text(path).first()[0]
    manifest = json.loads(writers.get_text(spark, writers.manifest_path(own.manifests, "raw", "2026-01-01", "r1")))
    assert manifest["undeclared_fields"] == [["execution_json", "novel", "bigint"]]
    schema = spark.read.parquet(f"{own.ops}/schema_registry").first()["schema_json"]
    assert "novel: BIGINT" in json.loads(schema)["nested"]["execution_json"]


def test_rest_rows_come_from_all_sources(spark):
    fetch = lambda url: [{"id": f"{url}-{i}"} for i in range(2)]
    assert sorted(r[0] for r in readers.read_rest(spark, ["a", "b"], "id string", fetch).collect()) == ["a-0", "a-1", "b-0", "b-1"]
    assert readers.read_rest(spark, [], "id string").count() == 0


def test_publish_takes_nonempty_tables(spark, tmp_path):
    tables = {"a": spark.range(2), "b": spark.range(0)}
    assert writers.publish(tables, "parquet", {"path": str(tmp_path / "{table}")}) == ["a"]
    assert spark.read.parquet(str(tmp_path / "gold_a")).count() == 2
    with pytest.raises(ValueError):
        writers.publish(tables, "parquet", {})


def test_contract_problems_are_named(spark, lake):
    lake, _ = lake
    assert quality.check_contract(spark.read.parquet(f"{lake.silver}/feedback_step"), schemas.CONTRACTS["feedback_step"]).isEmpty()
    df = spark.createDataFrame([("r", None), ("r", None)], "run_id string, record_hash string")
    found = {(r["problem"], r["field"]) for r in quality.check_contract(df, schemas.CONTRACTS["feedback_step"]).collect()}
    assert {("null_required", "record_hash"), ("missing_required", "prompt_id"), ("missing_lineage", "raw_path"), ("repeated_key", "run_id,record_hash")} <= found


def test_every_control_table_can_be_written(spark, tmp_path):
    for name, (ddl, _) in schemas.OPS_TABLES.items():
        assert writers.append_ops(spark, str(tmp_path), name, []) == 0
        assert writers.append_ops(spark, str(tmp_path), name, [{"run_id": "r", "session_id": "s"}]) == 1
        assert spark.read.parquet(f"{tmp_path}/{name}").columns[:-1] == schemas.parse(ddl).names


def test_metadata_guards(spark):
    df = spark.createDataFrame([("a", "2026-01-01"), ("b", "2026-01-01")], "run_id string, ingest_date string")
    assert metadata.single_value(df, "ingest_date") == "2026-01-01" and metadata.single_value(df, "run_id", "x") == "x"
    with pytest.raises(ValueError, match="several"):
        metadata.single_value(df, "run_id")
    with pytest.raises(ValueError, match="none"):
        metadata.single_value(df.where("false"), "run_id")
    with pytest.raises(ValueError, match="missing required columns: raw_path, record_hash"):
        metadata.require(df, ["raw_path", "record_hash", "run_id"])
    with pytest.raises(ValueError):
        metadata.nonempty(df.where("false"), "x")
    paths = df.withColumn("raw_path", F.lit("raw/x/dt=2026-01-02/run_id=r9/batch_id=b1/part"))
    row = metadata.normalize_raw(paths.drop("run_id", "ingest_date")).first()
    assert row["run_id"] == "r9" and row["source_type"] == "unknown" and len(row["record_hash"]) == 64
    assert metadata.with_ingest_date(paths.drop("ingest_date"), "2026-01-02").count() == 2
    assert metadata.in_batch(paths, "b1").count() == 2 and metadata.in_batch(paths, "b").count() == 0


def _ran(spark, lake, **by):
    rows = spark.read.parquet(f"{lake.ops}/pipeline_runs").orderBy("start_ts").collect()
    return [r for r in rows if all(r[k] == v for k, v in by.items())]


def test_every_execution_is_a_row(spark, lake):
    lake, counts = lake
    for stage, table in (("bronze", "feedback"), ("silver", "feedback_step"), ("gold", "training_supervised_examples")):
        first = {}
        for r in reversed(_ran(spark, lake, stage=stage, status="SUCCEEDED")):
            first[r["run_id"]] = r
        expected = {"run-auto", "run-human", "run-both"}
        assert expected <= first.keys() and all(first[r]["duration_ms"] >= 0 and first[r]["start_ts"] <= first[r]["end_ts"] and first[r]["schema_hash"] for r in expected)
        total = counts[stage] if stage == "bronze" else counts[stage][table]
        assert sum(first[r]["output_count"] for r in expected) == total
        for r in expected:
            manifest = json.loads(writers.get_text(spark, first[r]["manifest_path"]))
            assert manifest["counts"][table] == first[r]["output_count"] == manifest["output_count"] and first[r]["partition_keys"] == [f"ingest_date={DAY}", f"run_id={r}"]
    assert {r["run_id"] for r in _ran(spark, lake, stage="raw")} == expected
    assert spark.read.parquet(f"{lake.ops}/schema_registry").where("source_type in ('bronze', 'silver', 'gold')").count() == 3


def test_a_failed_stage_leaves_its_row(spark, tmp_path):
    lake = pipeline.Lake(str(tmp_path))
    pipeline.land_raw(spark, lake, sample.feedback_rows(spark, "human", 2), "r", DAY)
    assert pipeline.run_planned(spark, lake, [DAY], code_version="v1") == {("r", DAY): "bronze,silver,gold"}
    assert pipeline.run_planned(spark, lake, [DAY]) == {("r", DAY): "skip"}
    assert pipeline.plan(spark, lake, [DAY], force=True).first()["action"] == "bronze,silver,gold"
    with pytest.raises(ValueError, match="no rows"):
        pipeline.run_silver(spark, lake, ["absent"])
    (row,) = _ran(spark, lake, status="FAILED")
    assert (row["run_id"], row["stage"], row["error_code"], row["error_category"], row["output_count"]) == ("absent", "silver", "VALUEERROR", "RUNTIME", None) and "no rows" in row["error_summary"]
    missing = pipeline.Lake(str(tmp_path / "none"))
    with pytest.raises(Exception, match="(?i)path"):
        pipeline.run_gold(spark, missing)
    (row,) = _ran(spark, missing)
    assert (row["run_id"], row["stage"], row["status"]) == (None, "gold", "FAILED") and row["error_code"]
    # a stage that breaks between its tables leaves rows of the runs that it worked on
    broken = pytest.MonkeyPatch()
    broken.setattr(quality, "rule_results", lambda letters: 1 / 0)
    with broken.context(), pytest.raises(ZeroDivisionError):
        pipeline.run_silver(spark, lake)
    broken.undo()
    assert [r["run_id"] for r in _ran(spark, lake, status="FAILED", error_code="ZERODIVISIONERROR")] == ["r"]
    assert {(r["stage"], r["code_version"]) for r in _ran(spark, lake, status="SUCCEEDED")} == {("raw", None), *((s, "v1") for s in ("bronze", "silver", "gold"))}


def test_writers_count_what_they_write(spark, tmp_path):
    df = spark.range(0, 1000, 1, 5).selectExpr("id", "if(id % 7 = 0, null, concat('r\"', id % 3)) run_id", "date'2026-01-01' + cast(id % 2 as int) ingest_date")
    want = {}
    for r in df.collect():
        key = r["run_id"], str(r["ingest_date"])
        want[key] = want.get(key, 0) + 1
    assert writers.write_layer(df, str(tmp_path), "t") == want
    assert writers.write_layer(df.where("id < 0"), str(tmp_path), "none") == {}
    assert writers.write_layer(df.drop("run_id"), str(tmp_path), "days") == {("2026-01-01",): 500, ("2026-01-02",): 500}
    assert writers.write_jsonl(df, str(tmp_path / "j")) == 1000 and writers.write_jsonl(df.limit(0), str(tmp_path / "k")) == 0
    assert writers.append_ops(spark, str(tmp_path), "deadletter_summary", df.selectExpr("run_id", "'s' stage")) == 1000
    few = writers.Counts(df, ["id"], most=64)
    few.df.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="more values of id"):
        few.get()


@pytest.fixture
def server():
    """A local HTTP server: /list, /object, /missing, /slow."""
    import http.server
    import threading
    import time

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/slow":
                time.sleep(3)
            status = 404 if self.path == "/missing" else 200
            body = json.dumps({"a": 1} if self.path == "/object" else [{"id": self.path, "n": i, "more": {"x": None}} for i in range(3)]).encode()
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    own = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=own.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{own.server_port}"
    own.shutdown()


def test_rest_source_asks_a_server(spark, server):
    rows = readers.read_rest(spark, [f"{server}/list", f"{server}/other"], "id string, n int, more struct<x: string>")
    assert rows.rdd.getNumPartitions() == 2 and rows.schema.names == ["id", "n", "more"]
    assert sorted((r["id"], r["n"]) for r in rows.collect()) == [(p, i) for p in ("/list", "/other") for i in range(3)]
    for path, told in (("missing", "404"), ("object", "JSON list"), ("slow", "timed out")):
        with pytest.raises(Exception, match=told):
            readers.read_rest(spark, [f"{server}/{path}"], "id string", timeout=0.5).collect()


def test_purge_of_stored_tables(spark, tmp_path):
    import datetime as dt

    day = dt.datetime(2026, 1, 10, 12)
    rows = [{"session_id": f"s{i}", "created_ts": day - dt.timedelta(hours=6 * i)} for i in range(40)]
    assert writers.append_ops(spark, str(tmp_path), "agent_sessions", rows) == 40
    cutoff = day - dt.timedelta(days=3)
    read = lambda: {r[0] for r in spark.read.parquet(f"{tmp_path}/agent_sessions").select("session_id").collect()}
    files = {p for p in tmp_path.rglob("*.parquet") if "2026-01-09" in str(p)}
    assert writers.purge_ops(spark, str(tmp_path), "agent_sessions", cutoff) == (40, 13) and read() == {f"s{i}" for i in range(13)}
    assert files == {p for p in tmp_path.rglob("*.parquet") if "2026-01-09" in str(p)} and files  # newer days are not touched
    assert writers.purge_ops(spark, str(tmp_path), "agent_sessions", cutoff) == (13, 13)
    assert writers.purge_audit(spark, str(tmp_path), 0, day) == {"agent_sessions": 12, "agent_tool_calls": 0, "agent_responses": 0, "agent_proposals": 0}
    # a crash before old days go: they are still there, and the next run takes them
    crash = pytest.MonkeyPatch()
    writers.append_ops(spark, str(tmp_path), "agent_responses", [{"event_id": str(i), "created_ts": day - dt.timedelta(hours=6 * i)} for i in range(40)])
    with crash.context() as c, pytest.raises(RuntimeError):
        c.setattr(type(spark.catalog), "refreshByPath", lambda *_: (_ for _ in ()).throw(RuntimeError("gone")))
        writers.purge_ops(spark, str(tmp_path), "agent_responses", cutoff)
    assert writers.purge_ops(spark, str(tmp_path), "agent_responses", cutoff) == (13, 13)


def test_json_lists_are_told_by_their_first_sign(spark, tmp_path):
    (tmp_path / "a.json").write_text("﻿\n\n  [\n {\"x\": 1},\n {\"x\": 2}]\n")
    assert sorted(r["x"] for r in readers.read_json_array(spark, str(tmp_path / "a.json"), "x int").collect()) == [1, 2]
    for text in ("", "  \n", '{"x": [1]}', "x [1]"):
        (tmp_path / "b.json").write_text(text)
        with pytest.raises(ValueError, match="list"):
            readers.read_json_array(spark, str(tmp_path / "b.json"), "x int")
