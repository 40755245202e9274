"""Column expressions on hand-made rows, malformed ones included."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark import schemas
from quillspark.functions import columns as C
from quillspark.functions import text as X
from quillspark.functions import vectors as V
from quillspark.operators import ingest


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict(recursive=True)


def test_normalize_payload(spark):
    df = spark.createDataFrame(
        [('{"final_answer": "x"}', '{"primary_intent": 3}', '["TOXICITY"]', "2"), ("", None, "", "-1"), ("{bad", '{"primary_intent": 1}', "POLICY", "1.0"), ("plain", "", "[1,2]", "")],
        "execution_json string, curator_1_rating string, violations string, step_index string",
    )
    rows = ingest.normalize_payload(df).collect()
    assert rows[0]["execution_json"]["final_answer"] == "x" and rows[0]["curator_1_rating"]["primary_intent"] == 3.0
    assert rows[0]["reviewer_curator_1_rating"]["primary_intent"] == 3.0  # reviewers follow curators
    assert [r["violations"] for r in rows] == [["TOXICITY"], [], ["POLICY"], ["1", "2"]]
    assert [r["step_index"] for r in rows] == [2, None, None, None]
    assert [r["parse_errors"] for r in rows] == [[], ["int_parse_error:step_index"], ["json_parse_error:execution_json", "int_parse_error:step_index"], []]
    assert rows[2]["rescued_data"] == '{"execution_json":"{bad","step_index":"1.0"}'


def test_payload_as_variants_keeps_all_fields(spark):
    df = spark.createDataFrame(
        [('{"final_answer": "x", "new": {"deep": [1, null]}}', '{"reasoning": 3, "why": "y"}', None, '["A"]'), ("{bad", "plain", "[broken", "POLICY"), ("", None, "", None)],
        "execution_json string, curator_1_rating string, reviewer_curator_1_rating string, violations string",
    )
    out = ingest.normalize_payload(df, "variant")
    text = lambda c: F.try_variant_get(c, "$", "string").alias(c)
    rows = out.select(*map(text, ("execution_json", "curator_1_rating", "reviewer_curator_1_rating", "violations")), "parse_errors").collect()
    assert list(rows[0])[:4] == ['{"final_answer":"x","new":{"deep":[1,null]}}', '{"reasoning":3,"why":"y"}', '{"reasoning":3,"why":"y"}', '["A"]']
    # a reviewer's broken text stays the reviewer's and is not replaced by the curator's
    assert list(rows[1]) == ["{bad", "plain", "[broken", '["POLICY"]', ["json_parse_error:execution_json", "json_parse_error:reviewer_curator_1_rating"]]
    assert list(rows[2])[:4] == [None, None, None, "[]"]
    drift = [tuple(r) for r in ingest.payload_drift(out).collect()]
    assert [d[:2] for d in drift] == [("curator_1_rating", "why"), ("execution_json", "new"), ("reviewer_curator_1_rating", "why")]
    typed = ingest.normalize_payload(df).select("curator_1_rating", "reviewer_curator_1_rating").collect()
    assert typed[1] == (None, None) and typed[0]["reviewer_curator_1_rating"]["reasoning"] == 3.0
    assert ingest.payload_drift(out.limit(0)).isEmpty()


def test_each_cell_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "execution_json string")
    plan = ingest.normalize_payload(df).select("execution_json", "parse_errors", "rescued_data")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?i)parse_?json\W", plan)) == 1


def test_arrays_keep_the_text_that_is_no_list(spark):
    df = spark.createDataFrame([("POLICY",), ('"A"',), ('{"a":1}',), ("[null]",), (None,), ("  ",)], "v string")
    assert [r[0] for r in df.select(C.as_strings(df, "v")).collect()] == [["POLICY"], ['"A"'], ['{"a":1}'], [None], [], []]
    nested = spark.createDataFrame([([1, None],), (None,)], "v array<int>")
    assert [r[0] for r in nested.select(C.as_strings(nested, "v")).collect()] == [["1", None], None]
    assert nested.select(C.as_strings(nested, "absent")).first()[0] == []


def test_structs_survive_bad_json(spark):
    df = spark.createDataFrame([("{bad",), ("",), ('{"primary_intent": "x", "reasoning": 2}',), (None,)], "r string")
    out = [r[0] for r in df.select(C.as_struct(df, "r", schemas.NESTED["curator_1_rating"])).collect()]
    assert out[1] is None and out[3] is None and out[2]["primary_intent"] is None and out[2]["reasoning"] == 2.0
    assert df.select(C.as_struct(df, "gone", schemas.NESTED["auto_rater"])).first()[0] is None


def test_two_source_mean_and_penalised_mean(spark):
    f = lambda x: F.lit(x).cast("double")
    got = one(spark, both=C.two_source_mean([f(5), f(2)], [f(None), f(4)]), left=C.two_source_mean([f(None), f(2)], [f(None)]), none=C.two_source_mean([f(None)], [f(None)]), pen=C.penalised_mean([f(3), f(None), f(1)]))
    assert got == {"both": 4.5, "left": 2.0, "none": None, "pen": 1.3333}


def test_hashes(spark):
    import hashlib

    df = spark.createDataFrame([("b", 1)], "x string, a int")
    row = df.select(C.record_hash(df, ["x", "a"]), C.schema_hash(["x", "a"]), C.dimension_key(F.lit(None))).first()
    assert [hashlib.sha256(s.encode()).hexdigest() for s in ('{"a":1,"x":"b"}', '["a","x"]', "unknown")] == list(row)


def test_redaction_and_routes(spark):
    got = one(
        spark,
        r=X.redact(F.lit("contact alice@example.com with Bearer abc.def and sk-1234567890ABCDEFGHIJKL")),
        a=X.route(F.lit("list Quality problems")),
        b=X.route(F.lit("quality"), F.lit("ops")),
        c=X.route(F.lit("latest run"), F.lit("nonsense")),
        d=X.sanitize(F.lit("Gold.Table-é ")),
        e=X.sanitize(F.lit("--")),
        f=X.normal_category(F.lit(" auth ")),
        g=X.normal_category(F.lit("odd")),
        h=X.error_category(F.lit("Access Denied for column")),
        i=X.error_category(F.lit(None).cast("string")),
        t=X.tokens(F.lit("code_version, Code!")),
        l=X.lexical_overlap(F.lit(""), F.lit("x")),
    )
    assert got == {
        "r": "contact [REDACTED_EMAIL] with Bearer [REDACTED_TOKEN] and [REDACTED_API_KEY]", "a": "dq", "b": "ops", "c": "ops", "d": "gold_table_é", "e": "na", "f": "AUTH", "g": "RUNTIME", "h": "IAM_PERMISSION", "i": "RUNTIME", "t": ["code", "version"], "l": 0.0
    }


def test_cosine_of_odd_vectors_is_zero(spark):
    a = lambda *x: F.array(*map(F.lit, x)).cast("array<double>")
    got = one(spark, same=V.cosine(a(1, 0), a(2, 0)), zero=V.cosine(a(0, 0), a(1, 0)), size=V.cosine(a(1), a(1, 0)), null=V.cosine(F.lit(None).cast("array<double>"), a(1)))
    assert got == {"same": 1.0, "zero": 0.0, "size": 0.0, "null": 0.0}


def test_legacy_names_give_way_when_empty(spark):
    df = spark.createDataFrame([("", "i1", "c", "t"), ("f2", "i2", None, "t2")], "feedback_id string, id string, comment string, text string")
    rows = ingest.normalize_legacy(df).collect()
    assert [(r["feedback_id"], r["comment"], r["model"]) for r in rows] == [("i1", "c", None), ("f2", "t2", None)]


def test_paths(spark):
    got = one(spark, a=C.path_part(F.lit("x/run_id=r1/y"), "run_id=([^/]+)"), b=C.path_part(F.lit("x"), "run_id=([^/]+)"), c=C.date_of_path(F.lit("dt=2026-02-30/")))
    assert got == {"a": "r1", "b": None, "c": None}


def test_canonical_json_is_that_of_python(spark):
    import hashlib
    import json

    rows = [
        {"b": "ü\x00\x1f\x7f\"\\/\n\u2028", "a": None, "n": {"z": [1, None, -(2**60)], "k": {"y": None, "x": True}}, "m": {"é": "1", "B": None, "a": "\\u001F"}},
        {"b": "", "a": 7, "n": None, "m": {}},
        {"b": None, "a": 0, "n": {"z": [], "k": None}, "m": None},
    ]
    ddl = "b string, a int, n struct<z: array<bigint>, k: struct<y: string, x: boolean>>, m map<string, string>"
    floats = [1.0, 0.1, 1e16, 1e15, 123456789.125, 1e-4, 1e-5, 5e-324, -0.0, 1.7976931348623157e308, 2.0**-44, 9007199254740993.0, 1e22, 1e23, None]
    for data, kind in ((rows, ddl), ([{"x": v, "s": {"f": [v, None], "t": "é"}} for v in floats], "x double, s struct<f: array<double>, t: string>")):
        df = spark.createDataFrame([tuple(r.values()) for r in data], kind)
        want = [hashlib.sha256(json.dumps(r, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest() for r in data]
        assert [r[0] for r in df.select(C.record_hash(df, df.columns)).collect()] == want
    plan = df.select("s.t").select(C.canonical_json(F.col("t"), schemas.parse("string")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_canonical_json_of_texts_alone(spark):
    import hashlib
    import json

    texts = ["", None, 'a "b" \\', "\\u001F", "\x00\x0b\x1f", "\x7f\u2028 ü 😀 </", "\n\r\t\f\b", "\ufffd", '{"x":"\\"y\\"","z":1.0}']
    rows = [{"b": t, "Ä \x01\"": u, "a": None} for t in texts for u in ("plain", t)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], T.StructType([T.StructField(n, T.StringType()) for n in rows[0]]))
    want = [json.dumps(r, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in rows]
    kind = df.schema
    assert [r[0] for r in df.select(C.canonical_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), kind)).collect()] == want
    assert [r[0] for r in df.select(C.record_hash(df, df.columns)).collect()] == [hashlib.sha256(w.encode()).hexdigest() for w in want]
    # bytes that are no UTF-8 stay as they are, and a struct that is null is null
    odd = spark.range(1).selectExpr("named_struct('t', cast(x'41ff42' as string)) AS s").select(F.hex(C.canonical_json(F.col("s"), schemas.parse("struct<t: string>"))))
    assert odd.first()[0] == (b'{"t":"A\xffB"}').hex().upper()
    none = spark.createDataFrame([(None,)], "s struct<t: string>").select(C.canonical_json(F.col("s"), schemas.parse("struct<t: string>")))
    assert none.first()[0] == "null"
