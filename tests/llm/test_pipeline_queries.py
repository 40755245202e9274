import glob
import os
from collections import Counter

import duckdb
import pytest

from tokenizers import Tokenizer

import corpus_pipeline
from llm_tools import words
from quillspark.llm import pii, queries, rules
from test_mixing_packing import shares
from test_ngram_join import brute


@pytest.fixture(scope="module")
def duck(sf_dir):
    out = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        out.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return out


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    ours = queries.QUERIES[name](spark, sf_dir)
    theirs = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in theirs.description]
    told = lambda rows: sorted(tuple(f"{v:.9f}" if isinstance(v, float) else str(v) for v in r) for r in rows)
    assert told(ours.select(*names).collect()) == told(theirs.fetchall()) and sorted(names) == sorted(ours.columns)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_query_covers_its_table(spark, sf_dir, name):
    rows = queries.QUERIES[name](spark, sf_dir).collect()
    table, key = ("embeddings", "vec_id") if "op7" in name else ("conversations", "conv_id") if "op11" in name else ("documents", "doc_id")
    every = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    assert sorted(r[key] for r in rows) == sorted(r[key] for r in (every.distinct() if "op11" in name else every).collect())


def test_pipeline_matches_a_plain_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    verdict = {r["doc_id"] for r in rules.judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect() if r["kept"]}
    rows = {r["doc_id"]: r for r in docs.collect()}
    stay = {i: rows[i]["text"] for i in verdict}
    stay = {i: t for i, t in stay.items() if brute(stay.items())[i][1] == i} if len(stay) < 20 else _stay(stay)
    clean = {i: pii.rewrite(t, queries.SURROGATE_KEY.encode(), {})[0] for i, t in stay.items()}
    sizes = Counter()
    for i, t in clean.items():
        sizes[rows[i]["source"]] += len(words(t))
    target = shares(dict(sizes))
    tokens = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for i, t in clean.items():
        s = rows[i]["source"]
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        want[i, len(tokens.encode(t, add_special_tokens=False).ids) + 1] += int(rate + 1e-12) + (_draw(i) < rate - int(rate + 1e-12))
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["length"]) for r in out) == +want
    batches = Counter(r["batch_id"] for r in out)
    assert all(batches[r["batch_id"]] == 1 or batches[r["batch_id"]] * r["bucket_length"] <= 65_536 for r in out)


def _stay(texts):
    classes = brute(texts.items())
    return {i: t for i, t in texts.items() if classes[i][1] == i}


def _draw(doc_id, seed=17):
    import hashlib

    return int(hashlib.md5(f"{seed}:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52


def test_stages_keep_the_columns_of_documents(spark, sf_dir, clashing, none):
    for docs in (clashing, none):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            if i < 4:
                assert out.columns == docs.columns
            out.collect()


def test_clean_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    out = {r["doc_id"]: r for r in rules.judged(docs, labels).collect()}
    own = [out[i] for i in good if i in out and not out[i]["base_failed"]]
    assert sum(r["kept"] for r in own) >= 0.97 * len(own)
