"""Every core query against its SQL on the smallest tables, and the driver's contract."""

import datetime as dt
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quillspark.plans import queries
from quillspark.sources import sample


def told(rows, names):
    order = sorted(names)
    one = lambda v: "-" if v is None or v != v else f"{v:.9f}" if isinstance(v, float) else str(v)[:19] if isinstance(v, dt.datetime) else str(v)
    return sorted(tuple(one(dict(zip(names, r, strict=True))[c]) for c in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    out = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        out.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return out


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    ours = queries.QUERIES[name](spark, sf_dir)
    theirs = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    assert told([tuple(r) for r in ours.collect()], ours.columns) == told(theirs.fetchall(), columns)


def test_source_batches_of_over_999_sets_match_the_sql(spark, tmp_path):
    # 3,010 suppliers make 1,004 sets
    spark.range(3010).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    ours = queries.QUERIES["gen_source_batches"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    theirs = duck.execute(queries.ORACLE_SQL["gen_source_batches"])
    assert told([tuple(r) for r in ours.collect()], ours.columns) == told(theirs.fetchall(), [d[0] for d in theirs.description])
    # the generator itself keeps the whole number
    assert sample.source_batches(spark, 3010)["json"].where("set_id = 'set_1004'").count() == 1


def test_every_core_query_has_sql():
    assert set(queries.QUERIES) == set(queries.ORACLE_SQL)
    assert set(queries.QUERIES) <= set(entry.queries()) and set(queries.ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
