"""Every query against its SQL on the smallest tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom.operators import quality
from corpusloom.plans.registry import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# queries without SQL in this list are held to their invariants in the other tests
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"/root/testdata/sf0.001/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_same_as_sql(spark, duck, small, name):
    df = entry.queries()[name](spark, small)
    names = sorted(df.columns)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == names
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert key(df.select(names).collect()) == key(want.select(*(f'"{n}"' for n in names)).fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, small, name):
    assert entry.queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_built_in_plans_have_no_python(spark, small):
    for name in ("segment_filter", "file_quality", "speaker_stats", "length_scores", "match_tokens", "wer_corpus", "interval_overlap", "order_preserving_dedupe", "llm_validity"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name
    plan = QUERIES["segment_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[(.*?)\], ReadSchema", plan) if "l_extendedprice" in x[0])
    assert "l_shipmode" not in scan[0] and "l_tax" not in scan[0] and "IsNotNull(l_quantity)" in scan[1]


def test_limits_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([("a", 0.5, 2.0)], "source_audio_path string, score double, duration_sec double").write.parquet(f"{tmp_path}/seg")
    report = spark.createDataFrame([("a", 0.9)], "source_audio_path string, coverage_ratio double")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    rows = quality.filter_segments(spark.read.parquet(f"{tmp_path}/seg"), report)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 1 and "GreaterThanOrEqual(score,0.35)" in plan and "LessThanOrEqual(duration_sec,30.0)" in plan
    spark.conf.unset("spark.sql.maxMetadataStringLength")
