"""Every query with SQL against DuckDB, and checks of the plans."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{small}/{t}.parquet'")
    yield con
    con.close()


def normal(frame):
    frame = frame[sorted(frame.columns)]

    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "<NA>":
            return "null"
        return repr(float(v)) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    return list(frame.columns), sorted(tuple(one(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small, duck, name):
    got = normal(queries()[name](spark, small).toPandas())
    want = normal(duck.execute(oracle_sql()[name]).fetch_df())
    assert got == want


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    assert len(oracle_sql()) > 90


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns == ["id", "type_age", "fold", "success", "te"]


LAZY = ["features_clean_full", "features_raw_full", "oof_encoding_combo_keys", "stratified_folds", "exact_auc",
        "auc_per_model_seed_fold", "rank_normalised_predictions", "target_rate_per_column", "clean_table"]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_distributed(spark, small, name):
    plan = queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_only_the_needed_columns_are_read(spark, small):
    plan = queries()["threshold_flags"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
