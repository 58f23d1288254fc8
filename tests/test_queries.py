"""Every registered query: the same rows as its SQL, and a plan fit for large tables."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import entry
from check_oracles import differences, duck
from helpers import plan_of, shuffles_in
from tablewright.plans.oracles import SQL
from tablewright.plans.queries import QUERIES

# Joins documents with labels to have nulls: the join moves data once by itself.
IN_BLOCKS = {"fit_kmeans_embeddings"}
JOINED = {
    "drop_null_rows", "bad_data_report_nulls", "count_by_group_null", "predict_class",
    "confusion_matrix", "pair_sample", "column_values_repeated",
}


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


def test_entry_is_a_lazy_one_row_table(spark):
    result = entry(spark)
    assert result.columns == [
        "explainedVariance", "meanAbsoluteError", "meanSquaredError", "rootMeanSquaredError", "r2",
    ]
    assert result.count() == 1


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, folder, name):
    assert differences(spark, connection, folder, name) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, folder, name):
    result = QUERIES[name](spark, folder)
    plan = plan_of(result)
    assert not re.search(r"MapInPandas|ExistingRDD|Cartesian|NestedLoop", plan)
    # Blocks of points against all centres, once per row.
    assert plan.count("EvalPython") == plan.count("ArrowEvalPython") == (name in IN_BLOCKS)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert shuffles_in(result) <= (2 if name in JOINED else 1)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("column_filter", "o_orderkey:bigint,o_orderpriority:string"),
        ("row_count", ""),
        ("count_by_group", "o_orderpriority:string"),
        ("count_value_occurrences", "l_quantity:double"),
        ("pair_sample", "c_custkey:bigint,c_acctbal:double"),
        ("evaluate_regression", "l_quantity:double,l_extendedprice:double,l_tax:double"),
        ("confusion_matrix_many", "l_quantity:double,l_discount:double,l_returnflag:string"),
    ],
)
def test_scan_reads_only_the_columns_in_use(spark, folder, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan_of(QUERIES[name](spark, folder))


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("drop_null_nan_zero_rows", "Not(EqualTo(l_tax,0.0))"),
        ("drop_null_rows", "IsNotNull(quality)"),
        ("clean_score_evaluate", "Not(EqualTo(l_quantity,0.0))"),
    ],
)
def test_filters_reach_the_scan(spark, folder, name, pushed):
    result = QUERIES[name](spark, folder)
    formatted = result._sc._jvm.PythonSQLUtils.explainString(
        result._jdf.queryExecution(), "formatted"
    )
    assert pushed in formatted
