"""Names, order and types of every operator's output."""

from __future__ import annotations

import pytest

from tablewright.models import ClassWeights, ClusterModel, LinearModel, LogisticModel, weights_table
from tablewright.operators import aggregates, columns, encoding, quality, scoring, training
from tablewright.sources import generators

METRICS = [
    (name, "double")
    for name in ("explainedVariance", "meanAbsoluteError", "meanSquaredError",
                 "rootMeanSquaredError", "r2")
]
INPUT = [("n", "int"), ("x", "double"), ("s", "string"), ("t", "timestamp_ntz")]
LINEAR = LinearModel(("n",), (2.0,), 1.0, "x")
LOGISTIC = LogisticModel(("n",), (ClassWeights("b", (1.0,)),), "a", "s")

CASES = {
    "sequence": (
        lambda df: generators.sequence_source(df.sparkSession, 2),
        [("Thing", "string"), ("Number", "bigint")],
    ),
    "random": (
        lambda df: generators.random_source(df.sparkSession, 2, 1, 1, 1),
        [("DoubleCol1", "double"), ("IntCol1", "int"), ("StringCol1", "string")],
    ),
    "filter": (lambda df: columns.column_filter(df, ["s", "n"]), [("s", "string"), ("n", "int")]),
    "power": (
        lambda df: columns.power_features(df, ["x", "n"]),
        [*INPUT, ("x_Pow2", "double"), ("n_Pow2", "double")],
    ),
    "power_table": (
        lambda df: columns.power_features_table(df, ["n"], "Pow3"), [*INPUT, ("n_Pow3", "double")],
    ),
    "date": (
        lambda df: columns.format_date_column(df, "t"), [*INPUT, ("t_formatted", "string")],
    ),
    "values": (lambda df: columns.column_values(df, "t", 1), [("t", "timestamp_ntz")]),
    "pairs": (lambda df: columns.pair_sample(df, "x", "n", 9), [("x", "double"), ("n", "int")]),
    "good": (quality.drop_null_nan_zero_rows, INPUT),
    "report": (
        quality.bad_data_report,
        [("input_rows", "bigint"), ("output_rows", "bigint"), ("removed_rows", "bigint"),
         ("removed_pct", "double"), ("reason", "string")],
    ),
    "occurrences": (
        lambda df: quality.count_value_occurrences(df, "s"), [("occurrences", "bigint")],
    ),
    "count": (
        lambda df: aggregates.count_by_group(df, "s"), [("s", "string"), ("GroupCount", "bigint")],
    ),
    "product": (
        lambda df: aggregates.product_by_group(df, "s", ["x", "n"]),
        [("GroupKey", "string"), ("x_PRODUCT", "double"), ("n_PRODUCT", "double")],
    ),
    "profile": (
        aggregates.table_profile,
        [("column_name", "string"), ("data_type", "string"), ("n_rows", "bigint"),
         ("n_nulls", "bigint")],
    ),
    "metrics": (lambda df: aggregates.regression_metrics(df, "n", "x"), METRICS),
    "evaluate": (lambda df: scoring.evaluate_regression(df, LINEAR), METRICS),
    "linear": (lambda df: scoring.predict_linear(df, LINEAR), [*INPUT, ("prediction", "double")]),
    "class": (lambda df: scoring.predict_class(df, LOGISTIC), [*INPUT, ("PRED", "string")]),
    "confusion": (
        lambda df: scoring.confusion_matrix(df, LOGISTIC),
        [("Observed", "string"), ("Predicted", "string"), ("N", "bigint")],
    ),
    "clusters": (
        lambda df: scoring.score_clusters(df, ClusterModel(("n",), ((1.0,),))),
        [*INPUT, ("distance_Cluster_0", "double"), ("cluster", "string")],
    ),
    "one_hot": (
        lambda df: encoding.one_hot_encode(df, "s", ["p", "q"]),
        [*INPUT, ("s_p", "double"), ("s_q", "double")],
    ),
    "centers": (
        lambda df: ClusterModel(("n", "x"), ((1.0, 2.0),)).centers_table(df.sparkSession),
        [("ClusterName", "string"), ("n", "double"), ("x", "double")],
    ),
    "weights": (
        lambda df: weights_table(df.sparkSession, LINEAR),
        [("Predictors", "string"), ("Weights", "double")],
    ),
    "statistics": (
        lambda df: training.fit_statistics(df, LINEAR),
        [("Statistic", "string"), ("Value", "double")],
    ),
}


@pytest.fixture(scope="module")
def table(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1, 2.0D, 'p', timestamp_ntz'2020-01-01'), "
        "(2, 3.0D, NULL, NULL) AS t(n, x, s, t)"
    )


@pytest.mark.parametrize("name", CASES)
def test_schema(table, name):
    operator, expected = CASES[name]
    result = operator(table)
    assert result.dtypes == expected
    result.collect()


@pytest.mark.parametrize("name", CASES)
def test_empty_input(table, name):
    operator, expected = CASES[name]
    result = operator(table.where("n > 100"))
    assert result.dtypes == expected
    result.collect()


def test_derived_names_must_be_new(table):
    squared = columns.power_features(table, ["n"])
    for again in (
        lambda: columns.power_features(squared, ["n"]),
        lambda: columns.power_features_table(squared, ["n"]),
        lambda: columns.format_date_column(columns.format_date_column(table, "t"), "t"),
        lambda: scoring.predict_class(scoring.predict_class(table, LOGISTIC), LOGISTIC),
    ):
        with pytest.raises(ValueError, match="already exist"):
            again()
