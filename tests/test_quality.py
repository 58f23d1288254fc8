from __future__ import annotations

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import assert_same_rows, rows
from tablewright.functions.quality import NULLS, NULLS_AND_ZEROS
from tablewright.operators import hints, quality

NAN = float("nan")
NOON = datetime.datetime(2020, 1, 1, 12)


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(
        [
            (1, 1.5, 2, "abc", NOON, False),
            (2, None, 2, "abc", NOON, True),
            (3, NAN, 2, "abc", NOON, True),
            (4, 0.0, 2, "abc", NOON, True),
            (5, -0.0, 2, "abc", NOON, True),
            (6, 1.5, 0, "abc", NOON, True),
            (7, 1.5, 2, "0", NOON, True),
            (8, 1.5, 2, "0.0", NOON, True),
            (9, 1.5, 2, "0.5", NOON, True),
            (10, 1.5, 2, "", NOON, True),
            (11, 1.5, 2, None, NOON, True),
            (12, 1.5, 2, "abc", None, True),
            (13, 1.5, 2, "abc", NOON, None),
            (14, 1.5, 2, "NaN", NOON, True),
            (15, 1.5, None, "abc", NOON, True),
            (16, float("inf"), -1, " 0 ", NOON, True),
        ],
        "id int, d double, i int, s string, t timestamp, b boolean",
    )


def ids(df) -> list[int]:
    return sorted(row.id for row in df.collect())


def test_null_rows(edge):
    good, bad = quality.split_bad_rows(edge, NULLS)
    assert ids(bad) == [2, 11, 12, 13, 15]
    assert ids(good) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 14, 16]
    assert ids(quality.drop_null_rows(edge)) == ids(good)


def test_null_nan_and_zero_rows(edge):
    good, bad = quality.split_bad_rows(edge, NULLS_AND_ZEROS)
    assert ids(good) == [1, 9, 10]
    assert ids(bad) == [2, 3, 4, 5, 6, 7, 8, 11, 12, 13, 14, 15, 16]
    assert ids(quality.drop_null_nan_zero_rows(edge)) == ids(good)


def test_every_numeric_type(spark):
    df = spark.sql(
        "SELECT id, cast(id AS tinyint) a, cast(id AS smallint) b, cast(id AS bigint) c, "
        "cast(id AS float) d, cast(id AS decimal(10, 2)) e FROM VALUES (0), (1), (-1) AS t(id)"
    )
    for name in "abcde":
        assert ids(quality.drop_null_nan_zero_rows(df.selectExpr("id + 5 AS id", name))) == [4, 6]


def test_nested_and_binary_columns_are_bad_only_when_null(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, array(0), X'00', date'2020-01-01'), "
        "(2, CAST(NULL AS array<int>), X'00', date'2020-01-01') AS t(id, a, b, c)"
    )
    assert ids(quality.drop_null_nan_zero_rows(df)) == [1]


def test_dropping_gives_back_the_clean_table(spark):
    clean = spark.createDataFrame(
        [("sunny", 85, 85, "no"), ("rain", 70, 96, "yes"), ("rain", 70, 96, "yes")],
        "outlook string, temperature long, humidity long, play string",
    )
    nulls = spark.createDataFrame(
        [(None, 85, 85, "no"), ("rain", None, 96, "yes"), (None, None, None, None)], clean.schema
    )
    zeros = spark.createDataFrame([("rain", 0, 96, "yes"), ("0", 1, 1, "no")], clean.schema)
    assert_same_rows(quality.drop_null_rows(clean.union(nulls)), clean)
    assert_same_rows(
        quality.drop_null_nan_zero_rows(clean.union(nulls).union(zeros)), clean
    )


def test_report(edge):
    assert rows(quality.bad_data_report(edge, NULLS)) == [(16, 11, 5, 31.25, "due to nulls")]
    assert rows(quality.bad_data_report(edge, NULLS_AND_ZEROS)) == [
        (16, 3, 13, 81.25, "due to nulls and zeros")
    ]


def test_report_of_an_empty_table(edge):
    report = quality.bad_data_report(edge.where("false"), NULLS)
    assert rows(report) == [(0, 0, 0, None, "due to nulls")]


def test_custom_predicate_keeps_rows_it_cannot_judge(edge):
    rule = F.col("i") > 1
    good, bad = quality.split_bad_rows(edge, is_bad=rule)
    assert ids(good) == [6, 15, 16]
    assert good.count() + bad.count() == edge.count()
    report = quality.bad_data_report(edge, is_bad=rule, reason="due to size")
    assert rows(report) == [(16, 3, 13, 81.25, "due to size")]


def test_unknown_mode(edge):
    with pytest.raises(ValueError, match="mode"):
        quality.split_bad_rows(edge, "zeros")


def test_hundreds_of_columns(spark):
    names = [f"c{i}" for i in range(300)]
    df = spark.range(3).select("id", *[(F.col("id") + 1).alias(name) for name in names])
    assert quality.bad_data_report(df, NULLS).first().removed_rows == 0
    with_null = df.withColumn("c299", F.nullif(F.col("id"), F.lit(1)))
    assert ids(quality.drop_null_rows(with_null)) == [0, 2]


def test_persisted_input_is_released(spark):
    df = spark.range(10).selectExpr("id", "nullif(id, 3) AS v")
    with hints.persisted(df) as kept:
        good, bad = quality.split_bad_rows(kept, NULLS)
        assert kept.is_cached
        assert (good.count(), bad.count()) == (9, 1)
    assert not df.is_cached


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.floats()),
            st.one_of(st.none(), st.integers(-3, 3)),
            st.one_of(st.none(), st.sampled_from(["", "0", "x", "-0", "1e0", "00", "nan", "0x0"])),
        ),
        min_size=10,
        max_size=60,
    )
)
def test_good_and_bad_rows_are_the_input(spark, data):
    df = spark.createDataFrame(data, "d double, i int, s string")
    for mode in (NULLS, NULLS_AND_ZEROS):
        good, bad = quality.split_bad_rows(df, mode)
        assert_same_rows(good.unionAll(bad), df)
        report = quality.bad_data_report(df, mode).first()
        assert report.removed_rows == bad.count()
        assert report.output_rows == good.count()


@pytest.mark.parametrize(
    "x, expected", [(25, 4), (1.0, 1), (0, 2), (NAN, 0), (float("inf"), 1), (7, 0)]
)
def test_count_value_occurrences(spark, x, expected):
    values = ["25", "25.0", " 25 ", "2.5e1", "1", "abc", "", None, "0", "-0.0", "NaN", "Infinity"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert rows(quality.count_value_occurrences(df, "s", x)) == [(expected,)]


def test_count_value_occurrences_in_numbers(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,), (NAN,)], "v double")
    assert rows(quality.count_value_occurrences(df, "v")) == [(2,)]
    assert rows(quality.count_value_occurrences(df, "v", NAN)) == [(0,)]
    assert rows(quality.count_value_occurrences(df.where("false"), "v")) == [(0,)]
    with pytest.raises(ValueError):
        quality.count_value_occurrences(df, "v", "1")


NUMBER_PIECES = [
    "", " ", "\t", "\n", "\x00", "\x7f", "+", "-", "0", "00", "0.0", ".0", "0.", ".", "1", "12.5",
    "e", "E5", "e-400", "e+2", "d", "F", "f", "0x", "0X1", "p0", "P-2", "nan", "NaN", "inf",
    "Infinity", "INF", "x", "_", ",", " ", "٠",
]


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(st.sampled_from(NUMBER_PIECES), max_size=5).map("".join), min_size=40))
def test_the_number_pattern_hides_nothing_from_the_cast(spark, texts):
    from tablewright.functions.numbers import number_in_text

    df = spark.createDataFrame([(text,) for text in texts], "s string")
    lost = df.where(~number_in_text(F.col("s")).eqNullSafe(F.expr("try_cast(s AS double)")))
    assert rows(lost) == []
