from __future__ import annotations

import datetime
import re

import pytest

from pyspark.sql import functions as F

from helpers import plan_of, rows, shuffles_in
from tablewright.functions.dates import check_date_pattern
from tablewright.operators import columns


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("Masha", 22), ("Ulia", 21), ("Nastya", 23)], "name string, age int"
    )


def test_column_filter_keeps_only_the_chosen_column(people):
    kept = columns.column_filter(people, ["name"])
    assert kept.columns == ["name"]
    assert rows(kept) == [("Masha",), ("Ulia",), ("Nastya",)]


def test_column_filter_uses_the_order_of_selection(people):
    assert columns.column_filter(people, ["age", "name"]).columns == ["age", "name"]


def test_column_filter_takes_any_column_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "c d", "e`f"])
    assert rows(columns.column_filter(df, ["e`f", "a.b"])) == [(3, 1)]


@pytest.mark.parametrize("chosen", [["nobody"], [], ["name", "name"], "name"])
def test_column_filter_rejects_wrong_selections(people, chosen):
    with pytest.raises(ValueError):
        columns.column_filter(people, chosen)


def test_missing_columns_are_named(people):
    with pytest.raises(ValueError, match="size.*weight"):
        columns.column_filter(people, ["size", "name", "weight"])


def test_advanced_filter_needs_two_columns(people):
    with pytest.raises(ValueError, match="at least 2"):
        columns.column_filter_advanced(people, ["name"])


def test_advanced_filter_reports_columns_and_rows(people):
    kept, info = columns.column_filter_advanced(people, ["age", "name"])
    assert kept.columns == info["columns"] == ["age", "name"]
    assert rows(info["row_count"]) == [(3,)]
    assert shuffles_in(kept) == 0


@pytest.mark.parametrize("asked, expected", [(None, 4), (2, 4), (9, 9)])
def test_advanced_filter_spreads_rows_over_at_least_the_default_parallelism(
    spark, asked, expected
):
    df = spark.range(1000).selectExpr("id", "id * 2 AS twice", "'x' AS unused")
    kept, info = columns.column_filter_advanced(
        df, ["id", "twice"], repartition=True, num_partitions=asked
    )
    assert kept.rdd.getNumPartitions() == expected
    assert kept.selectExpr("sum(id)", "sum(twice)").first() == (499500, 999000)
    assert rows(info["row_count"]) == [(1000,)]


def test_power_features_are_doubles_after_the_input(spark):
    df = spark.createDataFrame([(3, 0.5), (None, -2.0)], "a int, b double")
    squared = columns.power_features(df, ["b", "a"])
    assert squared.columns == ["a", "b", "b_Pow2", "a_Pow2"]
    assert [t for _, t in squared.dtypes] == ["int", "double", "double", "double"]
    assert rows(squared) == [(3, 0.5, 0.25, 9.0), (None, -2.0, 4.0, None)]
    cubed = columns.power_features(df, ["a", "b"], "Pow3")
    assert rows(cubed.select("a_Pow3", "b_Pow3")) == [(27.0, 0.125), (None, -8.0)]


def test_power_of_a_large_int_does_not_overflow(spark):
    df = spark.createDataFrame([(2**31 - 1,)], "a int")
    assert rows(columns.power_features(df, ["a"]))[0][1] == float(2**31 - 1) ** 2


def test_power_features_table_agrees(spark):
    df = spark.range(100).selectExpr("cast(id as int) a")
    for kind in ("Pow2", "Pow3"):
        left = columns.power_features(df, ["a"], kind)
        right = columns.power_features_table(df, ["a"], kind)
        assert left.columns == right.columns
        assert rows(left) == rows(right)


def test_power_features_side_result(spark):
    df = spark.range(7).selectExpr("cast(id as double) a")
    _, info = columns.power_features_with_info(df, ["a"], "Pow3")
    assert info["transformation"] == "Pow3"
    assert rows(info["row_count"]) == [(7,)]


def test_power_features_rejects_text_and_unknown_kinds(people):
    with pytest.raises(ValueError, match="not numeric"):
        columns.power_features(people, ["name"])
    with pytest.raises(ValueError, match="kind"):
        columns.power_features(people, ["age"], "Pow4")


def test_format_date_column(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, timestamp_ntz'2020-12-29 23:59:59.120'), "
        "(2, timestamp_ntz'2021-01-03 00:00:00'), (3, NULL) AS t(id, ts)"
    )
    shown = columns.format_date_column(df, "ts")
    assert shown.columns == ["id", "ts", "ts_formatted"]
    assert [r[2] for r in rows(shown)] == ["12/29/2020", "01/03/2021", None]
    long = columns.format_date_column(df, "ts", "EEEE d MMMM yyyy 'at' hh:mm:ss.SSS a")
    assert rows(long)[0][2] == "Tuesday 29 December 2020 at 11:59:59.120 PM"


def test_format_date_column_takes_dates_and_zoned_timestamps(spark):
    df = spark.createDataFrame(
        [(datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 13, 5))],
        "d date, t timestamp",
    ).selectExpr("d", "timestamp'2024-02-29 13:05:00 UTC' t")
    assert rows(columns.format_date_column(df, "d", "dd.MM.yy"))[0][2] == "29.02.24"
    assert rows(columns.format_date_column(df, "t", "HH 'o''clock'"))[0][2] == "13 o'clock"


def test_format_date_column_rejects_other_types(people):
    with pytest.raises(ValueError, match="not datetime"):
        columns.format_date_column(people, "name")


@pytest.mark.parametrize(
    "pattern", ["MM/dd/yyyy", "yyyyMMdd", "''yy", "h 'o''clock' a", "EEE, d MMM yyyy HH:mm:ss Z"]
)
def test_good_patterns(pattern):
    assert check_date_pattern(pattern) == pattern


@pytest.mark.parametrize(
    "pattern",
    ["", "YYYY", "ww", "W", "u", "F", "QQ", "q", "S", "SS", "SSSS", "MMMMM", "GGGG", "ZZZZ",
     "yyyy 'open", "b", "[yyyy]", "yyyy{", "dd#", "aa", "HHH"],
)
def test_bad_patterns(pattern):
    with pytest.raises(ValueError):
        check_date_pattern(pattern)


def test_every_allowed_pattern_runs(spark):
    from tablewright.functions.dates import ALLOWED_REPEATS

    df = spark.sql("SELECT timestamp'2020-10-30 10:10:10.5' AS t")
    for letter, repeats in ALLOWED_REPEATS.items():
        for count in repeats:
            assert columns.format_date_column(df, "t", letter * count).first()[1]


def test_column_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "v string")
    assert rows(columns.column_values(df, "v", 3)) == [(None,), ("a",), ("b",)]
    repeated = columns.column_values(df, "v", 10, distinct=False)
    assert rows(repeated) == [(None,), ("a",), ("b",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        columns.column_values(df, "v", 0)


def test_pair_sample(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 5.0), (1, 2.0)], "x int, y double")
    assert rows(columns.pair_sample(df, "x", "y", 2)) == [(1, 2.0), (1, 5.0)]
    big = spark.range(20_000).selectExpr("id AS a", "-id AS b")
    sample = columns.pair_sample(big, "b", "a", 5000)
    assert sample.count() == 5000
    assert sample.first() == (-19999, 19999)


@pytest.mark.parametrize("n", [1, 5, 999, 5000, 20_000])
def test_previews_of_any_length_move_only_their_rows(spark, n):
    """No part hands on more than n rows, also beyond Spark's own limit for ranked windows."""
    df = spark.range(0, 12_000, 1, 6).select((F.col("id") * 7919 % 4001).alias("x"), (F.col("id") % 13).alias("y"))
    want = sorted(tuple(r) for r in df.collect())[:n]
    found = columns.pair_sample(df, "x", "y", n)
    assert rows(found) == want
    exchange = re.search(r"Exchange RoundRobinPartitioning.*?(?=Range)", plan_of(found), re.S)[0]
    assert "Window" not in exchange and f"< {n}" in exchange
    values = columns.column_values(df, "y", n, distinct=False)
    assert [r[0] for r in values.collect()] == sorted(r.y for r in df.collect())[:n]
