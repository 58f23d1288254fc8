from __future__ import annotations

import pytest

from tablewright import checks


def test_column_classes(spark):
    df = spark.sql(
        "SELECT 1 i, 1L l, 1.5D d, 1.5 e, CAST(1 AS float) f, 's' s, date'2020-01-01' dt, "
        "timestamp'2020-01-01' ts, timestamp_ntz'2020-01-01' tn, true b, array(1) a"
    )
    assert checks.columns_of_class(df, checks.NUMERIC) == ["i", "l", "d", "e", "f"]
    assert checks.columns_of_class(df, checks.CATEGORICAL) == ["s"]
    assert checks.columns_of_class(df, checks.DATETIME) == ["dt", "ts", "tn"]
    assert checks.columns_of_class(df, checks.ALL) == df.columns
    with pytest.raises(ValueError):
        checks.columns_of_class(df, "sparse")


def test_bounds():
    checks.check_bounds("v", 0.0, 0.0, 100.0)
    checks.check_bounds("v", 100.0, 0.0, 100.0)
    for value in (100.1, -0.1, float("nan"), "1", True):
        with pytest.raises(ValueError):
            checks.check_bounds("v", value, 0.0, 100.0)
    with pytest.raises(ValueError):
        checks.check_integer("v", 1.0)


def test_choice():
    checks.check_choice("color", "Blue", ["Red", "Green", "Blue"])
    with pytest.raises(ValueError, match="color"):
        checks.check_choice("color", "Pink", ["Red", "Green", "Blue"])


def test_disjoint_selectors():
    checks.require_disjoint(["a"], ["b", "c"])
    with pytest.raises(ValueError, match="'b'"):
        checks.require_disjoint(["a", "b"], ["b", "c"])


def test_names_are_told_apart_as_the_session_does(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, a_pow2 double")
    checks.require_columns(df, ["X"], checks.NUMERIC)
    with pytest.raises(ValueError, match="already exist"):
        checks.require_new_columns(df, ["a_Pow2"])
    with pytest.raises(ValueError, match="already exist"):
        checks.require_new_columns(df, ["new", "NEW"])
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        checks.require_new_columns(df, ["a_Pow2"])
        with pytest.raises(ValueError, match="missing"):
            checks.require_columns(df, ["X"])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert checks.free_names(df, ["X", "x", "y"]) == ["_X", "__x", "y"]
