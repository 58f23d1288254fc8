from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from tablewright.functions.lookup import looked_up

TEXTS = ["", "a", "A", "é", "\U0001f600", 'quo"te', "back\\slash", "new\nline", "nul\u0000", " ", "1", "null"]


@pytest.mark.parametrize("n", [1, 8, 9, 12, 3000])
def test_every_text_finds_its_number(spark, n):
    texts = (TEXTS + [f"value {i}" for i in range(3000)])[:n]
    numbers = {t: i * 0.1 - 5 for i, t in enumerate(texts)}
    df = spark.createDataFrame([(t,) for t in [*texts, "unseen", None]], "t string")
    found = {r.t: r.x for r in df.select("t", looked_up(F.col("t"), numbers).alias("x")).collect()}
    assert found == {**numbers, "unseen": None, None: None}


def test_the_table_is_a_literal(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("t"))
    assert "from_json" not in plan_of(df.select(looked_up(F.col("t"), {str(i): 1.0 for i in range(100)}).alias("x")))


def test_no_texts_and_bad_numbers(spark):
    assert spark.range(1).select(looked_up(F.lit("a"), {}).alias("x")).first().x is None
    with pytest.raises(ValueError, match="finite"):
        looked_up(F.lit("a"), {"a": float("inf")})
