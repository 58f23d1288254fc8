from __future__ import annotations

import re


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def assert_same_rows(left, right) -> None:
    """Equal as bags of rows: duplicates count."""
    assert left.columns == right.columns
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def plan_of(df) -> str:
    """The physical plan; of an adaptive plan that has run, its final form."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles_in(df) -> int:
    return len(re.findall(r"\bExchange ", plan_of(df)))
