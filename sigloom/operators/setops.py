"""Unions and set comparisons."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def shared_keys(a: DataFrame, b: DataFrame, key: str, *, must_exist: bool = False) -> DataFrame:
    """Keys on both sides; optionally the query fails when there are none."""
    both = a.select(key).intersect(b.select(key))
    if not must_exist:
        return both
    n = both.agg(F.count(F.lit(1))).scalar()
    check = F.assert_true(n > 0, F.lit(f"no shared {key}: the two tables use different keys"))
    return both.union(
        a.sparkSession.range(1).select(check.alias("ok")).filter("ok is not null").select(
            F.lit(None).cast(a.schema[key].dataType).alias(key)
        )
    )


def missing_values(df: DataFrame, column: str, expected: Iterable[str]) -> DataFrame:
    """Expected values that never occur, compared in lower case and trimmed."""
    want = df.sparkSession.createDataFrame([(v,) for v in expected], f"{column} string")
    have = df.select(F.lower(F.trim(F.col(column))).alias(column)).distinct()
    return want.join(have, column, "left_anti")
