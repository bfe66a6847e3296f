from __future__ import annotations

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.operators.ranking import (
    average_ranks,
    bucket_of,
    score_cuts,
    score_from_cuts,
)

SCHEMA = "metric string, value bigint, weight bigint"


def expected_scores(values):
    """Brute force: average rank over the whole column, scaled and cut off."""
    ranks = pd.Series(values).rank(method="average")
    return (ranks / len(values) * 5).clip(1, 5).astype(int).tolist()


def distributed_scores(spark, columns: dict[str, list[int]]) -> dict[str, list[int]]:
    """Scores of several columns in one run, in the order of their values."""
    entries = [
        (name, value, 1, position)
        for name, values in columns.items()
        for position, value in enumerate(values)
    ]
    df = spark.createDataFrame(entries, SCHEMA + ", position int").repartition(5)
    cuts = score_cuts(df.drop("position"), list(columns)).first()
    found = {}
    for name in columns:
        one = df.where(F.col("metric") == name).withColumn(
            "cuts", F.array(*[F.lit(cut).cast("bigint") for cut in cuts[name].cuts])
        )
        scored = one.select("position", score_from_cuts("value", "cuts").alias("score"))
        found[name] = [row.score for row in sorted(scored.collect())]
        assert cuts[name].lowest == min(columns[name])
    return found


def random_columns() -> dict[str, list[int]]:
    generator = random.Random(7)
    spread = [generator.randrange(10**12) for _ in range(743)]
    return {
        "five": [1, 2, 3, 4, 5],
        "tied": [10, 10, 20, 20],
        "all_equal": [7] * 11,
        "single": [42],
        "two": [2, 1],
        "tied_maximum": [1, 2, 3, 9, 9],
        "negative": [-5, -4, -4, 0, 3, -10_000, 17],
        "spread": spread,
        "few_values": [generator.randrange(6) for _ in range(500)],
        "one_bucket": [10**12 + generator.randrange(50) for _ in range(400)],
        "third_equal": spread[:300] + [spread[0]] * 150,
        "near_limits": [2**53, 2**53 - 1, 0, 1, 2**40],
    }


def test_scores_equal_brute_force(spark):
    columns = random_columns()
    found = distributed_scores(spark, columns)
    assert found == {name: expected_scores(values) for name, values in columns.items()}
    assert found["five"] == [1, 2, 3, 4, 5]
    # A tied maximum has an average rank below the last, so nobody scores 5.
    assert max(found["tied_maximum"]) == 4


@settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=40), min_size=8, max_size=8)
)
def test_scores_equal_brute_force_on_any_values(spark, lists):
    columns = {f"m{position}": values for position, values in enumerate(lists)}
    expected = {name: expected_scores(values) for name, values in columns.items()}
    assert distributed_scores(spark, columns) == expected


def test_average_ranks_equal_brute_force(spark):
    columns = random_columns()
    df = spark.createDataFrame(
        [(name, value, 1) for name, values in columns.items() for value in values], SCHEMA
    )
    found = {(r.metric, r.value): (r.peers, r.average_rank) for r in average_ranks(df).collect()}
    for name, values in columns.items():
        ranks = pd.Series(values).rank(method="average")
        for value, rank in zip(values, ranks):
            assert found[name, value] == (values.count(value), rank)


def test_rows_of_weight_zero_take_no_rank(spark):
    entries = [("m", value, 1) for value in (1, 2, 3, 4, 5)]
    entries += [("m", value, 0) for value in (0, 2, 3, 99)]
    found = score_cuts(spark.createDataFrame(entries, SCHEMA), ["m"]).first().m
    cuts = F.array(*[F.lit(cut) for cut in found.cuts])
    scores = (
        spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 5)], "value bigint")
        .withColumn("cuts", cuts)
        .select("value", score_from_cuts("value", "cuts").alias("score"))
    )
    assert [row.score for row in scores.orderBy("value").collect()] == [1, 2, 3, 4, 5]
    assert found.lowest == 0


def test_buckets_keep_the_order(spark):
    edges = sorted(
        {sign * (root * root + shift) for root in (0, 1, 2, 3, 1000, 94906265, 3037000499)
         for shift in (-1, 0, 1) for sign in (-1, 1)}
    )
    df = spark.createDataFrame([(edge,) for edge in edges], "value bigint")
    buckets = [row.b for row in df.orderBy("value").select(bucket_of(F.col("value")).alias("b")).collect()]
    assert buckets == sorted(buckets)


def test_cuts_never_sort_all_rows_in_one_task(spark):
    """The only single-partition exchange carries the final partial minima."""
    df = spark.range(1000).select(
        F.expr("if(id % 2 = 0, 'm', 'n')").alias("metric"),
        F.col("id").alias("value"),
        F.lit(1).alias("weight"),
    )
    plan = score_cuts(df, ["m", "n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") == 1
