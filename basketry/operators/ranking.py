"""Global average ranks and rank scores without a global sort.

A rank over all rows needs one total order, which a plain window puts into one task. Two
observations avoid that:

* Ranks depend on the value alone, so values are counted first. They are counted per
  bucket ``sign(v) * floor(sqrt(|v|))``, which is a pure function of the value and keeps
  the order. If the values of a metric add up to T, then at most T/x of them exceed x and at
  most sqrt(x) buckets lie below x, so there are O(T^(1/3)) filled buckets: about four
  million where T is the largest 64-bit number. The running count over the buckets is
  therefore small however many rows there are and however they are distributed.
* A score is a step function of the value with at most four steps. Each step lies in one
  bucket, and only the values of those few buckets have to be ranked exactly. A bucket
  around v spans 2 * sqrt(v) values, and at most T/v values reach v, so the exact part is
  bounded in the same way. What leaves the operator is the first value of every score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

TOP_SCORE = 5


def bucket_of(value: Column) -> Column:
    """Order-preserving bucket number of a whole number."""
    return (F.signum(value) * F.floor(F.sqrt(F.abs(value)))).cast("bigint")


def rank_score(rank: Column, rows: Column) -> Column:
    """Share of the rank scaled to 1..5 and cut off; 5 only for the very last rank."""
    scaled = rank / F.nullif(rows, F.lit(0)) * TOP_SCORE
    return F.greatest(F.lit(1.0), F.least(F.lit(float(TOP_SCORE)), scaled)).cast("int")


def _running(size: Column, *by: str, order: str) -> Column:
    window = Window.partitionBy(*by).orderBy(order)
    return F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _mean_rank(upto: Column, peers: Column) -> Column:
    """Mean position of tied rows, the last of which is at `upto`."""
    return upto - peers + (peers + 1) / F.lit(2.0)


def _buckets(values: DataFrame) -> DataFrame:
    """Filled buckets per metric with the count up to and including each, and the total."""
    sizes = values.groupBy("metric", bucket_of(F.col("value")).alias("bucket")).agg(
        F.sum("weight").alias("size"), F.min("value").alias("lowest")
    )
    return sizes.select(
        "*",
        _running(F.col("size"), "metric", order="bucket").alias("upto"),
        F.sum("size").over(Window.partitionBy("metric")).alias("rows"),
    )


def average_ranks(values: DataFrame) -> DataFrame:
    """Average rank of every distinct value: (metric, value, weight) to one row per value."""
    offsets = _buckets(values).select(
        "metric", "bucket", (F.col("upto") - F.col("size")).alias("before")
    )
    counted = values.groupBy(
        "metric", bucket_of(F.col("value")).alias("bucket"), "value"
    ).agg(F.sum("weight").alias("peers"))
    upto = F.col("before") + _running(F.col("peers"), "metric", "bucket", order="value")
    return counted.join(offsets, ["metric", "bucket"]).select(
        "metric", "value", "peers", _mean_rank(upto, F.col("peers")).alias("average_rank")
    )


def score_cuts(values: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """The lowest value of each score from 2 to 5, as one row with one struct per metric.

    `values` holds (metric, value, weight); a row of weight zero takes no rank. A struct
    holds the array `cuts`, null where no value reaches the score, and the `lowest` value.
    """
    buckets = _buckets(values).select(
        "*",
        (F.col("upto") - F.col("size")).alias("before"),
        rank_score(F.col("upto"), F.col("rows")).alias("score"),
    )
    steps_inside = F.col("score") > rank_score(F.col("before"), F.col("rows"))
    flat = buckets.where(~steps_inside).select("metric", F.col("lowest").alias("value"), "score")

    # At most four buckets per metric, because a score rises at most four times. `lowest`
    # changes nothing in the join, but asking for it lets both uses share one exchange.
    stepped = buckets.where(steps_inside).select("metric", "bucket", "lowest", "before", "rows")
    inside = (
        values.withColumn("bucket", bucket_of(F.col("value")))
        .join(F.broadcast(stepped), ["metric", "bucket"])
        .where(F.col("value") >= F.col("lowest"))
        .groupBy("metric", "bucket", "value", "before", "rows")
        .agg(F.sum("weight").alias("peers"))
    )
    upto = F.col("before") + _running(F.col("peers"), "metric", "bucket", order="value")
    exact = inside.select("metric", "value", "peers", "rows", upto.alias("upto")).select(
        "metric",
        "value",
        rank_score(_mean_rank(F.col("upto"), F.col("peers")), F.col("rows")).alias("score"),
    )

    def found(metric: str) -> Column:
        cuts = [
            f"min(value) FILTER (WHERE metric = '{metric}' AND score >= {score})"
            for score in range(2, TOP_SCORE + 1)
        ]
        lowest = f"min(value) FILTER (WHERE metric = '{metric}')"
        return F.expr(
            f"named_struct('cuts', array({', '.join(cuts)}), 'lowest', {lowest})"
        ).alias(metric)

    return flat.unionByName(exact).agg(*[found(metric) for metric in metrics])


def score_from_cuts(value: str, cuts: str) -> Column:
    """Score of a value expression given the array of its metric's cuts."""
    steps = [
        f"if({value} >= {cuts}[{position}], 1, 0)" for position in range(TOP_SCORE - 1)
    ]
    return F.expr(" + ".join(["1", *steps]))
