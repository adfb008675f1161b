"""Usage log: cost, scope, projection, budget."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright import fixed_values as V
from pagewright.operators.ordering import with_prefix_sum


@dataclass(frozen=True)
class Prices:
    """USD per million tokens, as decimal text."""

    tok_in: str = V.PRICE_IN
    tok_out: str = V.PRICE_OUT
    cached: str = V.PRICE_CACHED


def _micro(price: str) -> Column:
    """Price per million tokens as a decimal; tokens times this are millionths of a USD."""
    return F.lit(price).cast("decimal(8,4)")


def _tokens(column) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("decimal(18,0)")


def micro_usd(prices: Prices = Prices()) -> Column:
    """Exact cost of one call in millionths of a USD."""
    fresh = _tokens("tok_in") - _tokens("cached")
    parts = fresh * _micro(prices.tok_in) + _tokens("tok_out") * _micro(prices.tok_out)
    return (parts + _tokens("cached") * _micro(prices.cached)).cast("decimal(28,4)")


def _usd(total: Column) -> Column:
    return total.cast("double") / 1000000


def _measures(prices: Prices) -> list:
    cached = F.coalesce("cached", F.lit(0))
    return [
        F.count(F.lit(1)).alias("calls"),
        F.coalesce(F.sum(F.coalesce("tok_in", F.lit(0)) - cached), F.lit(0)).alias("input"),
        F.coalesce(F.sum(F.coalesce("tok_out", F.lit(0))), F.lit(0)).alias("output"),
        F.coalesce(F.sum(cached), F.lit(0)).alias("cached"),
        _usd(F.coalesce(F.sum(micro_usd(prices)), F.lit(0))).alias("usd"),
    ]


def usage_cost(log: DataFrame, prices: Prices = Prices()) -> DataFrame:
    return log.agg(*_measures(prices))


def cost_by_tag(log: DataFrame, prices: Prices = Prices()) -> DataFrame:
    tagged = log.withColumn("tag", F.coalesce("tag", F.lit(V.DEFAULT_TAG)))
    return tagged.groupBy("tag").agg(*_measures(prices)).orderBy(F.desc("usd"), "tag")


def today_scope(log: DataFrame, day: str) -> DataFrame:
    """Rows of one day, as a range the scan can use."""
    start = F.lit(day).cast("timestamp")
    return log.filter((F.col("t") >= start) & (F.col("t") < start + F.expr("interval 1 day")))


def project_remaining(total: DataFrame, done: DataFrame, prices: Prices = Prices(), mean_in: int = V.MEAN_IN, mean_out: int = V.MEAN_OUT) -> DataFrame:
    """Pages left, never below zero, and what they would cost at the mean page size."""
    finished = done.agg(F.count(F.lit(1)).alias("n")).scalar()
    left = total.agg(F.count(F.lit(1)).alias("total")).withColumn("done", finished)
    remaining = left.withColumn("remaining", F.greatest(F.lit(0), F.col("total") - F.col("done")))
    each = F.lit(mean_in).cast("decimal(18,0)") * _micro(prices.tok_in) + F.lit(mean_out).cast("decimal(18,0)") * _micro(prices.tok_out)
    cost = (F.col("remaining").cast("decimal(12,0)") * each.cast("decimal(16,4)")).cast("decimal(28,4)")
    return remaining.withColumn("usd", _usd(cost))


def budget_cutoff(log: DataFrame, limit_usd: str, prices: Prices = Prices(cached="0"), order=("t", "event_id")) -> DataFrame:
    """Spend before each call and whether the call is blocked; a limit of 0 blocks nothing."""
    priced = log.withColumn("_cost", micro_usd(prices))
    summed = with_prefix_sum(priced, order, F.col("_cost"), "_upto")
    before = F.col("_upto") - F.col("_cost")
    limit = (F.lit(limit_usd).cast("decimal(18,6)") * F.lit(1000000).cast("decimal(8,0)")).cast("decimal(28,4)")
    blocked = (limit > 0) & (before >= limit)
    return summed.withColumn("spent_before", _usd(before)).withColumn("blocked", blocked).drop("_cost", "_upto")


def first_blocked(flagged: DataFrame, order=("t", "event_id")) -> DataFrame:
    """The call at which spending stopped, and how many calls were let through or blocked."""
    return flagged.agg(
        F.min_by("event_id", F.when(F.col("blocked"), F.struct(*order))).alias("first_blocked"),
        F.count_if(~F.col("blocked")).alias("allowed"),
        F.count_if("blocked").alias("blocked"),
    )
