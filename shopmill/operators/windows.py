"""Ranking and running measures. Ties are broken by the columns the caller passes last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmill.operators.scale import global_rank, same


def pick_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of each group (latest order, first order, latest shipment)."""
    return top_n_per_group(df, keys, order_by, 1).drop("position")


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, out: str = "position"
) -> DataFrame:
    """First ``n`` rows of each group; each task keeps ``n`` per group before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= n)


def rank_in_group(
    df: DataFrame, keys: Sequence[str], score: str, max_rank: int, out: str = "rank"
) -> DataFrame:
    """``rank() <= max_rank`` within each group, all ties kept, no group gathered in one task.

    The distinct scores of a group with their counts are cut to the ``max_rank`` best, which decide
    the ranks, and join back to the rows by group and score.
    """
    counts = df.groupBy(*keys, score).agg(F.count("*").alias("_c"))
    best = top_n_per_group(counts, keys, [F.col(score).desc_nulls_last()], max_rank, "_n")
    ahead = (
        Window.partitionBy(*keys).orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = best.withColumn(out, (F.coalesce(F.sum("_c").over(ahead), F.lit(0)) + 1).cast("int"))
    ranks = ranks.filter(F.col(out) <= max_rank)
    names = [f"_{c}" for c in (*keys, score)]
    ranks = ranks.select(*[F.col(c).alias(n) for c, n in zip((*keys, score), names)], out)
    return df.join(ranks, same((*keys, score), names)).select(*df.columns, out)


def ranked(df: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """Global rank by descending score (see ``scale.global_rank``)."""
    return global_rank(df, score, out)


def running_total(df: DataFrame, order: str, value: str, out: str = "running_total") -> DataFrame:
    """Cumulative sum over one row per day or month.

    Rows of one day are summed first, so the single ordered pass sees days, whatever ``df`` holds; they
    then share the total that the day ends with.
    """
    window = Window.orderBy("_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_day = df.groupBy(F.col(order).alias("_o")).agg(F.sum(value).alias("_v"))
    totals = per_day.select("_o", F.sum("_v").over(window).alias(out))
    return df.join(totals, same([order], ["_o"])).drop("_o")


def period_growth(df: DataFrame, order: Sequence[str], value: str) -> DataFrame:
    """Previous period with data, difference and growth in percent (NULL after a zero period).

    ``df`` is one row per period, an aggregate by ``order``; periods are as few as months are.
    """
    previous = F.lag(value).over(Window.orderBy(*order))
    step = df.withColumn("prev_sales", previous)
    diff = F.col(value) - F.col("prev_sales")
    base = F.nullif(F.col("prev_sales").cast("double"), F.lit(0.0))
    return step.withColumns(
        {"sales_diff": diff, "growth_pct": diff.cast("double") / base * F.lit(100.0)}
    )
