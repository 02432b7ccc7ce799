"""The log of a crawl: latest states, counters, funnels. The log is only appended to; states are read off it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("indexed", "failed", "skipped", "auth_required")


def latest(log: DataFrame, *keys: str, order: str = "seq") -> DataFrame:
    """The last state of each key; repeated rows count once."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("s")).select(*keys, "s.*")


def counters(states: DataFrame, by: str) -> DataFrame:
    """Totals and counts of each status."""
    return states.groupBy(by).agg(F.count("*").alias("total"), *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES])


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """How many rows fall out at which stage, each at the first whose condition holds, and how many remain."""
    stage = F.lit("kept")
    for name, drop in reversed(stages):
        stage = F.when(F.coalesce(drop, F.lit(False)), name).otherwise(stage)
    return df.groupBy(stage.alias("stage")).agg(F.count("*").alias("n"))
