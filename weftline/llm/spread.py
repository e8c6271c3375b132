"""Spreading of small inputs over all cores before Python stages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import materialize


def spread(df: DataFrame, parts: int) -> DataFrame:
    """``df``, repartitioned only where its scan has fewer partitions than ``parts``.

    Such an input is smaller than ``parts`` file splits, so the shuffle is bounded; a large input
    already has enough splits and is left as it is. ``df`` must be a scan with narrow steps: counting the
    partitions of a plan with shuffles would run them.
    """
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def spread_once(df: DataFrame, parts: int) -> DataFrame:
    """As ``spread``, for an input that several passes read: what is repartitioned is written once and read back."""
    return materialize(df.repartition(parts), "spread") if df.rdd.getNumPartitions() < parts else df
