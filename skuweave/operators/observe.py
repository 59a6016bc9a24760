"""Row counts of a load, taken while it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame and an observation whose ``get`` holds the count after the action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
