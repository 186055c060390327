"""What a stream leaves behind in its checkpoint, read with Spark's state data source.

State that the watermark does not evict grows for ever, and neither the sink nor the row
counts show it. These readers return the rows of state themselves, so that a bound can be
checked and not only believed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operator_state(spark: SparkSession, checkpoint: str, operator: int = 0, join_side: str | None = None) -> DataFrame:
    """The state of one stateful operator after the last committed batch: ``key`` and ``value`` structs.

    ``join_side``: 'left' or 'right' rows of a stream-stream join.
    """
    r = spark.read.format("statestore").option("operatorId", operator)
    if join_side:
        r = r.option("joinSide", join_side)
    return r.load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operatorId, operatorName, stateStoreName, numPartitions and batch ids of a checkpoint's operators."""
    return spark.read.format("state-metadata").load(checkpoint)


def left_in_state(state: DataFrame, event_time, bound) -> DataFrame:
    """keys_left, behind_watermark: rows of state, and those whose ``event_time`` is below ``bound``."""
    behind = F.sum((event_time < bound).cast("long"))
    return state.agg(F.count(F.lit(1)).alias("keys_left"), F.coalesce(behind, F.lit(0)).alias("behind_watermark"))
