"""Lookup joins (J1-J9): plain joins against written tables.

The lookup tables of the warehouse are written before they are joined, so the
planner knows their size from the files and broadcasts one only while it is
under ``spark.sql.autoBroadcastJoinThreshold``; what it cannot know beforehand
(a filtered or aggregated side) is measured by AQE at run time. Beyond the
threshold the join is a sort-merge join whose skewed partitions AQE splits.
Nothing is counted or hinted here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a large left side to a lookup table; the planner picks the strategy."""
    return left.join(right, on, how)
