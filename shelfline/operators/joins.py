"""Join hints that depend on measured sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A narrow row (key and one short attribute) takes some tens of bytes in a broadcast
# table, so this many stay well below 100 MB per executor.
BROADCAST_ROWS = 1_000_000


def broadcast_within(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` as broadcast side if it has at most ``rows`` rows.

    Spark's estimate for a chain of joins is the product of its inputs, so a tiny
    dimension built from three tables looks huge and the fact would be shuffled
    to meet it. Counting settles it. A larger side is returned without a hint:
    the join then sorts both sides and AQE splits skewed keys.
    """
    return F.broadcast(df) if df.count() <= rows else df
