"""Join strategy helpers.

A side is broadcast only when the plan's statistics bound its bytes; otherwise the join stays a
shuffle join and AQE (skew-join splitting, broadcast by the sizes met at run time) takes over.
The statistics are file sizes scaled by the columns read, so no job runs to decide. Spark's own
estimate for a join is the product of its sides, which is why the bound is taken here on the side
the rows come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_BYTES_CONF = "pricelens.broadcast.maxBytes"
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20
IN_MEMORY = 4  # bytes of rows for a byte of compressed file


def max_broadcast_bytes(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_BROADCAST_BYTES_CONF, str(DEFAULT_MAX_BROADCAST_BYTES)))


def plan_bytes(df: DataFrame) -> int:
    """Bytes of ``df`` by the statistics of its optimized plan; very large where nothing is known."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row by the default sizes of its types."""
    return df._jdf.schema().defaultSize()


def fits_broadcast(df: DataFrame, widened: DataFrame | None = None, least_row: int | None = None) -> bool:
    """Whether ``df`` fits into the bound. ``widened`` is what is broadcast when that is not ``df``
    itself: it has a row for each row of ``df`` or, with ``least_row``, one for at least that many
    bytes of it."""
    size = plan_bytes(df) * IN_MEMORY
    if widened is not None:
        size = size // (least_row or row_bytes(df)) * row_bytes(widened)
    return size <= max_broadcast_bytes(df.sparkSession)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """``broadcast(df)`` when its bytes are bounded, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df) else df
