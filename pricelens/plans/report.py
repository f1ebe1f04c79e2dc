"""A1, I1, L1: row and column counts per stage, and a sample.

The reference ran ``count()`` and ``show()`` after every stage, each one a new
job over the whole lineage. Here each stage is wrapped in ``observe``: the
counts are gathered by the one job that runs the final plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

REPORT_SCHEMA = StructType([StructField("stage", StringType()), StructField("columns", LongType()),
                            StructField("rows", LongType()), StructField("schema", StringType())])


def _observed(obs: Observation) -> int:
    """The observed rows; 0 for a stage that the optimizer dropped because it is empty."""
    try:
        return int(obs.get["rows"])
    except AssertionError:
        return 0


class StageCounter:
    """Collects (stage, columns, rows, schema) for the stages of one plan."""

    def __init__(self):
        self._stages: list[tuple[str, int, str, Observation]] = []

    def mark(self, name: str, df: DataFrame) -> DataFrame:
        obs = Observation(name)
        self._stages.append((name, len(df.columns), schema_text(df), obs))
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def report(self, spark: SparkSession) -> DataFrame:
        """Call after the final plan ran; one row per marked stage."""
        rows = [(name, columns, _observed(obs), schema) for name, columns, schema, obs in self._stages]
        return spark.createDataFrame(rows, REPORT_SCHEMA)


def schema_text(df: DataFrame) -> str:
    """I1: names and types of the columns, nested ones included."""
    return df.schema.simpleString().removeprefix("struct<").removesuffix(">")


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """L1: the first ``n`` rows, in no particular order."""
    return df.limit(n)
