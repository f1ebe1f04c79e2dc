"""R1-R3, K3-K7: the written layout of the rate tables, and its catalog entry.

Rows are grouped by billing code before the write so each code's directory gets
few files. The reference used ``repartition("billing_code")``, which sends a
billing code holding a third of all rows to one task. We use the ``rebalance``
hint instead: the same clustering, but AQE splits an oversized partition over
several tasks and merges tiny ones, so files stay near the advisory size.

``rebalance`` sizes partitions by the bytes that are shuffled. Where rows are shuffled before
their prices are exploded, those bytes say little about the rows that will be written;
``by_weight`` sizes them by the rows themselves, counted beforehand from array sizes alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.flatten import REF_COL, PRICES_COL, rate_references
from ..schemas import DOC_KEY
from ..session import OPEN_FILES, scratch_dir, session_conf
from .joins import bounded_broadcast

PARTITION_COLUMN = "billing_code"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ROWS_PER_SLICE = 2_000_000
GROUPS = 256  # of billing codes, for running totals

# A Bloom filter for each row group, sized by the npis it holds; plain values, as a filter is
# left out of column chunks that are dictionary-encoded throughout.
NPI_OPTIONS = {"parquet.bloom.filter.enabled#npi": "true", "parquet.bloom.filter.adaptive.enabled": "true",
               "parquet.enable.dictionary#npi": "false"}


def _cluster(df: DataFrame, by: str, rebalance: bool | None) -> DataFrame:
    """``True``: rebalance hint; ``False``: hash repartition as the reference did;
    ``None``: the caller already clustered the rows (e.g. ``flatten_rates(cluster_by=)``)."""
    if rebalance is None:
        return df
    return df.hint("rebalance", by) if rebalance else df.repartition(by)


def rate_weights(in_network: DataFrame) -> DataFrame:
    """(billing_code, rows): the rows of the rate table for each code, from the sizes of the arrays."""
    def size(array):
        return F.coalesce(F.when(array.isNotNull(), F.size(array)), F.lit(0)).cast("long")

    rows = F.aggregate("negotiated_rates", F.lit(0).cast("long"),
                       lambda n, r: n + size(r["provider_references"]) * size(r["negotiated_prices"]))
    return (in_network.groupBy(PARTITION_COLUMN).agg(F.sum(rows).alias("rows")).where(F.col("rows") > 0))


def npi_weights(providers: DataFrame, in_network: DataFrame) -> DataFrame:
    """(billing_code, rows): the rows of the NPI table for each code."""
    npis = F.aggregate("provider_groups", F.lit(0).cast("long"),
                       lambda n, g: n + F.coalesce(F.when(g["npi"].isNotNull(), F.size(g["npi"])), F.lit(0)))
    n_npis = (providers.select(DOC_KEY, F.col("provider_group_id").alias(REF_COL), npis.alias("npis"))
              .groupBy(DOC_KEY, REF_COL).agg(F.sum("npis").alias("npis")).where(F.col("npis") > 0))
    prices = (rate_references(in_network).groupBy(DOC_KEY, REF_COL, PARTITION_COLUMN)
              .agg(F.sum(F.size(PRICES_COL)).alias("prices")))
    return (prices.join(n_npis, [DOC_KEY, REF_COL]).groupBy(PARTITION_COLUMN)
            .agg(F.sum(F.col("prices") * F.col("npis")).alias("rows")).where(F.col("rows") > 0))


def code_slices(weights: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(billing_code, first, slices): consecutive partitions for the codes, by running totals of rows.

    A code with at most ``rows_per_slice`` rows lies in one partition; one with more is cut into
    slices of equal size. The total runs inside ``GROUPS`` groups of codes, then over the groups."""
    group = F.pmod(F.xxhash64(PARTITION_COLUMN), F.lit(GROUPS)).alias("group")
    rows = weights.select(PARTITION_COLUMN, "rows", group)
    before = Window.partitionBy("group").orderBy(PARTITION_COLUMN).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    over = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # of GROUPS rows
    groups = rows.groupBy("group").agg(F.sum("rows").alias("total"))
    groups = groups.select("group", F.coalesce(F.sum("total").over(over), F.lit(0)).alias("offset"))
    size = F.lit(rows_per_slice)
    return rows.join(F.broadcast(groups), "group").select(
        PARTITION_COLUMN, F.floor((F.col("offset") + F.col("inside")) / size).alias("first"),
        F.ceil(F.col("rows") / size).alias("slices"))


def by_weight(weights: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> Callable[[DataFrame], DataFrame]:
    """A placement for ``flatten_rates(cluster_by=)``: each code's rows to its slices.

    Which slice of its code a row goes to is a hash of the row, so a repeated task sends every
    row to the same place."""
    spark = weights.sparkSession
    path = scratch_dir(spark, "code-slices")
    code_slices(weights, rows_per_slice).write.parquet(path)
    slices = spark.read.parquet(path)
    partitions = slices.agg(F.max(F.col("first") + F.col("slices"))).first()[0] or 1

    def place(rows: DataFrame) -> DataFrame:
        s = bounded_broadcast(slices).alias("s")
        r = rows.alias("r")
        placed = r.join(s, F.col(f"r.{PARTITION_COLUMN}").eqNullSafe(F.col(f"s.{PARTITION_COLUMN}")), "left")
        slot = F.pmod(F.xxhash64(*[F.col(f"r.{c}") for c in rows.columns]), F.col("s.slices"))
        return placed.select("r.*", F.coalesce(F.col("s.first") + slot, F.lit(0)).cast("int").alias("slice")).repartitionById(
            int(partitions), "slice").drop("slice")

    return place


# For a write of rows that were placed by ``by_code``: a row then holds up to 16 references and all prices of
# a rate, so the bytes shuffled are a small part of those that a task sorts and writes.
PLACED_SIZE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "6m"}


def by_code(rows: DataFrame) -> DataFrame:
    """A placement for ``flatten_rates(cluster_by=)``: by billing code and the bytes shuffled, without counting
    rows beforehand. Write the result within ``session_conf(spark, PLACED_SIZE)``."""
    return rows.hint("rebalance", PARTITION_COLUMN)


def write_bucketed(df: DataFrame, table: str, path: str, bucket_column: str, buckets: int = 2,
                   rebalance: bool | None = True, options: dict[str, str] | None = None) -> None:
    """Parquet, overwrite, partitioned by billing_code, bucketed and sorted by
    ``bucket_column``, at ``path``, registered as ``table``."""
    (_cluster(df, PARTITION_COLUMN, rebalance).write.format("parquet").mode("overwrite").options(**(options or {}))
     .partitionBy(PARTITION_COLUMN).bucketBy(buckets, bucket_column).sortBy(bucket_column)
     .option("path", path).saveAsTable(table))


def write_rates(rates: DataFrame, table: str, path: str, buckets: int = 2, rebalance: bool | None = True) -> None:
    """K3: the 19-column rate table, buckets on negotiated_type."""
    write_bucketed(rates, table, path, "negotiated_type", buckets, rebalance)


def write_npi_rates(npi_rates: DataFrame, table: str, path: str, buckets: int = 2, rebalance: bool | None = True) -> None:
    """K4: the 22-column NPI table, buckets on npi. A lookup by npi opens one bucket of each code
    and reads only the row groups whose Bloom filter holds the npi."""
    write_bucketed(npi_rates, table, path, "npi", buckets, rebalance, NPI_OPTIONS)


def write_partitions(df: DataFrame, path: str, dynamic: bool = True, rebalance: bool | None = True) -> None:
    """K5: Hive-style ``billing_code=<code>/`` directories of snappy Parquet.

    With ``dynamic`` only the codes present in ``df`` are replaced and other
    directories are left alone, like a writer that replaces files per code.
    NULL codes go to ``__HIVE_DEFAULT_PARTITION__``; ``/`` is escaped.
    """
    mode = "dynamic" if dynamic else "static"
    with session_conf(df.sparkSession, {OVERWRITE_MODE: mode, **OPEN_FILES}):
        (_cluster(df, PARTITION_COLUMN, rebalance).write.mode("overwrite").option("compression", "snappy")
         .partitionBy(PARTITION_COLUMN).parquet(path))


def register_rates(spark: SparkSession, table: str, path: str,
                   columns: str = "negotiated_rate DOUBLE, description STRING") -> DataFrame:
    """K6 + K7: an external table over a K5 directory, then partition discovery.

    The rate is DOUBLE: the data is float64 and a FLOAT column over DOUBLE Parquet
    fails to read. ``billing_code`` stays STRING, so leading zeros survive.
    """
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}, {PARTITION_COLUMN} STRING) USING parquet "
              f"PARTITIONED BY ({PARTITION_COLUMN}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def append_rates(table: str, rates: DataFrame, rebalance: bool | None = True) -> None:
    """K7 for new data: replace the codes that ``rates`` holds in a registered table, and add the
    new ones to the catalog. The codes come from the write tasks themselves, so no other directory
    is listed."""
    spark = rates.sparkSession
    with session_conf(spark, {OVERWRITE_MODE: "dynamic", **OPEN_FILES}):
        (_cluster(rates, PARTITION_COLUMN, rebalance).select(*spark.table(table).columns)
         .write.insertInto(table, overwrite=True))
