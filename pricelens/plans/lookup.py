"""L2-L4, D1, D2: lookups on the written layout and data-quality queries.

Lookups filter on the partition column (directory pruning) and on the bucket
column (file pruning within a directory; needs
``spark.sql.sources.bucketing.autoBucketedScan.enabled=false``), so a lookup by code
reads one directory, or one bucket file of it. A lookup by npi opens one bucket of each code of
the NPI table and reads the row groups whose Bloom filter holds the npi.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import bounded_broadcast
from ..operators.flatten import ITEM_COLUMNS, REF_COL, rate_references, used_references
from ..schemas import DOC_KEY


def rates_by_code(rates: DataFrame, code: str, columns: list[str] | None = None) -> DataFrame:
    """L2: rates of one billing code."""
    out = rates.where(F.col("billing_code") == code)
    return out.select(*columns) if columns else out


def rates_by_npi(npi_rates: DataFrame, npi: int) -> DataFrame:
    """L3: rates of one NPI (bucket filter, then pushed down to the row groups' Bloom filters)."""
    return npi_rates.where(F.col("npi") == F.lit(npi).cast("long"))


def rates_by_code_and_type(rates: DataFrame, code: str, negotiated_type: str) -> DataFrame:
    """L4: one billing code and one negotiated_type (partition plus bucket filter)."""
    return rates.where((F.col("billing_code") == code) & (F.col("negotiated_type") == negotiated_type))


def unknown_references(providers: DataFrame, in_network: DataFrame) -> DataFrame:
    """D1: rate references no provider group of the same document carries.

    ``left_anti`` against the provider ids; the provider side is broadcast when its
    bytes are bounded, else the anti join shuffles (and AQE splits a hot reference)."""
    refs = rate_references(in_network)
    known = bounded_broadcast(providers.select(DOC_KEY, F.col("provider_group_id").alias(REF_COL)))
    return refs.join(known, [DOC_KEY, REF_COL], "left_anti").select(
        DOC_KEY, *ITEM_COLUMNS, REF_COL, F.size("exploded_negotiated_rates_negotiated_prices").alias("n_prices"))


def providers_without_rates(providers: DataFrame, in_network: DataFrame) -> DataFrame:
    """D2: provider groups that no rate of the same document refers to."""
    used = used_references(in_network).withColumnRenamed(REF_COL, "provider_group_id")
    return providers.join(used, [DOC_KEY, "provider_group_id"], "left_anti")
