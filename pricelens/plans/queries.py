"""Driver queries: each takes (spark, sf_dir), builds the nested tables from the
test data at ``sf_dir`` and runs one operator or pipeline over all of it.

Arrays are returned as joined text (``functions.text.arrays_as_text``) so the
results compare value by value with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import uuid

from ..functions.text import arrays_as_text, code_list_text
from ..operators import flatten as fl
from ..operators.unnest import flatten_present, unnest
from ..schemas import BASE_FIELDS, DOC_KEY, NPI_RATES_COLUMNS, RATES_COLUMNS
from ..session import OPEN_FILES, scratch_dir, session_conf
from ..operators import contract
from ..schemas import RAW_DOCUMENT_NUMBERS
from ..sources.fixtures import dirty_tables, fixture_tables, inline_group_in_network, write_fixture_documents
from ..sources.raw_json import extract, extract_to_tables, read_documents, unreadable_documents
from ..sources.tables import ITEMS_PER_FILE, NPI_NEEDS, RATES_NEEDS, read_prefixes, read_tables, write_tables
from . import layout, lookup
from .report import StageCounter, sample_rows

# Lookup keys of L2-L4 (a billing code, an npi of supplier 2, a negotiated type).
LOOKUP_CODE = "00007"
LOOKUP_NPI = 1_000_000_021
LOOKUP_TYPE = "negotiated"


def _size(c):
    """Element count as BIGINT; NULL for a NULL array."""
    return F.when(c.isNotNull(), F.size(c)).cast("long")


def _tables(spark: SparkSession, sf_dir: str):
    return fixture_tables(spark, sf_dir)


def q_flatten_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    return arrays_as_text(fl.flatten_rates(b, p, i))


def q_flatten_rates_keep_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    return arrays_as_text(fl.flatten_rates(b, p, i, keep_unmatched=True))


def q_flatten_npi_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    return arrays_as_text(fl.flatten_npi_rates(b, p, i))


def q_inline_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1: NPI rates where some items list provider groups inline, unioned into Q4."""
    b, p, _ = _tables(spark, sf_dir)
    i = inline_group_in_network(spark, sf_dir)
    return arrays_as_text(fl.flatten_npi_rates(b, p, i, include_inline=True))


def q_providers_cross_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, _ = _tables(spark, sf_dir)
    return fl.attach_base(p, b, [DOC_KEY, "provider_group_id", "location"]).drop(DOC_KEY)


def _rate_summary(rate: str) -> list:
    prices = F.col(f"{rate}.negotiated_prices")
    refs = F.col(f"{rate}.provider_references")
    return [_size(prices).alias("n_prices"),
            F.array_join(refs, ",").alias("provider_references"),
            F.array_min(F.transform(prices, lambda x: x["negotiated_rate"])).alias("min_rate"),
            F.array_max(F.transform(prices, lambda x: x["negotiated_rate"])).alias("max_rate")]


def q_explode_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, i = _tables(spark, sf_dir)
    r = fl.explode_rates(i)
    return r.select("billing_code", "name", "description", "negotiation_arrangement", *_rate_summary(fl.RATE_COL))


def q_explode_outer_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, i = _tables(spark, sf_dir)
    r = fl.explode_rates(i, keep_empty=True)
    return r.select("billing_code", "name", "description", "negotiation_arrangement", *_rate_summary(fl.RATE_COL))


def q_rename_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 + U6: negotiated_rates exploded in place (NULL-preserving) and renamed."""
    from ..operators.unnest import explode_in_place
    _, _, i = _tables(spark, sf_dir)
    r = explode_in_place(i, "negotiated_rates", fl.RATE_COL)
    return r.select("billing_code", "name", "description", "negotiation_arrangement", *_rate_summary(fl.RATE_COL))


def q_explode_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, i = _tables(spark, sf_dir)
    r = fl.rate_references(i)
    prices = F.col(fl.PRICES_COL)
    return r.select("billing_code", "name", "description", fl.REF_COL,
                    _size(prices).alias("n_prices"),
                    F.array_min(F.transform(prices, lambda x: x["negotiated_rate"])).alias("min_rate"))


def q_struct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + U3: one row per price of each rate element, struct fields aliased."""
    from ..operators.unnest import struct_fields
    _, _, i = _tables(spark, sf_dir)
    r = fl.explode_rates(i)
    p = unnest(r, F.col(f"{fl.RATE_COL}.negotiated_prices"), "price", keep=["billing_code", "name"])
    return arrays_as_text(p.select("billing_code", "name", *struct_fields("price", fl.PRICE_FIELDS)))


def _joined_summary(j: DataFrame) -> DataFrame:
    prices = F.col(fl.PRICES_COL)
    return j.select(*BASE_FIELDS, "provider_group_id", "billing_code", "name", fl.REF_COL,
                    _size(prices).alias("n_prices"),
                    F.array_min(F.transform(prices, lambda x: x["negotiated_rate"])).alias("min_rate"))


def q_join_references_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    return _joined_summary(fl.join_rates_providers(b, p, i))


def q_join_references_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    return _joined_summary(fl.join_rates_providers(b, p, i, keep_unmatched=True))


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _written_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: Q2 written partitioned by code and bucketed by type, read back from the catalog."""
    b, p, i = _tables(spark, sf_dir)
    name = _table_name("rates")
    rates = fl.flatten_rates(b, p, i, cluster_by=layout.by_code)
    with session_conf(spark, layout.PLACED_SIZE):
        layout.write_rates(rates, name, scratch_dir(spark, name), rebalance=None)
    return spark.table(name)


def _written_npi_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    name = _table_name("npi_rates")
    layout.write_npi_rates(fl.flatten_npi_rates(b, p, i), name, scratch_dir(spark, name))
    return spark.table(name)


def _code_files(spark: SparkSession, sf_dir: str) -> str:
    b, p, i = _tables(spark, sf_dir)
    path = scratch_dir(spark, "code_files")
    layout.write_partitions(fl.flatten_rates(b, p, i), path)
    return path


def q_rates_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(_written_rates(spark, sf_dir).select(*RATES_COLUMNS))


def q_npi_bucket_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(_written_npi_rates(spark, sf_dir).select(*NPI_RATES_COLUMNS))


def q_code_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _code_files(spark, sf_dir)
    schema = fl.flatten_rates(*_tables(spark, sf_dir)).schema
    return arrays_as_text(spark.read.schema(schema).parquet(path).select(*RATES_COLUMNS))


def q_external_table_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _code_files(spark, sf_dir)
    t = layout.register_rates(spark, _table_name("rates_external"), path)
    return t.select("billing_code", "negotiated_rate", "description")


def q_batch_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, p, i = _tables(spark, sf_dir)
    root = scratch_dir(spark, "tables")
    write_tables(b, p, i, root, max_records_per_file=1000)
    _, _, i2 = read_tables(spark, root)
    r = fl.explode_rates(i2)
    return r.select("billing_code", "name", "description", "negotiation_arrangement", *_rate_summary(fl.RATE_COL))


def q_rates_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(lookup.rates_by_code(_written_rates(spark, sf_dir), LOOKUP_CODE).select(*RATES_COLUMNS))


def q_rates_by_npi(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _written_npi_rates(spark, sf_dir)
    return arrays_as_text(lookup.rates_by_npi(t, LOOKUP_NPI).select(*NPI_RATES_COLUMNS))


def q_rates_weighted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + K3 with partitions sized by the rows that will be written."""
    b, p, i = _tables(spark, sf_dir)
    name = _table_name("rates_weighted")
    place = layout.by_weight(layout.rate_weights(i), rows_per_slice=20_000)
    layout.write_rates(fl.flatten_rates(b, p, i, cluster_by=place), name, scratch_dir(spark, "rates-weighted"), rebalance=None)
    return arrays_as_text(spark.table(name).select(*RATES_COLUMNS))


def q_npi_weighted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + K4 with partitions sized by the rows that will be written."""
    b, p, i = _tables(spark, sf_dir)
    name = _table_name("npi_weighted")
    place = layout.by_weight(layout.npi_weights(p, i), rows_per_slice=20_000)
    layout.write_npi_rates(fl.flatten_npi_rates(b, p, i, cluster_by=place), name, scratch_dir(spark, "npi-weighted"),
                           rebalance=None)
    return arrays_as_text(spark.table(name).select(*NPI_RATES_COLUMNS))


def q_rates_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: codes that end below 5 are written and registered, the others appended to the table."""
    b, p, i = _tables(spark, sf_dir)
    rates = fl.flatten_rates(b, p, i).select("billing_code", "negotiated_rate", "description")
    low = F.substring("billing_code", -1, 1) < "5"
    path = scratch_dir(spark, "rates-appended")
    layout.write_partitions(rates.where(low), path)
    name = _table_name("rates_appended")
    layout.register_rates(spark, name, path)
    layout.append_rates(name, rates.where(~low))
    return spark.table(name).select("billing_code", "negotiated_rate", "description")


def q_rates_by_code_and_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _written_rates(spark, sf_dir)
    return arrays_as_text(lookup.rates_by_code_and_type(t, LOOKUP_CODE, LOOKUP_TYPE).select(*RATES_COLUMNS))


def q_unknown_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, p, i = _tables(spark, sf_dir)
    out = lookup.unknown_references(p, i)
    return out.select(*[c for c in out.columns if c != DOC_KEY]).withColumn("n_prices", F.col("n_prices").cast("long"))


def q_providers_without_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, p, i = _tables(spark, sf_dir)
    return lookup.providers_without_rates(p, i).select("provider_group_id", "location")


def _codes(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    _, _, i = _tables(spark, sf_dir)
    c = unnest(i, column, "c", keep=["billing_code", "name"])
    return c.select("billing_code", "name", *[F.col(f"c.{f}").alias(f"code_{f}") for f in
                                               ["billing_code_type", "billing_code_type_version", "billing_code",
                                                "description"]])


def q_covered_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(spark, sf_dir, "covered_services")


def q_bundled_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(spark, sf_dir, "bundled_codes")


def q_stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + I1: rows, columns and schema after each stage of Q2, all rows counted by the one job
    that runs Q2 (here into the no-op sink)."""
    b, p, i = _tables(spark, sf_dir)
    counter = StageCounter()
    fl.flatten_rates(b, p, i, counter=counter).write.format("noop").mode("overwrite").save()
    return counter.report(spark)


def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: the counts alone."""
    return q_stage_report(spark, sf_dir).drop("schema")


def q_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: five rate rows, any five: how many there are, and how many are rows of Q2."""
    rates = q_flatten_rates(spark, sf_dir)
    path = scratch_dir(spark, "sample")
    sample_rows(rates, 5).write.parquet(path)
    sample = spark.read.schema(rates.schema).parquet(path).withColumn("n", F.monotonically_increasing_id()).alias("s")
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in rates.columns]
    matches = rates.alias("r").join(F.broadcast(sample), same).agg(F.count_distinct("n").alias("n_found"))
    counts = sample.agg(F.count(F.lit(1)).alias("n_sampled")).unionByName(matches, allowMissingColumns=True)
    return counts.agg(F.sum("n_sampled").alias("n_sampled"), F.sum("n_found").alias("n_found"))


_DOCUMENTS: dict[tuple[str, str, str | None], str] = {}


def _documents(spark: SparkSession, sf_dir: str, faults: str | None = None) -> str:
    """The fixture as raw documents, written once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, faults)
    if key not in _DOCUMENTS:
        _DOCUMENTS[key] = write_fixture_documents(spark, sf_dir, scratch_dir(spark, "documents"), faults)
    return _DOCUMENTS[key]


def _extracted(spark: SparkSession, sf_dir: str, method: str):
    """Q1: the fixture written as gzip JSON documents, then extracted again."""
    return extract(spark, _documents(spark, sf_dir), method)


def _base_out(b: DataFrame) -> DataFrame:
    return b.drop(DOC_KEY)


def _providers_out(p: DataFrame) -> DataFrame:
    groups = F.col("provider_groups")
    return p.select("provider_group_id", "location",
                    F.array_join(flatten_present(F.transform(groups, lambda g: g["npi"])), ",").alias("npis"),
                    F.array_join(F.transform(groups, lambda g: F.concat_ws(":", g["tin"]["type"], g["tin"]["value"])),
                                 ",").alias("tins"))


def _items_out(i: DataFrame) -> DataFrame:
    rates = F.col("negotiated_rates")

    def total(field):
        return F.aggregate(F.transform(rates, lambda r: F.size(r[field]).cast("long")), F.lit(0).cast("long"),
                           lambda a, b: a + b)

    prices = F.flatten(F.transform(rates, lambda r: r["negotiated_prices"]))

    def added(value):
        return F.aggregate(F.transform(prices, lambda p: value(p).cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)

    return i.select("billing_code", "name", "description", _size(rates).alias("n_rates"),
                    total("provider_references").alias("n_refs"), total("negotiated_prices").alias("n_prices"),
                    added(lambda p: F.round(p["negotiated_rate"] * 100)).alias("cents"),
                    added(lambda p: F.array_join(p["service_code"], "")).alias("codes"),
                    added(lambda p: p["negotiated_type"] == "negotiated").alias("n_negotiated"),
                    added(lambda p: p["billing_class"] == "professional").alias("n_professional"),
                    F.array_min(F.transform(prices, lambda p: p["expiration_date"])).alias("first_date"),
                    F.array_max(F.transform(prices, lambda p: p["expiration_date"])).alias("last_date"),
                    code_list_text(F.col("covered_services")).alias("covered_services"))


def _preprocessed(spark: SparkSession, sf_dir: str, method: str):
    """Q1 + K1 + K2 in one pass per document: raw documents to the three tables."""
    root = extract_to_tables(spark, _documents(spark, sf_dir), scratch_dir(spark, f"preprocessed-{method}"), method)
    return read_tables(spark, root)


def q_preprocess_multiline(spark, sf_dir):
    return _items_out(_preprocessed(spark, sf_dir, "multiline")[2])


def q_preprocess_stream(spark, sf_dir):
    return _providers_out(_preprocessed(spark, sf_dir, "stream")[1])


def q_preprocess_direct_flatten(spark, sf_dir):
    return arrays_as_text(fl.flatten_rates(*_preprocessed(spark, sf_dir, "direct"), hash_providers=True))


def q_extract_base(spark, sf_dir):
    return _base_out(_extracted(spark, sf_dir, "multiline")[0])


def q_extract_providers(spark, sf_dir):
    return _providers_out(_extracted(spark, sf_dir, "multiline")[1])


def q_extract_in_network(spark, sf_dir):
    return _items_out(_extracted(spark, sf_dir, "multiline")[2])


def q_extract_base_stream(spark, sf_dir):
    return _base_out(_extracted(spark, sf_dir, "stream")[0])


def q_extract_providers_stream(spark, sf_dir):
    return _providers_out(_extracted(spark, sf_dir, "stream")[1])


def q_extract_in_network_stream(spark, sf_dir):
    return _items_out(_extracted(spark, sf_dir, "stream")[2])


def q_extract_in_network_source(spark, sf_dir):
    """X4 from the Python data source, with its filter on the table pushed down."""
    return _items_out(_extracted(spark, sf_dir, "direct")[2])


def q_extracted_flatten_rates(spark, sf_dir):
    """Q1 then Q2: rates flattened from the raw documents (stream reader). Each
    document joins its own provider list."""
    return arrays_as_text(fl.flatten_rates(*_extracted(spark, sf_dir, "stream"), hash_providers=True))


def q_stream_flatten_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 run by Structured Streaming over the in_network files, read back from the sink."""
    from ..streaming.incremental import stream_rates
    b, p, i = _tables(spark, sf_dir)
    items_path = scratch_dir(spark, "stream-items")
    i.write.option("maxRecordsPerFile", 500).parquet(items_path)
    out = scratch_dir(spark, "stream-rates")
    with session_conf(spark, OPEN_FILES):
        q = stream_rates(spark, items_path, b, p, out, scratch_dir(spark, "stream-checkpoint"))
        q.awaitTermination()
    schema = fl.flatten_rates(b, p, i).schema
    return arrays_as_text(spark.read.schema(schema).parquet(out).select(*RATES_COLUMNS))


def _contract_query(families: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = contract.violations(*dirty_tables(spark, sf_dir))
        return v.where(F.split(F.col("rule"), r"\.").getItem(0).isin(*families))
    return run


CONTRACT_FAMILIES = {
    "contract_required": ["C1"],
    "contract_enums": ["C2", "C3", "C4"],
    "contract_unique": ["C6"],
    "contract_choice": ["C7", "C8", "C10"],
    "contract_patterns": ["C5", "C9"],
    "contract_plan_members": ["C11"],
    "contract_dates": ["C12"],
}


def q_contract_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 on raw documents with fractional ids and rates that are no numbers."""
    path = _documents(spark, sf_dir, "numbers")
    return contract.number_violations(read_documents(spark, path, RAW_DOCUMENT_NUMBERS))


def q_contract_corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are no JSON object (C13) and documents without ``in_network`` (C1)."""
    path = _documents(spark, sf_dir, "documents")
    v = contract.document_violations(read_documents(spark, path, unreadable="drop", members=["in_network"]), unreadable_documents(spark, path))
    return v.withColumns({"key": F.regexp_extract("key", "/doc=([^/]+)/", 1), "value": F.lit(None).cast("string")})


def _plain_prefixes(spark: SparkSession, sf_dir: str, fmt: str, needs: dict):
    """The tables in three plain folders without a document key, read back."""
    paths = []
    for name, df in zip(("base", "providers", "in_network"), _tables(spark, sf_dir)):
        paths.append(scratch_dir(spark, f"plain-{name}"))
        writer = df.drop(DOC_KEY).write.format(fmt)
        if fmt == "json":  # as text the items take about ten times as much disk; a gzip file is one split, so files are kept small
            writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", ITEMS_PER_FILE)
        writer.save(paths[-1])
    return read_prefixes(spark, *paths, needs, fmt)


def q_flatten_rates_plain_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(fl.flatten_rates(*_plain_prefixes(spark, sf_dir, "parquet", RATES_NEEDS)))


def q_flatten_rates_shared_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents in the same three folders, each in a subfolder of its own: items of codes with
    an even last digit belong to one, the rest to the other, and both list all providers."""
    b, p, i = _tables(spark, sf_dir)
    even = F.substring("billing_code", -1, 1).isin("0", "2", "4", "6", "8")
    paths = []
    for name, parts in (("base", (b, b)), ("providers", (p, p)), ("in_network", (i.where(even), i.where(~even)))):
        paths.append(scratch_dir(spark, f"shared-{name}"))
        for document, df in zip(("insurer-a", "insurer-b"), parts):
            df.drop(DOC_KEY).write.parquet(f"{paths[-1]}/{document}")
    tables = read_prefixes(spark, *paths, RATES_NEEDS, document_of_path=r"/(insurer-[^/]+)/[^/]*$")
    return arrays_as_text(fl.flatten_rates(*tables))


def q_npi_rates_json_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrays_as_text(fl.flatten_npi_rates(*_plain_prefixes(spark, sf_dir, "json", NPI_NEEDS), hash_providers=True))


def q_base_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "tables")
    write_tables(*_tables(spark, sf_dir), root, max_records_per_file=1000)
    return _base_out(read_tables(spark, root)[0])


def q_default_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: absent arrays read as []: unsold parts keep one row with zero rates."""
    _, _, i = _tables(spark, sf_dir)
    d = contract.with_default_arrays(i)
    return d.select("billing_code", "name", F.size("negotiated_rates").cast("long").alias("n_rates"),
                    F.size("covered_services").cast("long").alias("n_covered"),
                    F.size("bundled_codes").cast("long").alias("n_bundled"))


SPARK_QUERIES = {
    "flatten_rates": q_flatten_rates,
    "flatten_rates_keep_unmatched": q_flatten_rates_keep_unmatched,
    "flatten_npi_rates": q_flatten_npi_rates,
    "inline_groups": q_inline_groups,
    "providers_cross_base": q_providers_cross_base,
    "explode_rates": q_explode_rates,
    "explode_outer_rates": q_explode_outer_rates,
    "explode_references": q_explode_references,
    "rename_fields": q_rename_fields,
    "struct_fields": q_struct_fields,
    "join_references_right": q_join_references_right,
    "join_references_full": q_join_references_full,
    "stage_counts": q_stage_counts,
    "stage_report": q_stage_report,
    "rates_partition_roundtrip": q_rates_partition_roundtrip,
    "npi_bucket_roundtrip": q_npi_bucket_roundtrip,
    "code_files_roundtrip": q_code_files_roundtrip,
    "external_table_repair": q_external_table_repair,
    "batch_files_roundtrip": q_batch_files_roundtrip,
    "rates_by_code": q_rates_by_code,
    "rates_by_npi": q_rates_by_npi,
    "rates_by_code_and_type": q_rates_by_code_and_type,
    "unknown_references": q_unknown_references,
    "providers_without_rates": q_providers_without_rates,
    "covered_services": q_covered_services,
    "bundled_codes": q_bundled_codes,
    "sample_rows": q_sample_rows,
    "extract_base": q_extract_base,
    "extract_providers": q_extract_providers,
    "extract_in_network": q_extract_in_network,
    "extract_base_stream": q_extract_base_stream,
    "extract_providers_stream": q_extract_providers_stream,
    "extract_in_network_stream": q_extract_in_network_stream,
    "extract_in_network_source": q_extract_in_network_source,
    "extracted_flatten_rates": q_extracted_flatten_rates,
    "preprocess_multiline": q_preprocess_multiline,
    "preprocess_stream": q_preprocess_stream,
    "preprocess_direct_flatten": q_preprocess_direct_flatten,
    **{name: _contract_query(fams) for name, fams in CONTRACT_FAMILIES.items()},
    "contract_numbers": q_contract_numbers,
    "contract_corrupt_documents": q_contract_corrupt_documents,
    "flatten_rates_plain_prefix": q_flatten_rates_plain_prefix,
    "npi_rates_json_prefix": q_npi_rates_json_prefix,
    "flatten_rates_shared_prefix": q_flatten_rates_shared_prefix,
    "rates_weighted_roundtrip": q_rates_weighted_roundtrip,
    "npi_weighted_roundtrip": q_npi_weighted_roundtrip,
    "rates_appended": q_rates_appended,
    "base_files_roundtrip": q_base_files_roundtrip,
    "default_arrays": q_default_arrays,
    "stream_flatten_rates": q_stream_flatten_rates,
}
