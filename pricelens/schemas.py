"""Explicit schemas for every table. Nothing is inferred (see README, "Schemas").

Field names and nesting follow the in-network rate file format. Struct fields
inside arrays are listed in the order a Parquet writer of the raw items produces
(alphabetical inside `negotiated_prices`).
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DecimalType, DoubleType, LongType, StringType,
                               StructField, StructType)

S = StringType()
L = LongType()
D = DoubleType()

# Document key carried by every table, so several documents can be processed at once
# without cross-multiplying their rows.
DOC_KEY = "source_file"

BASE_FIELDS = ["reporting_entity_name", "reporting_entity_type", "last_updated_on", "version"]
PLAN_FIELDS = ["plan_name", "plan_id_type", "plan_id", "plan_market_type"]

BASE = StructType([StructField(f, S) for f in BASE_FIELDS])

TIN = StructType([StructField("type", S), StructField("value", S)])
PROVIDER_GROUP = StructType([StructField("npi", ArrayType(L)), StructField("tin", TIN)])

# provider_references, both dialects: "location" and inline "provider_groups".
PROVIDER_REFERENCE = StructType([
    StructField("provider_group_id", L),
    StructField("location", S),
    StructField("provider_groups", ArrayType(PROVIDER_GROUP)),
])

NEGOTIATED_PRICE = StructType([
    StructField("additional_information", S),
    StructField("billing_class", S),
    StructField("billing_code_modifier", ArrayType(S)),
    StructField("expiration_date", S),
    StructField("negotiated_rate", D),
    StructField("negotiated_type", S),
    StructField("service_code", ArrayType(S)),
])

NEGOTIATED_RATE = StructType([
    StructField("negotiated_prices", ArrayType(NEGOTIATED_PRICE)),
    StructField("provider_references", ArrayType(L)),
    StructField("provider_groups", ArrayType(PROVIDER_GROUP)),
])

CODE = StructType([
    StructField("billing_code_type", S),
    StructField("billing_code_type_version", S),
    StructField("billing_code", S),
    StructField("description", S),
])

IN_NETWORK = StructType([
    StructField("negotiation_arrangement", S),
    StructField("name", S),
    StructField("billing_code_type", S),
    StructField("billing_code_type_version", S),
    StructField("billing_code", S),
    StructField("description", S),
    StructField("negotiated_rates", ArrayType(NEGOTIATED_RATE)),
    StructField("covered_services", ArrayType(CODE)),
    StructField("bundled_codes", ArrayType(CODE)),
])


def with_doc_key(schema: StructType) -> StructType:
    return StructType([StructField(DOC_KEY, S)] + list(schema.fields))


BASE_TABLE = with_doc_key(StructType(list(BASE.fields) + [StructField(f, S) for f in PLAN_FIELDS]))
PROVIDERS_TABLE = with_doc_key(PROVIDER_REFERENCE)
IN_NETWORK_TABLE = with_doc_key(IN_NETWORK)


def raw_document(id_type=L, rate_type=D) -> StructType:
    """Schema of one raw document (one JSON object per file).

    ``id_type``: the reader takes ids as text and converts them itself, because a JSON
    id such as 2.0 read as BIGINT is silently NULL; the contract job takes them as
    DECIMAL(38,10), since 2.5 must be reported, not rounded. ``rate_type`` STRING
    lets the contract job see a rate that is no number.
    """
    provider_group = StructType([StructField("npi", ArrayType(id_type)), StructField("tin", TIN)])
    provider_reference = StructType([
        StructField("provider_group_id", id_type),
        StructField("location", S),
        StructField("provider_groups", ArrayType(provider_group)),
    ])
    price = StructType([f if f.name != "negotiated_rate" else StructField("negotiated_rate", rate_type)
                        for f in NEGOTIATED_PRICE.fields])
    rate = StructType([
        StructField("negotiated_prices", ArrayType(price)),
        StructField("provider_references", ArrayType(id_type)),
        StructField("provider_groups", ArrayType(provider_group)),
    ])
    item = StructType([f if f.name != "negotiated_rates" else StructField("negotiated_rates", ArrayType(rate))
                       for f in IN_NETWORK.fields])
    return StructType(
        [StructField(f, S) for f in BASE_FIELDS + PLAN_FIELDS]
        + [StructField("provider_references", ArrayType(provider_reference)),
           StructField("in_network", ArrayType(item))])


RAW_DOCUMENT_TEXT_IDS = raw_document(S)
RAW_DOCUMENT_DECIMAL_IDS = raw_document(DecimalType(38, 10), S)


def _slim(t, needs: dict):
    """The parts of a type that ``needs`` names, all of a field where it holds an empty dict."""
    if isinstance(t, ArrayType):
        return ArrayType(_slim(t.elementType, needs))
    return StructType([StructField(n, _slim(t[n].dataType, below)) for n, below in needs.items()]) if needs else t


# What the contract job on numbers (C13) looks at.
_NPIS = {"npi": {}}
RAW_DOCUMENT_NUMBERS = _slim(RAW_DOCUMENT_DECIMAL_IDS, {
    "provider_references": {"provider_group_id": {}, "provider_groups": _NPIS},
    "in_network": {"billing_code": {}, "negotiated_rates": {
        "negotiated_prices": {"negotiated_rate": {}}, "provider_references": {}, "provider_groups": _NPIS}}})

# Output column order of the rate table (19 columns).
RATES_COLUMNS = [
    "reporting_entity_name", "reporting_entity_type", "last_updated_on", "version",
    "provider_group_id", "billing_code", "billing_code_type", "billing_code_type_version",
    "description", "name", "additional_information", "billing_class",
    "billing_code_modifier", "expiration_date", "negotiated_rate", "negotiated_type",
    "service_code", "exploded_negotiated_rates_provider_references", "negotiation_arrangement",
]

# Output column order of the NPI rate table (22 columns).
NPI_RATES_COLUMNS = [
    "reporting_entity_name", "reporting_entity_type", "last_updated_on", "version",
    "provider_group_id", "npi", "tin_type", "tin", "billing_code", "billing_code_type",
    "billing_code_type_version", "covered_services", "description", "name",
    "additional_information", "billing_class", "billing_code_modifier", "expiration_date",
    "negotiated_rate", "negotiated_type", "service_code", "negotiation_arrangement",
]

PRICE_FIELDS = [f.name for f in NEGOTIATED_PRICE.fields]
