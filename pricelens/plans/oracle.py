"""Oracle SQL (DuckDB dialect) for the driver queries.

Written independently of the Spark code: instead of building nested arrays and
unnesting them, the oracle derives the same rows straight from lineitem with
DISTINCT sets per rate element, (part, chunk, return flag). The fixed values of
the fixture (header row, offsets, thresholds) are repeated here as literals.
"""

from __future__ import annotations

# Fixed values, equal to those in sources/fixtures.py.
_BASE = "(SELECT min(r_name) FROM region), (SELECT max(r_name) FROM region), '2024-12-01', '1.0.0'"
_FACILITY_OFFSET = 1 << 40
_SHIFTED_OFFSET = 1 << 41

CTES = f"""
li AS (
  SELECT l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_returnflag, l_linestatus, l_shipdate,
         l_orderkey // 1048576 AS chunk
  FROM lineitem),
el_refs AS (SELECT DISTINCT l_partkey, chunk, l_returnflag, l_suppkey AS ref FROM li),
el_prices AS (
  SELECT DISTINCT l_partkey, chunk, l_returnflag,
    CASE WHEN l_linestatus = 'O' THEN 'professional' ELSE 'institutional' END AS billing_class,
    strftime(l_shipdate, '%Y-%m-%d') AS expiration_date,
    l_extendedprice AS negotiated_rate,
    CASE WHEN l_linenumber % 2 = 0 THEN 'negotiated' ELSE 'fee schedule' END AS negotiated_type,
    lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS service_code
  FROM li),
el_price_stats AS (
  SELECT l_partkey, chunk, l_returnflag, count(*) AS n_prices,
         min(negotiated_rate) AS min_rate, max(negotiated_rate) AS max_rate
  FROM el_prices GROUP BY l_partkey, chunk, l_returnflag),
el_ref_list AS (
  SELECT l_partkey, chunk, l_returnflag,
         string_agg(CAST(ref AS VARCHAR), ',' ORDER BY ref) AS provider_references
  FROM el_refs GROUP BY l_partkey, chunk, l_returnflag),
items AS (
  SELECT p_partkey, p_name AS name, p_type AS description, p_size, p_brand,
         lpad(CAST(p_partkey % 50 AS VARCHAR), 5, '0') AS billing_code,
         CASE WHEN p_size <= 10 THEN 'CPT:2024:' || p_brand || ':' || p_type END AS covered_services,
         CASE WHEN p_size >= 45 THEN 'CPT:2024:' || p_brand || ':' || p_type END AS bundled_codes
  FROM part),
unsold AS (SELECT * FROM items WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)),
prov AS (
  SELECT s_suppkey + CASE WHEN s_acctbal < 0 THEN {_SHIFTED_OFFSET} ELSE 0 END AS provider_group_id,
         s_suppkey AS suppkey, s_acctbal,
         'https://providers.example.org/' || CAST(s_suppkey AS VARCHAR) AS location, s_nationkey
  FROM supplier
  UNION ALL
  SELECT s_suppkey + {_FACILITY_OFFSET}, s_suppkey, s_acctbal,
         'https://providers.example.org/facility/' || CAST(s_suppkey AS VARCHAR), s_nationkey
  FROM supplier WHERE s_acctbal >= 9000),
lonely AS (SELECT * FROM prov WHERE provider_group_id NOT IN (SELECT ref FROM el_refs)),
npis AS (
  SELECT provider_group_id, 1000000000 + suppkey * 10 + i AS npi,
         CASE WHEN suppkey % 2 = 0 THEN 'ein' ELSE 'npi' END AS tin_type,
         CAST(suppkey AS VARCHAR) AS tin
  FROM (SELECT *, unnest(range(suppkey % 3)) AS i FROM prov WHERE s_acctbal >= 1000)),
doc_items AS (
  SELECT p_partkey, chunk,
    'doc-' || CAST(p_partkey // 500 AS VARCHAR) || '-' || CAST(greatest(chunk, 0) AS VARCHAR) AS doc
  FROM (SELECT DISTINCT l_partkey AS p_partkey, chunk FROM li UNION ALL SELECT p_partkey, -1 FROM unsold)),
doc_refs AS (
  SELECT DISTINCT d.doc, er.ref FROM el_refs er
  JOIN doc_items d ON d.p_partkey = er.l_partkey AND d.chunk = er.chunk),
rate_rows AS (
  SELECT er.l_partkey, er.chunk, er.l_returnflag, er.ref, ep.billing_class, ep.expiration_date,
         ep.negotiated_rate, ep.negotiated_type, ep.service_code
  FROM el_refs er JOIN el_prices ep
    ON er.l_partkey = ep.l_partkey AND er.chunk = ep.chunk AND er.l_returnflag = ep.l_returnflag)
"""


def _base_cols(present: str) -> str:
    names = ["reporting_entity_name", "reporting_entity_type", "last_updated_on", "version"]
    vals = [v.strip() for v in _BASE.split(",")]
    return ", ".join(f"CASE WHEN {present} THEN {v} END AS {n}" for v, n in zip(vals, names))


def _with(body: str) -> str:
    return f"WITH {CTES}\n{body}"


_Q2_BODY = f"""
SELECT {_base_cols('pr.provider_group_id IS NOT NULL')},
  pr.provider_group_id, it.billing_code, 'CPT' AS billing_code_type, '2024' AS billing_code_type_version,
  it.description, it.name, CAST(NULL AS VARCHAR) AS additional_information, rr.billing_class,
  '' AS billing_code_modifier, rr.expiration_date, rr.negotiated_rate, rr.negotiated_type, rr.service_code,
  rr.ref AS exploded_negotiated_rates_provider_references, 'ffs' AS negotiation_arrangement
FROM rate_rows rr JOIN items it ON it.p_partkey = rr.l_partkey
LEFT JOIN prov pr ON pr.provider_group_id = rr.ref
"""

_Q3_EXTRA = f"""
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, billing_code, 'CPT', '2024', description, name,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ffs'
FROM unsold
UNION ALL
SELECT {_BASE}, provider_group_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM lonely
"""

_Q4_BODY = f"""
SELECT {_base_cols('TRUE')},
  n.provider_group_id, n.npi, n.tin_type, n.tin, it.billing_code, 'CPT' AS billing_code_type,
  '2024' AS billing_code_type_version, it.covered_services, it.description, it.name,
  CAST(NULL AS VARCHAR) AS additional_information, rr.billing_class, '' AS billing_code_modifier,
  rr.expiration_date, rr.negotiated_rate, rr.negotiated_type, rr.service_code,
  'ffs' AS negotiation_arrangement
FROM rate_rows rr JOIN items it ON it.p_partkey = rr.l_partkey
JOIN npis n ON n.provider_group_id = rr.ref
"""

_INLINE = f"""
{_Q4_BODY} WHERE it.p_size <> 17
UNION ALL
SELECT {_base_cols('TRUE')},
  CAST(NULL AS BIGINT), 1000000000 + rr.ref * 10, 'npi', CAST(rr.ref AS VARCHAR), it.billing_code, 'CPT', '2024',
  it.covered_services, it.description, it.name, CAST(NULL AS VARCHAR), rr.billing_class, '', rr.expiration_date,
  rr.negotiated_rate, rr.negotiated_type, rr.service_code, 'ffs'
FROM rate_rows rr JOIN items it ON it.p_partkey = rr.l_partkey WHERE it.p_size = 17
"""

_ELEMENTS = """
SELECT it.billing_code, it.name, it.description, 'ffs' AS negotiation_arrangement,
  ps.n_prices, rl.provider_references, ps.min_rate, ps.max_rate
FROM el_price_stats ps
JOIN el_ref_list rl ON ps.l_partkey = rl.l_partkey AND ps.chunk = rl.chunk AND ps.l_returnflag = rl.l_returnflag
JOIN items it ON it.p_partkey = ps.l_partkey
"""

_REFS = """
SELECT it.billing_code, it.name, it.description, er.ref AS exploded_negotiated_rates_provider_references,
  ps.n_prices, ps.min_rate
FROM el_refs er
JOIN el_price_stats ps ON ps.l_partkey = er.l_partkey AND ps.chunk = er.chunk AND ps.l_returnflag = er.l_returnflag
JOIN items it ON it.p_partkey = er.l_partkey
"""

_JOINED = f"""
SELECT {_base_cols('pr.provider_group_id IS NOT NULL')}, pr.provider_group_id, it.billing_code, it.name,
  er.ref AS exploded_negotiated_rates_provider_references, ps.n_prices, ps.min_rate
FROM el_refs er
JOIN el_price_stats ps ON ps.l_partkey = er.l_partkey AND ps.chunk = er.chunk AND ps.l_returnflag = er.l_returnflag
JOIN items it ON it.p_partkey = er.l_partkey
LEFT JOIN prov pr ON pr.provider_group_id = er.ref
"""

_JOINED_EXTRA = f"""
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, billing_code, name, NULL, NULL, NULL FROM unsold
UNION ALL SELECT {_BASE}, provider_group_id, NULL, NULL, NULL, NULL, NULL FROM lonely
"""

_STAGES = """
SELECT 'base' AS stage, CAST(5 AS BIGINT) AS columns, CAST(1 AS BIGINT) AS rows
UNION ALL SELECT 'provider_references', 2, (SELECT count(*) FROM prov)
UNION ALL SELECT 'providers_with_base', 6, (SELECT count(*) FROM prov)
UNION ALL SELECT 'in_network', 10,
  (SELECT count(*) FROM (SELECT DISTINCT l_partkey, chunk FROM li)) + (SELECT count(*) FROM unsold)
UNION ALL SELECT 'rates_exploded', 8, (SELECT count(*) FROM el_price_stats)
UNION ALL SELECT 'references_exploded', 9, (SELECT count(*) FROM el_refs)
UNION ALL SELECT 'joined', 14, (SELECT count(*) FROM el_refs)
UNION ALL SELECT 'rates', 19, (SELECT count(*) FROM rate_rows)
"""

# The columns of each stage, in order.
_HEADER_TYPES = "reporting_entity_name:string,reporting_entity_type:string,last_updated_on:string,version:string"
_PRICE_TYPES = ("additional_information:string,billing_class:string,billing_code_modifier:array<string>,expiration_date:string,"
                "negotiated_rate:double,negotiated_type:string,service_code:array<string>")
_RATE_TYPES = (f"negotiated_prices:array<struct<{_PRICE_TYPES}>>,provider_references:array<bigint>,"
               "provider_groups:array<struct<npi:array<bigint>,tin:struct<type:string,value:string>>>")
_CODE_TYPES = "billing_code_type:string,billing_code_type_version:string,billing_code:string,description:string"
_ITEM_TYPES = "billing_code:string,billing_code_type:string,billing_code_type_version:string,description:string,name:string"
_PRICES_TYPE = f"exploded_negotiated_rates_negotiated_prices:array<struct<{_PRICE_TYPES}>>"
_REF_TYPE = "exploded_negotiated_rates_provider_references:bigint"
_STAGE_SCHEMAS = {
    "base": f"source_file:string,{_HEADER_TYPES}",
    "provider_references": "source_file:string,provider_group_id:bigint",
    "providers_with_base": f"source_file:string,provider_group_id:bigint,{_HEADER_TYPES}",
    "in_network": f"source_file:string,negotiation_arrangement:string,name:string,{_CODE_TYPES},"
                  f"negotiated_rates:array<struct<{_RATE_TYPES}>>,covered_services:array<struct<{_CODE_TYPES}>>,"
                  f"bundled_codes:array<struct<{_CODE_TYPES}>>",
    "rates_exploded": f"source_file:string,{_ITEM_TYPES},negotiation_arrangement:string,"
                      f"exploded_negotiated_rates:struct<{_RATE_TYPES}>",
    "references_exploded": f"source_file:string,{_ITEM_TYPES},{_PRICES_TYPE},negotiation_arrangement:string,{_REF_TYPE}",
    "joined": f"source_file:string,{_HEADER_TYPES},provider_group_id:bigint,{_ITEM_TYPES},{_PRICES_TYPE},{_REF_TYPE},"
              "negotiation_arrangement:string",
    "rates": f"{_HEADER_TYPES},provider_group_id:bigint,{_ITEM_TYPES},{_PRICE_TYPES},{_REF_TYPE},negotiation_arrangement:string",
}
_STAGE_REPORT = f"""
SELECT s.*, t.schema FROM ({_STAGES}) s
JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in _STAGE_SCHEMAS.items())}) t(stage, schema) ON t.stage = s.stage"""


def _codes_sql(column: str) -> str:
    cond = "p_size <= 10" if column == "covered_services" else "p_size >= 45"
    return _with(f"""
SELECT billing_code, name, 'CPT' AS code_billing_code_type, '2024' AS code_billing_code_type_version,
  p_brand AS code_billing_code, description AS code_description
FROM items WHERE {cond}""")


_LOOKUP_CODE = "'00007'"

_EXTRACT_BASE = f"""
SELECT {_base_cols('TRUE')}, CAST(NULL AS VARCHAR) AS plan_name, CAST(NULL AS VARCHAR) AS plan_id_type,
  CAST(NULL AS VARCHAR) AS plan_id, CAST(NULL AS VARCHAR) AS plan_market_type
FROM (SELECT DISTINCT doc FROM doc_items)"""

_EXTRACT_PROVIDERS = """
SELECT pr.provider_group_id, pr.location,
  CASE WHEN pr.s_acctbal >= 1000 THEN
    array_to_string(list_transform(range(pr.suppkey % 3), lambda i: 1000000000 + pr.suppkey * 10 + i), ',') END AS npis,
  CASE WHEN pr.s_acctbal >= 1000 THEN
    (CASE WHEN pr.suppkey % 2 = 0 THEN 'ein' ELSE 'npi' END) || ':' || CAST(pr.suppkey AS VARCHAR) END AS tins
FROM doc_refs dr JOIN prov pr ON pr.suppkey = dr.ref"""

_EXTRACT_ITEMS = """
SELECT it.billing_code, it.name, it.description, s.n_rates, r.n_refs, CAST(s.n_prices AS BIGINT) AS n_prices,
  p.cents, p.codes, p.n_negotiated, p.n_professional, p.first_date, p.last_date, it.covered_services
FROM (SELECT l_partkey, chunk, count(*) AS n_rates, sum(n_prices) AS n_prices
      FROM el_price_stats GROUP BY l_partkey, chunk) s
JOIN (SELECT l_partkey, chunk, count(*) AS n_refs FROM el_refs GROUP BY l_partkey, chunk) r
  ON r.l_partkey = s.l_partkey AND r.chunk = s.chunk
JOIN (SELECT l_partkey, chunk, CAST(sum(CAST(round(negotiated_rate * 100) AS BIGINT)) AS BIGINT) AS cents,
             CAST(sum(CAST(service_code AS BIGINT)) AS BIGINT) AS codes,
             count(*) FILTER (negotiated_type = 'negotiated') AS n_negotiated,
             count(*) FILTER (billing_class = 'professional') AS n_professional,
             min(expiration_date) AS first_date, max(expiration_date) AS last_date
      FROM el_prices GROUP BY l_partkey, chunk) p ON p.l_partkey = s.l_partkey AND p.chunk = s.chunk
JOIN items it ON it.p_partkey = s.l_partkey
UNION ALL
SELECT billing_code, name, description, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, covered_services
FROM unsold"""

# Contract violations planted by sources.fixtures.dirty_tables.
_ITEM_ROWS = """
item_rows AS (
  SELECT it.billing_code, it.p_size, d.chunk, it.p_partkey,
         d.p_partkey IN (SELECT p_partkey FROM unsold) AS unsold
  FROM doc_items d JOIN items it ON it.p_partkey = d.p_partkey),
dirty_prices AS (
  SELECT it.billing_code, it.p_size, ep.expiration_date
  FROM el_prices ep JOIN items it ON it.p_partkey = ep.l_partkey WHERE it.p_size IN (5, 6, 7, 8, 9, 10, 15, 18)),
dirty_rates AS (
  SELECT it.billing_code, it.p_size FROM el_price_stats ps JOIN items it ON it.p_partkey = ps.l_partkey),
violations AS (
  SELECT 'C2.negotiation_arrangement' AS rule, 'in_network' AS "table", billing_code AS key, 'fee' AS value
  FROM item_rows WHERE p_size = 1
  UNION ALL SELECT 'C3.billing_code_type', 'in_network', billing_code, 'CPT4' FROM item_rows WHERE p_size = 2
  UNION ALL SELECT 'C1.description', 'in_network', billing_code, NULL FROM item_rows WHERE p_size = 3
  UNION ALL SELECT 'C1.negotiated_rates', 'in_network', billing_code, NULL FROM item_rows WHERE unsold
  UNION ALL SELECT 'C7.references_or_groups', 'negotiated_rates', it.billing_code, NULL
    FROM el_price_stats ps JOIN items it ON it.p_partkey = ps.l_partkey WHERE it.p_size = 4
  UNION ALL SELECT 'C3.bundled_codes', 'in_network', billing_code, NULL FROM item_rows WHERE p_size = 11
  UNION ALL SELECT 'C1.covered_services', 'in_network', billing_code, NULL FROM item_rows WHERE p_size = 12
  UNION ALL SELECT 'C6.provider_references', 'negotiated_rates', billing_code, NULL FROM dirty_rates WHERE p_size = 13
  UNION ALL SELECT 'C6.negotiated_prices', 'negotiated_rates', billing_code, NULL FROM dirty_rates WHERE p_size = 14
  UNION ALL SELECT 'C6.npi', 'negotiated_rates', billing_code, '5,5' FROM dirty_rates WHERE p_size = 16
  UNION ALL SELECT 'C4.tin_type', 'negotiated_rates', billing_code, NULL FROM dirty_rates WHERE p_size = 16
  UNION ALL SELECT 'C6.provider_groups', 'negotiated_rates', billing_code, NULL FROM dirty_rates WHERE p_size = 20
  UNION ALL SELECT 'C1.providers', 'negotiated_rates', billing_code, NULL FROM dirty_rates WHERE p_size = 21
  UNION ALL SELECT 'C4.billing_class', 'negotiated_prices', billing_code, 'dental' FROM dirty_prices WHERE p_size = 10
  UNION ALL SELECT 'C10.price_branch', 'negotiated_prices', billing_code, 'dental' FROM dirty_prices WHERE p_size = 10
  UNION ALL SELECT 'C1.negotiated_type', 'negotiated_prices', billing_code, NULL FROM dirty_prices WHERE p_size = 15
  UNION ALL SELECT 'C12.expiration_date', 'negotiated_prices', billing_code, '2024-99-99'
    FROM dirty_prices WHERE p_size = 18
  UNION ALL SELECT 'C4.tin_type', 'provider_references', CAST(provider_group_id AS VARCHAR), NULL
    FROM prov WHERE s_nationkey = 4 AND s_acctbal >= 1000
  UNION ALL SELECT 'C6.provider_groups', 'provider_references', CAST(provider_group_id AS VARCHAR), NULL
    FROM prov WHERE s_nationkey = 5 AND s_acctbal >= 1000
  UNION ALL SELECT 'C12.last_updated_on', 'base', 'fixture', '2024/12/01'
  UNION ALL SELECT 'C10.price_branch', 'negotiated_prices', billing_code, 'both' FROM dirty_prices WHERE p_size = 5
  UNION ALL SELECT 'C4.negotiated_type', 'negotiated_prices', billing_code, 'flat' FROM dirty_prices WHERE p_size = 6
  UNION ALL SELECT 'C5.service_code', 'negotiated_prices', billing_code, '00' FROM dirty_prices WHERE p_size = 7
  UNION ALL SELECT 'C12.expiration_date', 'negotiated_prices', billing_code, replace(expiration_date, '-', '/')
    FROM dirty_prices WHERE p_size = 8
  UNION ALL SELECT 'C6.billing_code_modifier', 'negotiated_prices', billing_code, '25,25' FROM dirty_prices WHERE p_size = 9
  UNION ALL SELECT 'C9.location', 'provider_references', CAST(provider_group_id AS VARCHAR),
    replace(location, 'https://', 'http://') FROM prov WHERE s_nationkey = 0
  UNION ALL SELECT 'C8.location_or_groups', 'provider_references', CAST(provider_group_id AS VARCHAR), NULL
    FROM prov WHERE s_nationkey = 1 AND s_acctbal < 1000
  UNION ALL SELECT 'C6.npi', 'provider_references', CAST(provider_group_id AS VARCHAR),
    array_to_string(list_concat(n, n), ',')
    FROM (SELECT provider_group_id, list_transform(range(suppkey % 3), lambda i: 1000000000 + suppkey * 10 + i) AS n
          FROM prov WHERE s_nationkey = 3 AND s_acctbal >= 1000 AND suppkey % 3 > 0)
  UNION ALL SELECT 'C11.plan_members', 'base', 'fixture', '2'
  UNION ALL SELECT 'C4.plan_market_type', 'base', 'fixture', 'small')
"""


def _contract(families: list[str]) -> str:
    cond = " OR ".join(f"split_part(rule, '.', 1) = '{f}'" for f in families)
    return f"WITH {CTES},{_ITEM_ROWS}SELECT rule, \"table\", key, value FROM violations WHERE {cond}"


CONTRACT_FAMILIES = {
    "contract_required": ["C1"],
    "contract_enums": ["C2", "C3", "C4"],
    "contract_unique": ["C6"],
    "contract_choice": ["C7", "C8", "C10"],
    "contract_patterns": ["C5", "C9"],
    "contract_plan_members": ["C11"],
    "contract_dates": ["C12"],
}

_NUMBERS = """
SELECT 'C13.provider_group_id' AS rule, 'provider_references' AS "table",
  CAST(CAST(pr.provider_group_id + 0.5 AS DECIMAL(38, 10)) AS VARCHAR) AS key,
  CAST(CAST(pr.provider_group_id + 0.5 AS DECIMAL(38, 10)) AS VARCHAR) AS value
FROM doc_refs dr JOIN prov pr ON pr.suppkey = dr.ref WHERE pr.s_nationkey = 2
UNION ALL
SELECT 'C13.npi', 'provider_references', CAST(CAST(pr.provider_group_id AS DECIMAL(38, 10)) AS VARCHAR),
  CAST(CAST(1000000000 + pr.suppkey * 10 + 0.5 AS DECIMAL(38, 10)) AS VARCHAR)
FROM doc_refs dr JOIN prov pr ON pr.suppkey = dr.ref
WHERE pr.s_nationkey = 4 AND pr.s_acctbal >= 1000 AND pr.suppkey % 3 > 0
UNION ALL
SELECT 'C13.negotiated_rate', 'negotiated_prices', it.billing_code, 'x'
FROM el_prices ep JOIN items it ON it.p_partkey = ep.l_partkey WHERE it.p_size = 21
UNION ALL
SELECT 'C13.provider_references', 'negotiated_rates', any_value(it.billing_code),
  CAST(CAST(min(er.ref) + 0.5 AS DECIMAL(38, 10)) AS VARCHAR)
FROM el_refs er JOIN items it ON it.p_partkey = er.l_partkey WHERE it.p_size = 22
GROUP BY er.l_partkey, er.chunk, er.l_returnflag
UNION ALL
SELECT 'C13.npi', 'negotiated_rates', it.billing_code, '7.5000000000'
FROM el_price_stats ps JOIN items it ON it.p_partkey = ps.l_partkey WHERE it.p_size = 23"""

_CORRUPT = """
SELECT CASE WHEN block % 2 = 0 THEN 'C13.document' ELSE 'C1.in_network' END AS rule, 'document' AS "table",
  doc AS key, CAST(NULL AS VARCHAR) AS value
FROM (SELECT DISTINCT doc, CAST(split_part(doc, '-', 2) AS BIGINT) AS block FROM doc_items)
WHERE block % 2 = 0 OR block % 4 = 1"""

ORACLE_SQL = {
    "flatten_rates": _with(_Q2_BODY),
    "flatten_rates_keep_unmatched": _with(_Q2_BODY + _Q3_EXTRA),
    "flatten_npi_rates": _with(_Q4_BODY),
    "inline_groups": _with(_INLINE),
    "providers_cross_base": _with(f"SELECT provider_group_id, location, {_base_cols('TRUE')} FROM prov"),
    "explode_rates": _with(_ELEMENTS),
    "explode_outer_rates": _with(_ELEMENTS + """
UNION ALL SELECT billing_code, name, description, 'ffs', NULL, NULL, NULL, NULL FROM unsold"""),
    "rename_fields": _with(_ELEMENTS + """
UNION ALL SELECT billing_code, name, description, 'ffs', NULL, NULL, NULL, NULL FROM unsold"""),
    "explode_references": _with(_REFS),
    "struct_fields": _with("""
SELECT it.billing_code, it.name, CAST(NULL AS VARCHAR) AS additional_information, ep.billing_class,
  '' AS billing_code_modifier, ep.expiration_date, ep.negotiated_rate, ep.negotiated_type, ep.service_code
FROM el_prices ep JOIN items it ON it.p_partkey = ep.l_partkey"""),
    "join_references_right": _with(_JOINED),
    "join_references_full": _with(_JOINED + _JOINED_EXTRA),
    "stage_counts": _with(_STAGES),
    "stage_report": _with(_STAGE_REPORT),
    "rates_partition_roundtrip": _with(_Q2_BODY),
    "npi_bucket_roundtrip": _with(_Q4_BODY),
    "code_files_roundtrip": _with(_Q2_BODY),
    "external_table_repair": _with(f"SELECT billing_code, negotiated_rate, description FROM ({_Q2_BODY})"),
    "batch_files_roundtrip": _with(_ELEMENTS),
    "rates_by_code": _with(f"SELECT * FROM ({_Q2_BODY}) WHERE billing_code = {_LOOKUP_CODE}"),
    "rates_by_npi": _with(f"SELECT * FROM ({_Q4_BODY}) WHERE npi = 1000000021"),
    "rates_by_code_and_type": _with(
        f"SELECT * FROM ({_Q2_BODY}) WHERE billing_code = {_LOOKUP_CODE} AND negotiated_type = 'negotiated'"),
    "unknown_references": _with("""
SELECT it.billing_code, 'CPT' AS billing_code_type, '2024' AS billing_code_type_version, it.description, it.name,
  er.ref AS exploded_negotiated_rates_provider_references, ps.n_prices
FROM el_refs er
JOIN el_price_stats ps ON ps.l_partkey = er.l_partkey AND ps.chunk = er.chunk AND ps.l_returnflag = er.l_returnflag
JOIN items it ON it.p_partkey = er.l_partkey
WHERE er.ref NOT IN (SELECT provider_group_id FROM prov)"""),
    "providers_without_rates": _with("SELECT provider_group_id, location FROM lonely"),
    "covered_services": _codes_sql("covered_services"),
    "extract_base": _with(_EXTRACT_BASE),
    "extract_providers": _with(_EXTRACT_PROVIDERS),
    "extract_in_network": _with(_EXTRACT_ITEMS),
    "extract_in_network_source": _with(_EXTRACT_ITEMS),
    "extract_base_stream": _with(_EXTRACT_BASE),
    "extract_providers_stream": _with(_EXTRACT_PROVIDERS),
    "extract_in_network_stream": _with(_EXTRACT_ITEMS),
    "extracted_flatten_rates": _with(_Q2_BODY),
    "preprocess_multiline": _with(_EXTRACT_ITEMS),
    "preprocess_stream": _with(_EXTRACT_PROVIDERS),
    "preprocess_direct_flatten": _with(_Q2_BODY),
    **{name: _contract(fams) for name, fams in CONTRACT_FAMILIES.items()},
    "contract_numbers": _with(_NUMBERS),
    "contract_corrupt_documents": _with(_CORRUPT),
    "flatten_rates_plain_prefix": _with(_Q2_BODY),
    "npi_rates_json_prefix": _with(_Q4_BODY),
    "flatten_rates_shared_prefix": _with(_Q2_BODY),
    "rates_weighted_roundtrip": _with(_Q2_BODY),
    "npi_weighted_roundtrip": _with(_Q4_BODY),
    "rates_appended": _with(f"SELECT billing_code, negotiated_rate, description FROM ({_Q2_BODY})"),
    "base_files_roundtrip": _with(f"""
SELECT {_base_cols('TRUE')}, CAST(NULL AS VARCHAR) AS plan_name, CAST(NULL AS VARCHAR) AS plan_id_type,
  CAST(NULL AS VARCHAR) AS plan_id, CAST(NULL AS VARCHAR) AS plan_market_type"""),
    "sample_rows": _with(f"""
SELECT least(5, count(*)) AS n_sampled, least(5, count(*)) AS n_found FROM ({_Q2_BODY})"""),
    "stream_flatten_rates": _with(_Q2_BODY),
    "default_arrays": _with("""
SELECT it.billing_code, it.name, coalesce(s.n_rates, 0) AS n_rates,
  CAST(CASE WHEN it.p_size <= 10 THEN 1 ELSE 0 END AS BIGINT) AS n_covered,
  CAST(CASE WHEN it.p_size >= 45 THEN 1 ELSE 0 END AS BIGINT) AS n_bundled
FROM doc_items d JOIN items it ON it.p_partkey = d.p_partkey
LEFT JOIN (SELECT l_partkey, chunk, count(*) AS n_rates FROM el_price_stats GROUP BY l_partkey, chunk) s
  ON s.l_partkey = d.p_partkey AND s.chunk = d.chunk"""),
    "bundled_codes": _codes_sql("bundled_codes"),
}
