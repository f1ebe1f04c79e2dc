"""Nested rate tables derived from the driver's flat tables (supplier, part, lineitem).

The real input is one JSON document per insurer plan. The test data is a
TPC-H-like star schema, so the three nested tables are built from it:

* ``base``: one header row for the single document ``fixture``; the entity is named after
  the first and last region.
* ``provider_references``: one provider group per supplier. Suppliers with a negative
  balance publish it under a shifted id, so rates that refer to them have an unknown
  reference and the group is unused. Suppliers with a balance of 9,000 or more also
  publish a facility group that no rate refers to.
  Suppliers with a balance under 1,000 publish a location only (no inline
  groups); the others one group with 0 to 2 NPIs and a tin.
* ``in_network``: one item per part; one ``negotiated_rates`` element per
  (part, return flag) with the distinct suppliers as references and the distinct
  prices; NULL rates for a part never sold.

A part's sales are split into several items by ranges of ``ORDER_SPAN`` order keys
(the same rule for every part, whatever its rows), so no nested array (and no group of
the aggregation building it) grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixture_text
from ..operators.unnest import flatten_present
from ..plans.joins import bounded_broadcast, plan_bytes
from ..schemas import BASE_FIELDS, BASE_TABLE, DOC_KEY, IN_NETWORK_TABLE, PLAN_FIELDS, PROVIDERS_TABLE

# Fixed values of the fixture (not derived from data).
FIXTURE_DOC = "fixture"
UPDATED_ON, VERSION = "2024-12-01", "1.0.0"
LOCATION_PREFIX = "https://providers.example.org/"
FACILITY_OFFSET = 1 << 40          # provider_group_id of a supplier's facility group
SHIFTED_OFFSET = 1 << 41           # added to the group id of a supplier with a negative balance
NPI_BASE = 1_000_000_000           # npi = NPI_BASE + suppkey * 10 + i
ORDER_SPAN = 1 << 20
PARTS_PER_DOCUMENT = 500
SALES_PER_TASK = 16 << 20           # bytes of lineitem's files; JSON text of them has about ten times as many
PROVIDER, ITEM = 0, 1               # order of a document's rows


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = read_table(spark, sf_dir, "region").agg(F.min("r_name").alias("first"), F.max("r_name").alias("last"))
    header = [F.col("first"), F.col("last"), F.lit(UPDATED_ON), F.lit(VERSION)]
    return row.select(F.lit(FIXTURE_DOC).alias(DOC_KEY), *[v.alias(n) for v, n in zip(header, BASE_FIELDS)],
                      *[F.lit(None).cast("string").alias(n) for n in PLAN_FIELDS])


def _supplier_groups(key: Column, bal: Column) -> Column:
    npis = F.transform(F.filter(F.sequence(F.lit(0), F.lit(2)), lambda i: i < F.pmod(key, F.lit(3))),
                       lambda i: F.lit(NPI_BASE) + key * 10 + i)
    tin = F.struct(F.when(F.pmod(key, F.lit(2)) == 0, "ein").otherwise("npi").alias("type"),
                   key.cast("string").alias("value"))
    return F.when(bal < 1000, F.lit(None)).otherwise(F.array(F.struct(npis.alias("npi"), tin.alias("tin"))))


def fixture_providers(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    """``keep_keys`` also returns ``s_suppkey`` and ``s_nationkey``."""
    s = read_table(spark, sf_dir, "supplier")
    key, bal = F.col("s_suppkey"), F.col("s_acctbal")
    kinds = F.when(bal >= 9000, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    s = s.select(key, bal, "s_nationkey", F.explode(kinds).alias("kind"))
    facility = F.col("kind") == 1
    return s.select(
        F.lit(FIXTURE_DOC).alias(DOC_KEY),
        F.when(facility, key + F.lit(FACILITY_OFFSET)).when(bal < 0, key + F.lit(SHIFTED_OFFSET)).otherwise(key)
         .alias("provider_group_id"),
        F.concat(F.lit(LOCATION_PREFIX), F.when(facility, F.lit("facility/")).otherwise(F.lit("")),
                 key.cast("string")).alias("location"),
        _supplier_groups(key, bal).alias("provider_groups"),
        "s_suppkey", "s_nationkey",
    ).select(*[F.col(f.name).cast(f.dataType) for f in PROVIDERS_TABLE.fields],
             *(["s_suppkey", "s_nationkey"] if keep_keys else []))


def price_struct() -> Column:
    """One negotiated price from a lineitem row."""
    return F.struct(
        F.lit(None).cast("string").alias("additional_information"),
        F.when(F.col("l_linestatus") == "O", "professional").otherwise("institutional").alias("billing_class"),
        F.array().cast("array<string>").alias("billing_code_modifier"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("expiration_date"),
        F.col("l_extendedprice").alias("negotiated_rate"),
        F.when(F.pmod("l_linenumber", F.lit(2)) == 0, "negotiated").otherwise("fee schedule").alias("negotiated_type"),
        F.array(F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("service_code"),
    )


def item_chunk(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    """Adds ``chunk``, the order-key range: one rule for every part."""
    return lineitem.withColumn("chunk", F.expr(f"l_orderkey div {ORDER_SPAN}").cast("long"))


def _spread(df: DataFrame, key: str, sales: DataFrame) -> DataFrame:
    """``df`` by ``key``: in the session's number of shuffle partitions, which AQE may merge, or in more of them
    where ``sales`` has more than that many times ``SALES_PER_TASK``, so a task's rows stay within memory."""
    tasks = -(-plan_bytes(sales) // SALES_PER_TASK)
    return df.repartition(tasks, key) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(key)


def fixture_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part sold and chunk: (l_partkey, chunk, negotiated_rates).

    Sales are shuffled once, as the few narrow columns of their table, by the key that both the grouping
    and the join with the parts ask for; nested rows are never shuffled."""
    sales = read_table(spark, sf_dir, "lineitem")
    li = sales.select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    li = _spread(item_chunk(spark, li).drop("l_orderkey"), "l_partkey", sales)
    sets = li.groupBy("l_partkey", "chunk", "l_returnflag").agg(
        F.sort_array(F.collect_set(price_struct())).alias("negotiated_prices"),
        F.sort_array(F.collect_set("l_suppkey")).alias("provider_references"))
    groups_t = IN_NETWORK_TABLE["negotiated_rates"].dataType.elementType["provider_groups"].dataType
    rate = F.struct("negotiated_prices", "provider_references", F.lit(None).cast(groups_t).alias("provider_groups"))
    flags = F.sort_array(F.collect_list(F.struct("l_returnflag", rate.alias("rate"))))  # each flag once
    return sets.groupBy("l_partkey", "chunk").agg(flags.alias("rates")).select(
        "l_partkey", "chunk", F.col("rates.rate").alias("negotiated_rates"))


def _code_list(when: Column) -> Column:
    code = F.struct(F.lit("CPT").alias("billing_code_type"), F.lit("2024").alias("billing_code_type_version"),
                    F.col("p_brand").alias("billing_code"), F.col("p_type").alias("description"))
    return F.when(when, F.array(code))


def billing_code(partkey: Column) -> Column:
    return F.lpad(F.pmod(partkey, F.lit(50)).cast("string"), 5, "0")


def fixture_in_network(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    """``keep_keys`` also returns ``p_partkey``, ``chunk`` (NULL for an unsold part) and ``p_size``."""
    items = fixture_rates(spark, sf_dir)
    # The parts are the hashed side, so the nested rows are neither sorted nor shuffled for the join.
    part = read_table(spark, sf_dir, "part").hint("shuffle_hash")
    joined = part.join(items, part.p_partkey == items.l_partkey, "left")
    return joined.select(*_item_columns(F.col("negotiated_rates")),
                         *([F.col("p_partkey"), F.col("chunk"), F.col("p_size")] if keep_keys else []))


def _item_columns(rates: Column) -> list[Column]:
    """The in_network columns of a row of ``part``."""
    values = {
        DOC_KEY: F.lit(FIXTURE_DOC),
        "negotiation_arrangement": F.lit("ffs"),
        "name": F.col("p_name"),
        "billing_code_type": F.lit("CPT"),
        "billing_code_type_version": F.lit("2024"),
        "billing_code": billing_code(F.col("p_partkey")),
        "description": F.col("p_type"),
        "negotiated_rates": rates,
        "covered_services": _code_list(F.col("p_size") <= 10),
        "bundled_codes": _code_list(F.col("p_size") >= 45),
    }
    return [values[f.name].cast(f.dataType).alias(f.name) for f in IN_NETWORK_TABLE.fields]


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, chunk, p_size, json): the rows of ``fixture_in_network`` as JSON text.

    Parts and sales are shuffled once, together, as narrow rows; each task sorts them and joins the texts of
    prices and references batch by batch, so no nested row is built, hashed or sorted."""
    sales = read_table(spark, sf_dir, "lineitem")
    li = item_chunk(spark, sales.where(F.col("l_partkey").isNotNull())).select(
        F.col("l_partkey").cast("long").alias("key"), F.lit(True).alias("sale"), "chunk",
        F.col("l_returnflag").alias("flag"), F.col("l_suppkey").cast("long").alias("supplier"),
        "l_linenumber", "l_extendedprice", "l_linestatus", "l_shipdate")
    part = read_table(spark, sf_dir, "part")
    head = F.struct(*[c for c, f in zip(_item_columns(F.lit(None)), IN_NETWORK_TABLE.fields) if f.name != DOC_KEY])
    part = part.select(F.col("p_partkey").cast("long").alias("key"), F.lit(False).alias("sale"),
                       F.to_json(head).alias("head"), F.col("p_size").cast("int").alias("p_size"))
    rows = _spread(li.unionByName(part, allowMissingColumns=True), "key", sales)
    # What ``price_struct`` is made of, in its order: of equal prices, each stands next to its copies.
    rate, day = F.col("l_extendedprice").cast("double"), F.to_date("l_shipdate")
    far = ~day.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    rows = rows.select("key", "sale", "chunk", "flag", "supplier", "head", "p_size", *[v.alias(n) for n, v in {
        "professional": F.coalesce(F.col("l_linestatus") == "O", F.lit(False)), "day": day, "rate": rate,
        "minus_zero": F.when(rate == 0, rate.cast("string").startswith("-")).otherwise(F.lit(False)),
        "negotiated": F.coalesce(F.pmod("l_linenumber", F.lit(2)) == 0, F.lit(False)),
        "code": F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
        "far_day": F.when(far, F.date_format("l_shipdate", "yyyy-MM-dd"))}.items()])
    rows = rows.sortWithinPartitions("key", "sale", "chunk", "flag", "professional", "day", "rate", "negotiated", "code", "minus_zero")
    found = rows.mapInArrow(fixture_text.items, fixture_text.COLUMNS)
    with_rates = F.concat(F.expr("substr(head, 1, length(head) - 1)"), F.lit(',"negotiated_rates":['), "rates", F.lit("]}"))
    return found.select("p_partkey", "chunk", "p_size", F.coalesce(with_rates, "head").alias("json"))


def fixture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, provider_references, in_network) for the test data set at ``sf_dir``."""
    return fixture_base(spark, sf_dir), fixture_providers(spark, sf_dir), fixture_in_network(spark, sf_dir)


def document_key(partkey: Column, chunk: Column) -> Column:
    """Raw documents hold the items of ``PARTS_PER_DOCUMENT`` consecutive parts;
    each order-key chunk of them is a document of its own, so documents stay bounded."""
    return document_name(F.expr(f"p_partkey div {PARTS_PER_DOCUMENT}"), F.coalesce(chunk, F.lit(0)))


def document_name(block: Column, chunk: Column) -> Column:
    return F.concat(F.lit("doc-"), block.cast("string"), F.lit("-"), chunk.cast("string"))


def _with_bad_numbers(json: Column, places: list[tuple[Column, str, str]]) -> Column:
    for where, pattern, replacement in places:
        json = F.when(where, F.regexp_replace(json, pattern, replacement)).otherwise(json)
    return json


def write_fixture_documents(spark: SparkSession, sf_dir: str, path: str, faults: str | None = None) -> str:
    """The fixture as raw rate documents: gzip JSON files ``path/doc=<key>/*.txt.gz``,
    one JSON object per file with the header, all groups of the suppliers its rates refer
    to, and its items. A document's items and groups are rows of their own until they are written, one
    to a line: they are shuffled once, by document, and no task holds a document.

    ``faults`` plants violations only raw JSON can carry. ``"numbers"`` (C13): group ids of
    nation 2 and first npis of nation 4 end in ``.5``; of items by part size, 22 has the
    first reference of each rate ending in ``.5``, 23 an inline group with npi 7.5 instead
    of references, 21 rates of ``"x"``. ``"documents"``: documents of blocks of parts
    0, 6, 8, 14, ... are cut short, in those of blocks 2, 10, ... a second document follows and in
    those of blocks 4, 12, ... some text (C13), those of blocks 1, 5, 9, ... have no ``in_network`` (C1)."""
    base = fixture_base(spark, sf_dir)
    providers = fixture_providers(spark, sf_dir, keep_keys=True)
    items = document_items(spark, sf_dir).withColumn("doc", document_key(F.col("p_partkey"), F.col("chunk")))
    item_json = F.col("json")
    if faults == "numbers":
        size = F.col("p_size")
        item_json = _with_bad_numbers(item_json, [
            (size == 21, r'"negotiated_rate":[^,}]+', '"negotiated_rate":"x"'),
            (size == 22, r'"provider_references":\[([0-9]+)', '"provider_references":[$1.5'),
            (size == 23, r'"provider_references":\[[^\]]*\]',
             '"provider_groups":[{"npi":[7.5],"tin":{"type":"ein","value":"1"}}]')])
    prov_json = F.to_json(F.struct("provider_group_id", "location", "provider_groups"))
    if faults == "numbers":
        nation = F.col("s_nationkey")
        prov_json = _with_bad_numbers(prov_json, [
            (nation == 2, r'^\{"provider_group_id":([0-9]+)', '{"provider_group_id":$1.5'),
            (nation == 4, r'"npi":\[([0-9]+)', '"npi":[$1.5')])
    refs = _document_references(spark, sf_dir)
    texts = providers.select("s_suppkey", prov_json.alias("json"))
    prov = refs.join(texts, refs.ref == texts.s_suppkey)
    rows = prov.select("doc", F.lit(PROVIDER).alias("section"), "json").unionByName(
        items.select("doc", F.lit(ITEM).alias("section"), item_json.alias("json")))
    # The partition value that NULL is written as: a column without NULLs keeps its order in the write.
    rows = rows.withColumn("doc", F.coalesce("doc", F.lit("__HIVE_DEFAULT_PARTITION__")))
    rows = _spread(rows, "doc", read_table(spark, sf_dir, "lineitem"))
    header = base.select(F.regexp_replace(F.to_json(F.struct(*BASE_FIELDS, *PLAN_FIELDS)), r"^\{|\}$", "").alias("header"))
    lines = _document_lines(rows.withColumn("header", F.lit(header.first()[0])), faults == "documents")
    (lines.write.mode("overwrite").partitionBy("doc")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))
    return path


def _document_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, ref): the suppliers that the items of each document refer to."""
    parts = read_table(spark, sf_dir, "part").select("p_partkey").where(F.col("p_partkey").isNotNull()).distinct()
    sales = item_chunk(spark, read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey"))
    sold = sales.join(bounded_broadcast(parts), F.col("l_partkey") == F.col("p_partkey"))
    found = sold.where(F.col("l_suppkey").isNotNull()).select(
        F.expr(f"p_partkey div {PARTS_PER_DOCUMENT}").alias("block"), F.coalesce("chunk", F.lit(0)).alias("chunk"),
        F.col("l_suppkey").alias("ref")).distinct()  # as numbers, before names are made of them
    return found.select(document_name(F.col("block"), F.col("chunk")).alias("doc"), "ref")


def _document_lines(rows: DataFrame, faulty: bool) -> DataFrame:
    """(doc, value): the lines of each document, in order, from its (doc, section, json, header) rows.

    Every document has items, so its last row is one. With ``faulty`` the ones of some blocks are
    not whole (see ``write_fixture_documents``)."""
    copies, ending, no_items = F.array(F.lit(0)), F.lit("]}"), F.lit(False)
    if faulty:
        block = F.regexp_extract("doc", r"^doc-([0-9]+)-", 1).try_cast("long")
        copies = F.when(block % 8 == 2, F.array(F.lit(0), F.lit(1))).otherwise(copies)
        ending = (F.when(block % 8 == 2, ending).when(block % 8 == 4, F.lit("]} trailing text"))
                  .when(block % 2 == 0, F.lit("")).otherwise(ending))
        no_items = F.coalesce(block % 4 == 1, F.lit(False))
    rows = rows.select("*", F.explode(copies).alias("copy"))
    order = Window.partitionBy("doc").orderBy("copy", "section", "json")
    rows = rows.select("*", *[f.over(order).alias(n) for n, f in (
        ("before", F.lag("section")), ("copy_before", F.lag("copy")), ("copy_after", F.lead("copy")))])
    is_item = F.col("section") == ITEM
    first = ~F.col("copy_before").eqNullSafe(F.col("copy"))
    first_item = is_item & (first | (F.col("before") != ITEM))
    last = ~F.col("copy_after").eqNullSafe(F.col("copy"))
    opening = F.when(first, F.concat(F.lit("{"), "header", F.lit(',"provider_references":['))).otherwise(F.lit(""))
    border = F.when(first_item, F.lit('],"in_network":[')).when(first, F.lit("")).otherwise(F.lit(","))
    line = F.concat(opening, border, "json", F.when(last, ending).otherwise(F.lit("")))
    without = F.when(is_item, F.concat(opening, F.lit("]}"))).otherwise(F.concat(opening, border, "json"))
    return rows.where(~no_items | ~is_item | first_item).select("doc", F.when(no_items, without).otherwise(line).alias("value"))


def write_large_document(spark: SparkSession, sf_dir: str, path: str, copies: int = 5) -> int:
    """The fixture as one uncompressed rate document, ``path/part-*.txt``, of many small items: each
    rate element is an item of its own, ``copies`` times over. Returns the number of items.

    Lines are written in order by one task, as a document is one file."""
    items = fixture_in_network(spark, sf_dir).select(
        *[f.name for f in IN_NETWORK_TABLE.fields if f.name not in (DOC_KEY, "negotiated_rates")],
        F.explode("negotiated_rates").alias("rate"), F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    item = F.struct(*[F.array("rate").alias(f.name) if f.name == "negotiated_rates" else F.col(f.name)
                      for f in IN_NETWORK_TABLE.fields if f.name != DOC_KEY])
    provider = F.struct("provider_group_id", "location", "provider_groups")
    header = F.regexp_replace(F.to_json(F.struct(*BASE_FIELDS)), r"\}$", "")

    def section(df: DataFrame, number: int, text: Column) -> DataFrame:
        return df.select(F.lit(number).alias("section"), text.alias("value"))

    def elements(df: DataFrame, number: int, value: Column) -> DataFrame:
        return section(df, number, F.concat(F.to_json(value), F.lit(",")))

    base = fixture_base(spark, sf_dir)
    last = F.to_json(F.struct(F.lit("last").alias("billing_code")))
    lines = section(base, 0, F.concat(header, F.lit(',"provider_references":[')))
    lines = lines.unionByName(elements(fixture_providers(spark, sf_dir), 1, provider))
    lines = lines.unionByName(section(base, 2, F.lit('{}],"in_network":[')))
    lines = lines.unionByName(elements(items, 3, item))
    lines = lines.unionByName(section(base, 4, F.concat(last, F.lit("]}"))))
    lines.repartition(1).sortWithinPartitions("section").select("value").write.text(path)
    return items.count() + 1


def dirty_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The fixture with contract violations planted by data attributes:

    items by part size: 1 arrangement ``fee`` (C2), 2 code type ``CPT4`` (C3),
    3 no description (C1), 4 rates with both references and groups (C7),
    5 prices billed ``both`` (C10), 6 type ``flat`` (C4), 7 service code ``00``
    (C5), 8 dates with ``/`` (C12), 9 modifier ``25`` twice (C6), 10 prices billed
    ``dental`` (C4, C10), 11 bundled code type ``CPT4`` (C3), 12 covered service without
    description (C1), 13 every reference twice (C6), 14 every price twice (C6), 15 prices
    without type (C1), 16 inline groups with npi 5 twice and tin type ``zzz`` (C6, C4),
    18 dates ``2024-99-99`` (C12), 20 one inline group twice (C6), 21 inline groups
    without tin (C1);
    providers by supplier nation: 0 ``http://`` location (C9), 1 no location
    (C8 where no groups), 3 every npi twice (C6), 4 tin type ``ssn`` (C4), 5 every group
    twice (C6); the header has 2 of the 4 plan members (C11), market type ``small`` (C4)
    and a date with ``/`` (C12).
    """
    size = F.col("p_size")
    i = fixture_in_network(spark, sf_dir, keep_keys=True)
    groups_t = IN_NETWORK_TABLE["negotiated_rates"].dataType.elementType["provider_groups"].dataType

    def prices_with(field, value):
        return F.transform("negotiated_rates", lambda r: r.withField(
            "negotiated_prices", F.transform(r["negotiated_prices"], lambda p: p.withField(field, value(p)))))

    def rates_with(field, value):
        return F.transform("negotiated_rates", lambda r: r.withField(field, value(r)))

    def inline(npis, tin, times=1):
        tin = F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(tin, ("type", "value"))]) if tin else F.lit(None)
        group = F.struct(F.array(*[F.lit(n) for n in npis]).alias("npi"), tin.alias("tin"))
        groups = F.array(*[group] * times).cast(groups_t)
        return F.transform("negotiated_rates", lambda r: r.withField("provider_groups", groups).withField(
            "provider_references", F.lit(None).cast("array<bigint>")))

    rates = (F.when(size == 4, F.transform("negotiated_rates",
                                            lambda r: r.withField("provider_groups", F.array().cast(groups_t))))
             .when(size == 5, prices_with("billing_class", lambda p: F.lit("both")))
             .when(size == 6, prices_with("negotiated_type", lambda p: F.lit("flat")))
             .when(size == 7, prices_with("service_code", lambda p: F.array(F.lit("00"))))
             .when(size == 8, prices_with("expiration_date", lambda p: F.regexp_replace(p["expiration_date"], "-", "/")))
             .when(size == 9, prices_with("billing_code_modifier", lambda p: F.array(F.lit("25"), F.lit("25"))))
             .when(size == 10, prices_with("billing_class", lambda p: F.lit("dental")))
             .when(size == 13, rates_with("provider_references", lambda r: F.concat(
                 r["provider_references"], r["provider_references"])))
             .when(size == 14, rates_with("negotiated_prices", lambda r: F.concat(
                 r["negotiated_prices"], r["negotiated_prices"])))
             .when(size == 15, prices_with("negotiated_type", lambda p: F.lit(None).cast("string")))
             .when(size == 16, inline([5, 5], ("zzz", "1")))
             .when(size == 18, prices_with("expiration_date", lambda p: F.lit("2024-99-99")))
             .when(size == 20, inline([5], ("ein", "1"), times=2))
             .when(size == 21, inline([5], None))
             .otherwise(F.col("negotiated_rates")))
    codes_t = IN_NETWORK_TABLE["covered_services"].dataType

    def code(kind, description):
        return F.array(F.struct(F.lit(kind), F.lit("2024"), F.lit("1"), F.lit(description))).cast(codes_t)

    i = i.withColumns({
        "bundled_codes": F.when(size == 11, code("CPT4", "d")).otherwise(F.col("bundled_codes")),
        "covered_services": F.when(size == 12, code("CPT", None)).otherwise(F.col("covered_services")),
        "negotiation_arrangement": F.when(size == 1, F.lit("fee")).otherwise(F.col("negotiation_arrangement")),
        "billing_code_type": F.when(size == 2, F.lit("CPT4")).otherwise(F.col("billing_code_type")),
        "description": F.when(size == 3, F.lit(None)).otherwise(F.col("description")),
        "negotiated_rates": rates,
    }).select(*[f.name for f in IN_NETWORK_TABLE.fields])

    nation = F.col("s_nationkey")
    p = fixture_providers(spark, sf_dir, keep_keys=True)
    p = p.withColumns({
        "location": F.when(nation == 0, F.regexp_replace("location", "^https://", "http://"))
                     .when(nation == 1, F.lit(None)).otherwise(F.col("location")),
        "provider_groups": F.when(nation == 3, F.transform(
            "provider_groups", lambda g: g.withField("npi", F.concat(g["npi"], g["npi"]))))
            .when(nation == 4, F.transform("provider_groups", lambda g: g.withField("tin.type", F.lit("ssn"))))
            .when(nation == 5, F.concat("provider_groups", "provider_groups")).otherwise(F.col("provider_groups")),
    }).select(*[f.name for f in PROVIDERS_TABLE.fields])

    b = fixture_base(spark, sf_dir).withColumns({"plan_name": F.lit("P"), "plan_market_type": F.lit("small"),
                                                    "last_updated_on": F.regexp_replace("last_updated_on", "-", "/")})
    return b, p, i


def inline_group_in_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's in_network where items of parts of size 17 list provider
    groups inline instead of references: one group per former reference, with
    one npi (``NPI_BASE + ref * 10``) and tin (``npi``, ref)."""
    i = fixture_in_network(spark, sf_dir, keep_keys=True)

    def group(ref):
        return F.struct(F.array(F.lit(NPI_BASE) + ref * 10).alias("npi"),
                        F.struct(F.lit("npi").alias("type"), ref.cast("string").alias("value")).alias("tin"))

    inline = F.transform("negotiated_rates", lambda r: r.withField(
        "provider_groups", F.transform(r["provider_references"], group)).withField(
        "provider_references", F.lit(None).cast("array<bigint>")))
    rates = F.when(F.col("p_size") == 17, inline).otherwise(F.col("negotiated_rates"))
    return i.withColumn("negotiated_rates", rates).select(*[f.name for f in IN_NETWORK_TABLE.fields])
