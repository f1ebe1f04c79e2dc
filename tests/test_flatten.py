from collections import Counter

from pyspark.sql import functions as F

from pricelens.operators.flatten import flatten_npi_rates, flatten_rates
from pricelens.operators.unnest import unnest
from pricelens.schemas import NPI_RATES_COLUMNS, RATES_COLUMNS

from frames import base_rows, in_network, item, price, providers, rate


def _edge_tables(spark):
    b = base_rows(spark)
    p = providers(spark, [
        ("d1", 1, "https://a/1", [([11, 12], ("ein", "1"))]),
        ("d1", 2, "https://a/2", None),            # location only
        ("d1", 3, "https://a/3", [([], ("npi", "3"))]),  # no npi
        ("d1", None, "https://a/x", None),          # NULL id
        ("d1", 9, "https://a/9", [([99], ("ein", "9"))]),  # no rate refers to it
    ])
    i = in_network(spark, [
        item("00100", [rate([price(10.0), price(11.0)], [1, 2, 7]),   # 7 is unknown
                       rate([price(12.0)], [1, 1])]),                 # duplicate reference
        item("00200", None),                                          # NULL rates
        item("00300", []),                                            # empty rates
        item("00400", [rate([], [1])]),                               # empty prices
        item("00500", [rate([price(13.0)], None)]),                   # NULL references
        item("a/b", [rate([price(14.0)], [3])]),
    ])
    return b, p, i


def test_unnest_drops_or_keeps_empties(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "k int, a array<int>")
    assert sorted(r.k for r in unnest(df, "a", "x").collect()) == [1, 1]
    kept = unnest(df, "a", "x", keep_empty=True).collect()
    assert sorted((r.k, r.x) for r in kept) == [(1, 1), (1, 2), (2, None), (3, None)]


def test_flatten_rates_semantics(spark):
    b, p, i = _edge_tables(spark)
    out = flatten_rates(b, p, i)
    assert out.columns == RATES_COLUMNS
    rows = out.collect()
    # r x p per element: 3 refs x 2 prices + 2 refs x 1 price + 1 x 1 ('a/b'); empties dropped.
    assert len(rows) == 9
    by_ref = Counter(r.exploded_negotiated_rates_provider_references for r in rows)
    assert by_ref == Counter({1: 4, 2: 2, 7: 2, 3: 1})
    unknown = [r for r in rows if r.exploded_negotiated_rates_provider_references == 7]
    assert all(r.provider_group_id is None and r.reporting_entity_name is None for r in unknown)
    assert all(r.negotiated_rate is not None for r in rows)


def test_flatten_keep_unmatched(spark):
    b, p, i = _edge_tables(spark)
    rows = flatten_rates(b, p, i, keep_unmatched=True).collect()
    # 9 matched/unknown rows + NULL rates + empty rates + empty prices + NULL refs
    # + providers 9 and NULL id without rates.
    assert len(rows) == 9 + 4 + 2
    lonely = sorted((r.provider_group_id for r in rows if r.billing_code is None), key=lambda v: (v is None, v))
    assert lonely == [9, None]
    codes = Counter(r.billing_code for r in rows if r.billing_code is not None)
    assert codes["00200"] == 1 and codes["00300"] == 1 and codes["00400"] == 1 and codes["00500"] == 1


def test_flatten_npi_rates(spark):
    b, p, i = _edge_tables(spark)
    out = flatten_npi_rates(b, p, i)
    assert out.columns == NPI_RATES_COLUMNS
    rows = out.collect()
    # provider 1 has 2 npis: element 1 (2 prices) + element 2 (refs 1,1; 1 price) -> (2 + 2) * 2 = 8.
    assert len(rows) == 8
    assert {r.npi for r in rows} == {11, 12}
    assert {(r.tin_type, r.tin) for r in rows} == {("ein", "1")}


def test_documents_do_not_cross(spark):
    b = base_rows(spark, ("d1", "d2"))
    p = providers(spark, [("d1", 1, "https://a/1", None), ("d2", 1, "https://b/1", None)])
    i = in_network(spark, [item("00100", [rate([price(1.0)], [1])], doc="d1"),
                           item("00100", [rate([price(2.0)], [1])], doc="d2")])
    rows = flatten_rates(b, p, i, keep_source=True).collect()
    assert sorted((r.source_file, r.negotiated_rate) for r in rows) == [("d1", 1.0), ("d2", 2.0)]


def test_empty_base_drops_providers(spark):
    b = base_rows(spark, ())
    p = providers(spark, [("d1", 1, "https://a/1", None)])
    i = in_network(spark, [item("00100", [rate([price(1.0)], [1])])])
    rows = flatten_rates(b, p, i).collect()
    assert len(rows) == 1 and rows[0].provider_group_id is None


def _as_files(spark, tmp_dir, *tables):
    """The tables as Parquet files, whose sizes the plan's statistics know."""
    out = []
    for n, df in enumerate(tables):
        df.write.parquet(f"{tmp_dir}/{n}")
        out.append(spark.read.schema(df.schema).parquet(f"{tmp_dir}/{n}"))
    return out


def test_provider_side_is_broadcast(spark, tmp_dir):
    b, p, i = _as_files(spark, tmp_dir, *_edge_tables(spark))
    plan = flatten_rates(b, p, i)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "RightOuter" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_broadcast_beyond_limit(spark, tmp_dir):
    b, p, i = _as_files(spark, tmp_dir, *_edge_tables(spark))
    spark.conf.set("pricelens.broadcast.maxBytes", "2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = flatten_rates(b, p, i)
        plan = out._jdf.queryExecution().executedPlan().toString()
        joins = [ln for ln in plan.splitlines() if "RightOuter" in ln]
        assert joins and not any("BroadcastHashJoin" in ln for ln in joins)
        assert out.count() == 9
    finally:
        spark.conf.unset("pricelens.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_rows_property_on_fixture(spark):
    """rows(Q2) = sum over rate elements of |refs| x |prices| minus nothing: every
    reference (known or not) keeps its rows."""
    from pricelens.sources.fixtures import fixture_tables
    from conftest import SF_SMALL
    b, p, i = fixture_tables(spark, SF_SMALL)
    expected = (i.select(F.explode("negotiated_rates").alias("r"))
                .select((F.size("r.provider_references") * F.size("r.negotiated_prices")).alias("n"))
                .agg(F.sum("n")).first()[0])
    assert flatten_rates(b, p, i).count() == expected


def test_slim_schema_reaches_the_scan(spark, tmp_dir):
    """Only the leaves Q2 needs are read: no covered/bundled codes, no inline groups."""
    from pricelens.sources.fixtures import fixture_tables
    from pricelens.sources.tables import RATES_NEEDS, read_tables, write_tables
    from conftest import SF_SMALL
    write_tables(*fixture_tables(spark, SF_SMALL), tmp_dir)
    b, p, i = read_tables(spark, tmp_dir, RATES_NEEDS)
    plan = flatten_rates(b, p, i)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "table=in_network" in ln]
    assert scans
    for name in ("covered_services", "bundled_codes", "provider_groups", "location"):
        assert name not in plan, name
    assert "negotiated_prices" in plan


def test_wide_provider_groups_are_not_broadcast(spark, tmp_dir):
    """Few provider rows with many npis: the (group, npi) rows go beyond a bound that the
    providers alone keep, and deciding that runs no job."""
    groups = [([k * 10_000 + n for n in range(2000)], ("ein", str(k))) for k in range(20)]
    b, p, i = _as_files(spark, tmp_dir, base_rows(spark), providers(spark, [("d1", k, "https://a", [groups[k]]) for k in range(20)]),
                        in_network(spark, [item("00100", [rate([price(1.0)], [1, 2])])]))
    off = {"pricelens.broadcast.maxBytes": str(4 << 20), "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup("decide", "no job may run here")
    try:
        rates, npis = flatten_rates(b, p, i), flatten_npi_rates(b, p, i)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (rates, npis)]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("decide")
        joins = [[ln for ln in plan.splitlines() if kind in ln and "Join" in ln] for plan, kind in zip(plans, ("RightOuter", "provider_group_id"))]
        assert joins[0] and all("BroadcastHashJoin" in ln for ln in joins[0])
        assert joins[1] and all("SortMergeJoin" in ln or "ShuffledHashJoin" in ln for ln in joins[1])
        assert npis.count() == 4000
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
