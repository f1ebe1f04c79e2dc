import glob
import os

import pytest
from pyspark.sql import functions as F

from pricelens.operators.flatten import flatten_rates
from pricelens.plans import layout, lookup

from frames import base_rows, in_network, item, price, providers, rate


def _rates(spark):
    b = base_rows(spark)
    p = providers(spark, [("d1", 1, "https://a/1", None)])
    i = in_network(spark, [
        item("00100", [rate([price(1.0, typ="negotiated"), price(2.0, typ="fee schedule")], [1])]),
        item("a/b", [rate([price(3.0)], [1])]),
        item(None, [rate([price(4.0)], [1])]),
    ])
    return flatten_rates(b, p, i)


def test_bucketed_write_keeps_codes_and_prunes(spark, tmp_dir):
    path = f"{tmp_dir}/rates"
    layout.write_rates(_rates(spark), "t_rates_layout", path)
    dirs = sorted(os.path.basename(d) for d in glob.glob(f"{path}/billing_code=*"))
    assert dirs == ["billing_code=00100", "billing_code=__HIVE_DEFAULT_PARTITION__", "billing_code=a%2Fb"]
    assert len(glob.glob(f"{path}/billing_code=00100/*.parquet")) <= 2
    t = spark.table("t_rates_layout")
    assert sorted(r.billing_code for r in t.select("billing_code").distinct().collect()
                  if r.billing_code) == ["00100", "a/b"]
    q = lookup.rates_by_code_and_type(t, "00100", "negotiated")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "billing_code" in plan
    assert [r.negotiated_rate for r in q.collect()] == [1.0]
    # a second overwrite replaces the table
    layout.write_rates(_rates(spark).where(F.col("billing_code") == "00100"), "t_rates_layout", path)
    assert spark.table("t_rates_layout").count() == 2


def test_partition_files_and_repair(spark, tmp_dir):
    path = f"{tmp_dir}/codes"
    layout.write_partitions(_rates(spark), path)
    t = layout.register_rates(spark, "t_processed", path)
    assert t.count() == 4
    assert sorted(r.billing_code for r in t.collect() if r.billing_code) == ["00100", "00100", "a/b"]
    # dynamic overwrite replaces only the codes written
    layout.write_partitions(_rates(spark).where(F.col("billing_code") == "00100").limit(1), path)
    assert spark.read.parquet(path).count() == 3


def test_stream_reader_nulls_mistyped_values_like_spark(spark, tmp_dir):
    """A fractional id, an id beyond 64 bits and a string id become NULL, alone or beside whole ones; 3.0 is 3."""
    from pricelens.sources.raw_json import extract
    doc = ('{"reporting_entity_name":"E","reporting_entity_type":"t","last_updated_on":"2024-12-01",'
           '"version":"1","provider_references":[{"provider_group_id":2.5,"location":"https://a"},'
           '{"provider_group_id":"x"},{"provider_group_id":7}],'
           '"in_network":[{"billing_code":"1","name":5,"negotiated_rates":[{"provider_references":[7, 1.5],'
           '"negotiated_prices":[{"negotiated_rate":3,"billing_class":"institutional"}]}]}]}')
    with open(f"{tmp_dir}/d.json", "w") as f:
        f.write(doc)
    got = {}
    for method in ("multiline", "stream"):
        b, p, i = extract(spark, tmp_dir, method)
        got[method] = (sorted((r.provider_group_id is None, r.provider_group_id) for r in p.collect()),
                       [(r.name, [x.provider_references for x in r.negotiated_rates],
                         [x.negotiated_prices[0].negotiated_rate for x in r.negotiated_rates]) for r in i.collect()])
    assert got["stream"][0] == [(False, 7), (True, None), (True, None)]
    assert got["stream"][1] == [("5", [[7, None]], [3.0])]
    assert got["multiline"][0] == got["stream"][0]
    assert got["multiline"][1] == got["stream"][1]
    with open(f"{tmp_dir}/d.json", "w") as f:
        f.write('{"provider_references":[{"provider_group_id":2.5},{"provider_group_id":3.0},'
                '{"provider_group_id":7},{"provider_group_id":1180591620717411303424}],"in_network":[]}')
    for method in ("multiline", "stream", "direct"):
        _, p, _ = extract(spark, tmp_dir, method)
        assert sorted(str(r.provider_group_id) for r in p.collect()) == ["3", "7", "None", "None"], method


def test_truncated_document_fails_or_is_listed(spark, tmp_dir):
    from pricelens.sources.raw_json import extract, read_documents, unreadable_documents
    for name, text in (("cut", '{"version":"1","provider_references":[{"provider_group_id":1}],"in_network":[{"na'),
                       ("mistyped", '{"version":"1","in_network":[{"negotiated_rates":7}]}')):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
    assert [os.path.basename(r[0]) for r in unreadable_documents(spark, tmp_dir).collect()] == ["cut.json"]
    assert read_documents(spark, tmp_dir, unreadable="drop").count() == 1
    for method in ("multiline", "stream", "direct"):
        with pytest.raises(Exception):
            extract(spark, tmp_dir, method)[2].collect()


def test_plain_prefixes_without_a_document_key(spark, tmp_dir):
    from pricelens.schemas import DOC_KEY
    from pricelens.sources.tables import read_prefixes
    tables = (base_rows(spark), providers(spark, [("d1", 1, "https://a/1", [([9], ("ein", "1"))])]),
              in_network(spark, [item("1", [rate([price(1.0)], [1, 2])])]))
    for fmt in ("parquet", "json"):
        paths = [f"{tmp_dir}/{fmt}-{n}" for n in range(3)]
        for df, path in zip(tables, paths):
            df.drop(DOC_KEY).write.format(fmt).save(path)
        rows = flatten_rates(*read_prefixes(spark, *paths, fmt=fmt)).collect()
        assert sorted((r.provider_group_id is None, r.version) for r in rows) == [(False, "1.0.0"), (True, None)]


def _scan_metric(df, name):
    """A metric of the one file scan of a frame that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    while leaves.size() == 1 and leaves.apply(0).getClass().getSimpleName().endswith("QueryStageExec"):
        leaves = leaves.apply(0).plan().collectLeaves()
    return leaves.apply(0).metrics().apply(name).value()


def test_npi_lookup_reads_row_groups_that_hold_the_npi(spark, tmp_dir):
    """Every file spans all npis, so statistics cannot tell that 4,001 (odd) is in none; the Bloom filters do."""
    rows = spark.range(60_000).selectExpr("(id % 3000) * 2 AS npi", "cast(id % 5 AS string) AS billing_code", "id AS x")
    layout.write_npi_rates(rows, "t_npi_bloom", f"{tmp_dir}/npi", buckets=4)
    t = spark.table("t_npi_bloom")
    absent, present = lookup.rates_by_npi(t, 4001), lookup.rates_by_npi(t, 4000)
    assert absent.count() == 0 and present.count() == 20
    assert _scan_metric(absent, "numOutputRows") == 0
    assert 0 < _scan_metric(present, "numOutputRows") < 60_000 // 4
    assert "SelectedBucketsCount: 1 out of 4" in present._jdf.queryExecution().executedPlan().toString()
    plain = spark.range(60_000).selectExpr("(id % 3000) * 2 AS npi", "cast(id % 5 AS string) AS billing_code", "id AS x")
    layout.write_bucketed(plain, "t_npi_plain", f"{tmp_dir}/plain", "npi", 4, options={"parquet.enable.dictionary#npi": "false"})
    assert _scan_metric(lookup.rates_by_npi(spark.table("t_npi_plain"), 4001), "numOutputRows") > 0


def test_partitions_by_weight_even_out_a_hot_code(spark, tmp_dir):
    """A third of all rows have one code; the largest file has at most twice the median's bytes."""
    b, p = base_rows(spark), providers(spark, [("d1", k, "https://a/1", None) for k in range(40)])
    prices = [price(float(x) + 0.5) for x in range(10)]
    items = [item("hot", [rate(prices, list(range(20)))], name=f"h{k}") for k in range(40)]
    items += [item(f"{k:03d}", [rate(prices, list(range(20)))], name=f"n{j}") for k in range(20) for j in range(4)]
    i = in_network(spark, items)
    place = layout.by_weight(layout.rate_weights(i), rows_per_slice=800)
    layout.write_rates(flatten_rates(b, p, i, cluster_by=place), "t_weighted", f"{tmp_dir}/rates", buckets=1, rebalance=None)
    assert spark.table("t_weighted").count() == 40 * 200 + 80 * 200
    sizes = sorted(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/rates/*/*.parquet"))
    assert len(glob.glob(f"{tmp_dir}/rates/billing_code=hot/*.parquet")) == 10
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_npi_weights_count_the_rows(spark):
    b = base_rows(spark)
    p = providers(spark, [("d1", 1, None, [([11, 12], ("ein", "1")), ([13], ("ein", "2"))]), ("d1", 2, None, None),
                          ("d1", 3, None, [(None, ("ein", "3")), ([], None)])])
    i = in_network(spark, [item("a", [rate([price(1.0), price(2.0)], [1, 2, 9])]), item("b", [rate([price(1.0)], [3])]),
                           item(None, [rate([price(1.0)], [1, 1])]), item("c", None), item("d", [rate(None, [1]), rate([price(1.0)], None)])])
    from pricelens.operators.flatten import flatten_npi_rates
    want = {(r.billing_code, r["count"]) for r in flatten_npi_rates(b, p, i).groupBy("billing_code").count().collect()}
    assert {(r.billing_code, r.rows) for r in layout.npi_weights(p, i).collect()} == want == {("a", 6), (None, 6)}
    want = {(r.billing_code, r["count"]) for r in flatten_rates(b, p, i).groupBy("billing_code").count().collect()}
    assert {(r.billing_code, r.rows) for r in layout.rate_weights(i).collect()} == want
    for weights, rates in ((layout.npi_weights(p, i), flatten_npi_rates(b, p, i, cluster_by=layout.by_weight(layout.npi_weights(p, i), 2))),
                           (layout.rate_weights(i), flatten_rates(b, p, i, cluster_by=layout.by_weight(layout.rate_weights(i), 2)))):
        assert {(r.billing_code, r["count"]) for r in rates.groupBy("billing_code").count().collect()} == {
            (r.billing_code, r.rows) for r in weights.collect()}


def test_append_registers_only_the_codes_written(spark, tmp_dir):
    path = f"{tmp_dir}/codes"
    rates = _rates(spark).select("billing_code", "negotiated_rate", "description")
    layout.write_partitions(rates.where("billing_code = '00100'"), path)
    layout.register_rates(spark, "t_appended", path)
    old = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    # A directory that nobody registered: listing every directory would find it.
    rates.limit(1).write.parquet(f"{path}/billing_code=stray")
    layout.append_rates("t_appended", rates.where("billing_code = 'a/b' OR billing_code IS NULL"))
    known = {r[0] for r in spark.sql("SHOW PARTITIONS t_appended").collect()}
    assert known == {"billing_code=00100", "billing_code=a%2Fb", "billing_code=__HIVE_DEFAULT_PARTITION__"}
    assert sorted(str(r.billing_code) for r in spark.table("t_appended").collect()) == ["00100", "00100", "None", "a/b"]
    assert all(os.path.getmtime(f) == t for f, t in old.items())
    layout.append_rates("t_appended", rates.where("billing_code = '00100'").limit(1))  # replaces that code alone
    assert spark.table("t_appended").count() == 3


def test_documents_share_a_plain_prefix(spark, tmp_dir):
    from pricelens.schemas import DOC_KEY
    from pricelens.sources.tables import read_prefixes
    for fmt in ("parquet", "json"):
        paths = [f"{tmp_dir}/{fmt}-{n}" for n in range(3)]
        for doc in ("one", "two"):
            tables = (base_rows(spark).drop("version"), providers(spark, [("d", 1, f"https://{doc}", None)]),
                      in_network(spark, [item(doc, [rate([price(1.0)], [1])])]))
            for df, path in zip(tables, paths):
                df.drop(DOC_KEY).write.format(fmt).save(f"{path}/{doc}-2024")
        shared = read_prefixes(spark, *paths, fmt=fmt, document_of_path=r"/([a-z]+)-2024/")
        assert [(r.billing_code, r.provider_group_id) for r in flatten_rates(*shared).orderBy("billing_code").collect()] == [
            ("one", 1), ("two", 1)]
        assert flatten_rates(*read_prefixes(spark, *[f"{p}/*" for p in paths], fmt=fmt)).count() == 8  # taken for one document


def test_stream_restart_takes_files_landed_in_between(spark, tmp_dir):
    from pricelens.streaming.incremental import stream_rates
    b, p = base_rows(spark), providers(spark, [("d1", 1, "https://a/1", None)])
    for code in ("1", "2"):
        in_network(spark, [item(code, [rate([price(1.0)], [1])])]).write.mode("append").parquet(f"{tmp_dir}/items")
        stream_rates(spark, f"{tmp_dir}/items", b, p, f"{tmp_dir}/out", f"{tmp_dir}/ckpt").awaitTermination()
    assert sorted(str(r.billing_code) for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == ["1", "2"]
