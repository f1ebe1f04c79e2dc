"""The fixture's tables and documents: one shuffle of narrow rows, and no task that holds a document."""

import glob
import gzip
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import SF_SMALL
from pricelens.sources import fixtures


def _sales_dir(tmp_dir):
    """Tables of three parts, two of which are sold; a sale of a part that is not listed; sales without a flag
    or a supplier, and one that comes twice."""
    for t in ("region", "nation"):
        pq.write_table(pq.read_table(f"{SF_SMALL}/{t}.parquet"), f"{tmp_dir}/{t}.parquet")
    first = {t: pq.read_table(f"{SF_SMALL}/{t}.parquet").slice(0, 1) for t in ("part", "supplier", "lineitem")}

    def write(name, rows):
        base = first[name].to_pylist()[0]
        pq.write_table(pa.Table.from_pylist([{**base, **r} for r in rows], schema=first[name].schema), f"{tmp_dir}/{name}.parquet")

    write("part", [{"p_partkey": k} for k in (1, 2, 700)])
    write("supplier", [{"s_suppkey": k, "s_acctbal": 2000.0} for k in (3, 4, 5)])
    sale = {"l_partkey": 1, "l_orderkey": 1, "l_suppkey": 3, "l_returnflag": "A", "l_extendedprice": 1.0}
    write("lineitem", [sale, sale, {**sale, "l_extendedprice": 2.0}, {**sale, "l_returnflag": None, "l_suppkey": None},
                       {**sale, "l_partkey": 2, "l_suppkey": 4}, {**sale, "l_partkey": 3, "l_suppkey": 5}])
    return tmp_dir


def test_fixture_rates_of_each_flag(spark, tmp_dir):
    rows = fixtures.fixture_in_network(spark, _sales_dir(tmp_dir), keep_keys=True).orderBy("p_partkey").collect()
    found = {r.p_partkey: r.negotiated_rates and [
        ([p.negotiated_rate for p in x.negotiated_prices], x.provider_references, x.provider_groups)
        for x in r.negotiated_rates] for r in rows}
    assert found == {1: [([1.0], [], None), ([1.0, 2.0], [3], None)], 2: [([1.0], [4], None)], 700: None}


def test_nested_rows_of_the_fixture_are_not_shuffled(spark):
    plan = fixtures.fixture_in_network(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning" not in plan
    assert plan.count("Exchange hashpartitioning") == 2, plan  # of the sales and of the parts


def test_large_sales_are_shuffled_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "SALES_PER_TASK", 4 << 10)
    plan = fixtures.fixture_in_network(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_partkey" in plan
    size = os.path.getsize(f"{SF_SMALL}/lineitem.parquet")
    assert int(plan.split("hashpartitioning(l_partkey")[1].split(", ")[1].split(")")[0]) >= size // (4 << 10) > 4


def _documents(path):
    return {f.split("doc=")[1].split("/")[0]: gzip.open(f, "rt").read() for f in glob.glob(f"{path}/doc=*/*.gz")}


def test_documents_have_a_line_for_each_row(spark, tmp_dir):
    d = _sales_dir(tmp_dir)
    docs = _documents(fixtures.write_fixture_documents(spark, d, f"{tmp_dir}/docs"))
    assert sorted(docs) == ["doc-0-0", "doc-1-0"]  # parts 1 and 2, and part 700
    assert {k: len(v.splitlines()) for k, v in docs.items()} == {"doc-0-0": 4, "doc-1-0": 1}
    found = {k: json.loads(v) for k, v in docs.items()}
    assert [p["provider_group_id"] for p in found["doc-0-0"]["provider_references"]] == [3, 4]
    assert [len(i["negotiated_rates"]) for i in found["doc-0-0"]["in_network"]] in ([1, 2], [2, 1])
    assert found["doc-1-0"]["provider_references"] == [] and len(found["doc-1-0"]["in_network"]) == 1
    assert list(found["doc-0-0"])[0] == "reporting_entity_name"


def test_faulty_documents_are_cut_at_their_ends(spark, tmp_dir):
    d = _sales_dir(tmp_dir)
    docs = _documents(fixtures.write_fixture_documents(spark, d, f"{tmp_dir}/docs", "documents"))
    whole = _documents(fixtures.write_fixture_documents(spark, d, f"{tmp_dir}/whole"))
    assert docs["doc-0-0"] == whole["doc-0-0"][:-3] + "\n"
    assert json.loads(docs["doc-1-0"])["provider_references"] == [] and "in_network" not in docs["doc-1-0"]
