"""The rate table is placed by code before references and prices are exploded."""

from conftest import SF_SMALL
from pricelens.plans import layout, queries


def test_rates_are_shuffled_before_they_are_exploded(spark, monkeypatch):
    written, write = [], layout.write_rates

    def kept(rates, *args, **kwargs):
        written.append((rates, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")))
        write(rates, *args, **kwargs)

    monkeypatch.setattr(layout, "write_rates", kept)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    found = queries.q_rates_partition_roundtrip(spark, SF_SMALL)
    (rates, size), = written
    plan = rates._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RebalancePartitions") == 1
    above = plan[:plan.index("RebalancePartitions")]
    assert above.count("Generate explode(exploded_negotiated_rates") == 2, plan  # references and prices
    assert size != before == spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    want = queries.q_flatten_rates(spark, SF_SMALL)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
