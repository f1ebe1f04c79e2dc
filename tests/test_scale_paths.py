"""The at-scale code paths, forced on small data: no broadcast, a hot reference
that AQE must split, and a hot billing code the writer must spread over tasks."""

import glob

from pricelens.operators.flatten import flatten_rates
from pricelens.plans import layout

from frames import base_rows, in_network, item, price, providers, rate


def _hot_tables(spark):
    b = base_rows(spark)
    p = providers(spark, [("d1", k, f"https://a/{k}", None) for k in range(50)])
    prices = [price(float(x)) for x in range(40)]
    rows = [item("00001", [rate(prices, [0])], name=f"hot{k}") for k in range(400)]      # hot reference 0
    rows += [item(f"{k % 7:05d}", [rate(prices[:2], [k % 50])], name=f"n{k}") for k in range(100)]
    return b, p, in_network(spark, rows)


def _set(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_reference_is_split_by_aqe(spark):
    old = _set(spark, {
        "pricelens.broadcast.maxBytes": "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    })
    try:
        b, p, i = _hot_tables(spark)
        df = flatten_rates(b, p, i)
        assert len(df.collect()) == 400 * 40 + 100 * 2
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "SortMergeJoin" in final and "RightOuter" in final
        assert "skew=true" in final, final
    finally:
        _restore(spark, old)


def test_hot_code_is_written_by_several_tasks(spark, tmp_dir):
    old = _set(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                       "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    try:
        tables = []
        for n, df in enumerate(_hot_tables(spark)):  # as files, whose sizes let the providers be broadcast
            df.write.parquet(f"{tmp_dir}/{n}")
            tables.append(spark.read.schema(df.schema).parquet(f"{tmp_dir}/{n}"))
        b, p, i = tables
        path = f"{tmp_dir}/rates"
        layout.write_partitions(flatten_rates(b, p, i), path)
        hot_files = glob.glob(f"{path}/billing_code=00001/*.parquet")
        assert len(hot_files) > 1
        assert spark.read.parquet(path).count() == 400 * 40 + 100 * 2
    finally:
        _restore(spark, old)
