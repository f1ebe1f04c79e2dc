"""Where providers are too many to broadcast, the rates need not be sorted for the join."""

from frames import base_rows, in_network, item, price, providers, rate
from pricelens.operators.flatten import flatten_rates


def test_rates_are_not_sorted_for_the_join(spark):
    b = base_rows(spark, ("d1", "d2"))
    p = providers(spark, [("d1", 1, None, None), ("d1", 1, None, None), ("d2", 1, None, None), ("d2", None, None, None)])
    i = in_network(spark, [item("1", [rate([price(1.0), price(2.0)], [1, 2, None])]),
                           item("2", [rate([price(3.0)], [1])], doc="d2"), item("3", [rate([price(4.0)], [1])], doc="d3")])
    keys = ["pricelens.broadcast.maxBytes", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "0" if k.startswith("pricelens") else "-1")
        hashed, plain = flatten_rates(b, p, i, hash_providers=True), flatten_rates(b, p, i)
        rows = [sorted(map(str, df.collect())) for df in (hashed, plain)]
        plan = hashed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert rows[0] == rows[1] and len(rows[0]) == 4 + 2 + 2 + 1 + 1
    final = plan.split("== Initial Plan ==")[0]
    assert "ShuffledHashJoin" in final and "RightOuter, BuildLeft" in final, final
