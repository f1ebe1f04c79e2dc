"""A placement by counted rows shuffles a rate's prices once for many references."""

from frames import base_rows, in_network, item, price, providers, rate
from pricelens.operators.flatten import REFERENCES_TOGETHER, flatten_npi_rates, flatten_rates


def test_references_of_a_rate_are_placed_together(spark, tmp_dir):
    n = 5 * REFERENCES_TOGETHER + 1
    tables = [base_rows(spark), providers(spark, [("d1", k, None, [([k], ("ein", "1"))]) for k in range(n)]),
              in_network(spark, [item("1", [rate([price(1.0), price(2.0)], list(range(n))), rate([price(3.0)], []),
                                            rate([price(4.0)], None)]), item("2", [rate([price(5.0)], [n])])])]
    for k, df in enumerate(tables):  # as files, whose sizes let the providers be broadcast
        df.write.parquet(f"{tmp_dir}/{k}")
    tables = [spark.read.schema(df.schema).parquet(f"{tmp_dir}/{k}") for k, df in enumerate(tables)]
    placed = []

    def place(rows):
        placed.append(rows.count())
        return rows.repartition(3)

    for flatten, rows in ((flatten_rates, 2 * n + 1), (flatten_npi_rates, 2 * n)):
        out = flatten(*tables, cluster_by=place)
        assert out.count() == rows
        assert sorted(map(str, out.collect())) == sorted(map(str, flatten(*tables).collect()))
    assert placed == [7, 7]  # not a row for each of the n references
