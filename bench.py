"""Benchmark: the reference's two jobs, preprocessing and processing, at
$BENCH_SF_DIR on local[$BENCH_CPUS]. Prints one JSON line
{"metric", "value", "unit", "queries", "sf", ...}.

Setup (timed, reported under "setup", not in "value"): the test tables are turned
into what the reference starts from, gzip JSON rate documents.

Timed stages (their sum is "value"):
  preprocess_multiline  raw documents -> base / provider_references / in_network
                        Parquet in one pass per document, Spark's multiLine JSON
                        reader (Q1, K1, K2)
  preprocess_stream     the same with the streaming item reader (binaryFile bytes)
  preprocess_direct     the same, each task opening its file by path
  flatten_rates         Q2 from the Parquet tables (slim read schema), no-op sink
  flatten_keep_unmatched Q3, same
  flatten_npi_rates     Q4, same
  write_rates           Q2 written partitioned by billing_code, bucketed by negotiated_type
  write_npi_rates       Q4 written partitioned by billing_code, bucketed by npi
  rates_by_code         L2 lookup on the written rate table (partition pruning)
  stage_counts          Q2 with every stage counted by observe, in one job
  contract              C1-C12 over the three tables, counted

Timed beside them, under "extra", not in "value" (its work is new, so the sum stays comparable):
  preprocess_large      one uncompressed document of about 300,000 items (at sf0.1), read in ranges by
                        many tasks ("stream") into the three tables
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricelens.operators.flatten import flatten_npi_rates, flatten_rates  # noqa: E402
from pricelens.plans import layout, lookup  # noqa: E402
from pricelens.plans.report import StageCounter  # noqa: E402
from pricelens.session import build_session, scratch_dir  # noqa: E402
from pricelens.operators.contract import violations  # noqa: E402
from pricelens.sources.fixtures import write_fixture_documents, write_large_document  # noqa: E402
from pricelens.sources.raw_json import extract_to_tables  # noqa: E402
from pricelens.sources.tables import NPI_NEEDS, RATES_NEEDS, read_tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            # Sized for sf0.1 (a few hundred MB of shuffle); 128m or more at scale.
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": os.environ.get("BENCH_ADVISORY", "16m"),
            "spark.local.dir": tempfile.mkdtemp(prefix="pricelens-bench-local-")}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="pricelens-bench", extra=conf)
    times: dict[str, float] = {}
    setup: dict[str, float] = {}
    extra: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn, into=times):
        t0 = time.perf_counter()
        out = fn()
        into[name] = round(time.perf_counter() - t0, 3)
        return out

    docs = scratch_dir(spark, "bench-documents")
    timed("write_documents", lambda: write_fixture_documents(spark, sf_dir, docs), setup)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def preprocess(method):
        return extract_to_tables(spark, docs, scratch_dir(spark, f"bench-tables-{method}"), method)

    timed("preprocess_multiline", lambda: preprocess("multiline"))
    timed("preprocess_stream", lambda: preprocess("stream"))
    root = timed("preprocess_direct", lambda: preprocess("direct"))

    large = scratch_dir(spark, "bench-large")
    rows["large_items"] = timed("write_large", lambda: write_large_document(spark, sf_dir, large), setup)
    large_root = timed("preprocess_large", lambda: extract_to_tables(spark, large, scratch_dir(spark, "bench-large-tables")), extra)
    rows["large_items_read"] = read_tables(spark, large_root)[2].count()

    timed("flatten_rates", lambda: noop(flatten_rates(*read_tables(spark, root, RATES_NEEDS))))
    timed("flatten_keep_unmatched",
          lambda: noop(flatten_rates(*read_tables(spark, root, RATES_NEEDS), keep_unmatched=True)))
    timed("flatten_npi_rates", lambda: noop(flatten_npi_rates(*read_tables(spark, root, NPI_NEEDS))))

    rates_path = scratch_dir(spark, "bench-rates")
    npi_path = scratch_dir(spark, "bench-npi-rates")
    # Clustered by billing_code before prices are exploded (less shuffle), then written.
    timed("write_rates", lambda: layout.write_rates(
        flatten_rates(*read_tables(spark, root, RATES_NEEDS), cluster_by="billing_code"),
        "bench_rates", rates_path, rebalance=None))
    timed("write_npi_rates", lambda: layout.write_npi_rates(
        flatten_npi_rates(*read_tables(spark, root, NPI_NEEDS), cluster_by="billing_code"),
        "bench_npi_rates", npi_path, rebalance=None))
    rows["rates_by_code"] = timed("rates_by_code", lambda: lookup.rates_by_code(
        spark.table("bench_rates"), "00007", ["negotiated_rate", "description"]).count())

    counter = StageCounter()

    def stages():
        noop(flatten_rates(*read_tables(spark, root, RATES_NEEDS), counter=counter))
        return {r["stage"]: r["rows"] for r in counter.report(spark).collect()}

    stage_rows = timed("stage_counts", stages)
    rows["rates"] = stage_rows.get("rates", -1)
    rows["violations"] = timed("contract", lambda: violations(*read_tables(spark, root)).count())
    spark.stop()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "rate_jobs_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "setup": setup,
        "extra": extra,
        "rows": rows,
        "stage_rows": stage_rows,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
