"""Benchmark of the headline pipeline steps.

Reads the given tables at $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS] (default 8).  Step 1 turns the relational tables
into change events and loads them into bronze parquet (timed once, as
``bronze_load``); every later step reads that bronze like the real
pipeline does.  Single models are timed as the warm median of 3 runs
(output forced with the no-op sink); ``gold_build_all`` is the median
of 3 full gold builds (line items written once, gold tables written as
parquet, each run into a fresh folder); reports and checks then read
the gold tables.  The streaming loader (change-log files -> bronze,
then a compaction) is timed once, beside the total.  An untimed
pass over sf0.001 first warms the JVM and code generation.  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from commerce_lake import schemas as S  # noqa: E402
from commerce_lake.operators import changes as C  # noqa: E402
from commerce_lake.operators import quality as Q  # noqa: E402
from commerce_lake.plans import gold, pipeline, reports, silver  # noqa: E402
from commerce_lake.plans.materialize import materialize  # noqa: E402
from commerce_lake.session import checkpoint_dir, get_session  # noqa: E402
from commerce_lake.sources import fixtures as FX  # noqa: E402
from commerce_lake.streaming import ingest as I  # noqa: E402

AS_OF = "2024-01-01 00:00:00"
AS_OF_ORDERS = "2001-08-01"
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _force(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, runs: int = RUNS) -> float:
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def _load_bronze(spark, sf_dir: str, base: str) -> dict[str, DataFrame]:
    for e in S.ENTITIES:
        FX.bronze_from_tables(spark, sf_dir, e).write.mode("overwrite").parquet(os.path.join(base, e))
    return {e: spark.read.parquet(os.path.join(base, e)) for e in S.ENTITIES}


def _warm_up(spark, base: str) -> None:
    """One untimed pass over the smallest tables: JVM start-up and code generation."""
    small = "/root/testdata/sf0.001"
    if os.path.isdir(small):
        bronze = _load_bronze(spark, small, os.path.join(base, "warm-bronze"))
        pipeline.build(spark, bronze, os.path.join(base, "warm-gold"), AS_OF)


def _stream_loader(spark, sf_dir: str, base: str) -> dict[str, float]:
    """Seconds to load the change log of the three entities as a file stream, and to compact what it left."""
    src, root = os.path.join(base, "changelog"), os.path.join(base, "loaded")
    for e in S.ENTITIES:
        FX.changelog_from_tables(spark, sf_dir, e).write.mode("append").parquet(src)
    t0 = time.perf_counter()
    I.run_stream(I.ingest(I.read_changes(spark, path=src, fmt="parquet", max_per_trigger=4), root, os.path.join(base, "loader")))
    t1 = time.perf_counter()
    I.compact(spark, root)
    t2 = time.perf_counter()
    rows = I.progress_table(spark, root).agg({"num_input_rows": "sum"}).first()[0]
    return {"stream_load": round(t1 - t0, 3), "compact": round(t2 - t1, 3), "rows": rows, "rows_per_sec": round(rows / (t1 - t0), 1)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    base = os.path.join(checkpoint_dir(spark), f"bench-{int(time.time())}")
    _warm_up(spark, base)
    times: dict[str, float] = {}

    # 1. change log -> bronze parquet (one run: it writes the input of the rest)
    t0 = time.perf_counter()
    bronze = _load_bronze(spark, sf_dir, os.path.join(base, "bronze"))
    times["bronze_load"] = time.perf_counter() - t0

    # 2. single models, lazily from bronze (warm median of 3)
    stg_c = silver.customers(bronze["customers"], AS_OF)
    stg_p = silver.products(bronze["products"], AS_OF)
    stg_o = silver.orders(bronze["orders"], AS_OF)
    times["silver_parse"] = _timed(lambda: (_force(stg_c), _force(stg_p), _force(stg_o)))
    times["m4_dim_customers"] = _timed(lambda: _force(gold.dim_customers(stg_c, AS_OF)))
    times["m5_dim_products"] = _timed(lambda: _force(gold.dim_products(stg_p, AS_OF)))
    times["m6_line_items"] = _timed(lambda: _force(gold.line_items(stg_o)))
    times["m8_daily_sales"] = _timed(lambda: _force(gold.daily_sales(gold.line_items(stg_o), AS_OF)))
    times["c6_latest_per_key"] = _timed(lambda: _force(C.latest_per_key(stg_c, ["customer_id"])))
    # the fact from written line items (its keyed side tables are written inside)
    lines = materialize(gold.line_items(stg_o), "bench_lines")
    dim_c, dim_p = gold.dim_customers(stg_c, AS_OF), gold.dim_products(stg_p, AS_OF)
    times["m7_fact_orders"] = _timed(lambda: _force(gold.fact_orders(lines, dim_c, dim_p, AS_OF)))

    # 3. the whole gold build as the pipeline runs it (line items written once,
    #    dimensions, fact and daily sales written as parquet)
    builds: list[dict] = []

    def build() -> None:
        builds.append(pipeline.build(spark, bronze, os.path.join(base, f"gold-{len(builds)}"), AS_OF))

    times["gold_build_all"] = _timed(build)
    g = builds[-1]

    # 4. reports and checks over the gold tables
    times["r3_r4_segments_inventory"] = _timed(
        lambda: (_force(reports.segments(g["dim_customers"])), _force(reports.price_inventory(g["dim_products"]))))
    times["r5_top_orders"] = _timed(lambda: _force(reports.top_orders(g["fact_orders"], AS_OF_ORDERS, 7, 20)))
    times["r6_recent_days"] = _timed(lambda: _force(reports.recent_days(g["fct_daily_sales"], 7)))
    models = {"stg_customers": stg_c, "stg_products": stg_p, "stg_orders": stg_o, **g}
    times["q_all_checks"] = _timed(lambda: _force(Q.run_checks(models)))

    loader = _stream_loader(spark, sf_dir, base)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "loader": loader,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
