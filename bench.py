"""Timings of the headline queries; prints one JSON line.

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)     BENCH_CPUS  local cores (default 8)
BENCH_RUNS    timed runs after one warm-up (default 3)          BENCH_DUCKDB=1  time the SQL twins in DuckDB as well
BENCH_ONLY    comma-separated query names

``queries`` derive the record frames from the flat tables in every run. ``stored`` are the same queries over a node
table that was written once (bucketed by object), as a user would keep it; ``store_sec`` is the time to write it.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from functools import cached_property

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

QUERIES = [
    "Q1_objects_of_owner", "Q2_deep_containment", "Q3_owner_statistics", "Q4_paths_of_one_row", "Q5_or_containment",
    "Q6_folder_to_objects", "Q7_all_objects_as_of", "D2_contains", "J2_commit_update", "A8_flatten_documents",
]
STORED = ["Q2_deep_containment", "Q3_owner_statistics", "Q4_paths_of_one_row", "Q5_or_containment", "D2_contains"]


def timed(run, runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def duckdb_times(sf_dir: str, cpus: int, names: list[str], sql: dict[str, str], runs: int) -> dict[str, float]:
    import duckdb

    con = duckdb.connect()
    con.execute(f"SET threads TO {cpus}")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f).split('.')[0]} AS SELECT * FROM read_parquet('{f}')")
    out = {}
    for n in names:
        if n in sql:
            # materialized inside the database: no rows are fetched
            out[n] = timed(lambda: con.execute(f"CREATE OR REPLACE TEMP TABLE result AS {sql[n]}"), runs)
    return out


def main() -> None:
    from pyspark.sql import SparkSession

    from recspark.catalog.base import BUILDERS, SQL
    import recspark.catalog  # noqa: F401
    from recspark.plans.session import configure
    from recspark.sources.store import save_nodes_table
    from recspark.sources.tables import Tables

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    names = [q for q in QUERIES if not only or q in only]
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-warehouse-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str, tables):
        return lambda: BUILDERS[name](tables).write.format("noop").mode("overwrite").save()

    tables = Tables(spark, sf_dir)
    queries = {n: timed(run(n, tables), runs) for n in names}

    path = os.path.join(tempfile.mkdtemp(prefix="bench-"), "nodes")
    start = time.perf_counter()
    save_nodes_table(tables.nodes, "bench_nodes", path, buckets=cpus)
    store_sec = round(time.perf_counter() - start, 3)

    class Stored(Tables):
        @cached_property
        def nodes(self):
            return spark.table("bench_nodes")

    kept = Stored(spark, sf_dir)
    stored = {n: timed(run(n, kept), runs) for n in STORED if n in names}
    result = {
        "metric": "sum of median query times", "value": round(sum(queries.values()), 3), "unit": "sec", "queries": queries,
        "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, "stored": stored, "store_sec": store_sec,
    }
    if os.environ.get("BENCH_DUCKDB") == "1":
        result["duckdb"] = duckdb_times(sf_dir, cpus, names, SQL, runs)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
