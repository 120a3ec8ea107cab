"""Run the whole chain on a trip table: ``spark-submit -m odgraph`` style entry.

    python -m odgraph TRIPS_PATH [TRIPS_PATH ...] --out OUT [--pagerank-iters 20] [--lpa-iters 10]
                      [--merge-schema] [--months 2024-01 2024-02]

Reads Parquet trips (declared 5-column schema), builds the edge list,
PageRank, label propagation and community statistics, and writes them under
``OUT`` (Parquet, plus CSV copies of the bounded report tables).  The session
comes from ``SparkSession.builder.getOrCreate()``, i.e. from whatever
``spark-submit`` / ``spark-defaults.conf`` configured; the library changes no
session setting permanently.
"""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="odgraph")
    ap.add_argument("paths", nargs="+")
    ap.add_argument("--out", required=True)
    ap.add_argument("--pagerank-iters", type=int, default=20)
    ap.add_argument("--lpa-iters", type=int, default=10)
    ap.add_argument("--merge-schema", action="store_true")
    ap.add_argument("--months", nargs="*", default=None, help="YYYY-MM; needs a pickup_ts column")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from odgraph.operators import report
    from odgraph.params import DEFAULTS
    from odgraph.plans.pipeline import run
    from odgraph.session import drop_scratch
    from odgraph.sources import io
    from odgraph.sources.trips import months_filter, read_trips

    spark = SparkSession.builder.appName("odgraph").getOrCreate()
    keep = ("pickup_ts",) if a.months else ()
    trips = read_trips(spark, a.paths, keep=keep, merge_schema=a.merge_schema)
    if a.months:
        trips = months_filter(trips, a.months)
    p = DEFAULTS.with_(pagerank_iters=a.pagerank_iters, lpa_iters=a.lpa_iters)
    pipe = run(trips, out=a.out, p=p)
    paths = report.write_reports(pipe.ranks, pipe.community_stats, f"{a.out}/reports")
    io.write_csv(pipe.audit, f"{a.out}/reports/cleaning_audit")
    drop_scratch(spark)
    print(json.dumps({"out": a.out, "reports": paths}))


if __name__ == "__main__":
    main()
