"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR and BENCH_CPUS choose tables and cores. Every query runs to the
no-op sink, so all rows and columns are computed and none reach the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from indexloom.session import build_session  # noqa: E402
from indexloom.workload.registered import QUERIES  # noqa: E402

HEADLINE = (
    "q1_top_packages", "q1_naive", "q2_maintainer_like", "q2_naive", "q3_no_maintainer", "q3_not_in",
    "q4_file_digest", "q4_upper", "q5_releases_per_org", "q5_naive",
    "dedup_package", "dedup_maintainer", "dedup_maintained_by", "release_cap", "candidates_first_n",
    "clean_entity", "clean_report", "backfill_parent",
    "surrogate_key", "surrogate_int", "resolve_release", "resolve_file", "fk_violations",
    "load_release", "load_file_hash", "load_tagged_with",
    "check_fk", "check_unique", "check_three_hashes", "relationship_degree",
    "src_latest_run", "sink_full_refresh", "ext_release", "extract_all",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "indexloom-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    QUERIES["q5_releases_per_org"].run(spark, sf).write.format("noop").mode("overwrite").save()  # start-up
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds over the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
