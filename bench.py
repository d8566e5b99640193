"""Time the headline queries; prints one JSON line.

Each query is planned and run anew each time: one warm-up, then the median of three runs.  The
warm-up fills no cache of data, as nothing is cached; it compiles code.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallyforge.session import build_session
from verification.registry import QUERIES

HEADLINE = (
    "evt_parse",
    "snk_append_new_events",
    "use_total",
    "use_by_account",
    "use_pct_by_project",
    "use_pct_by_institution",
    "use_pct_national_users",
    "use_pct_by_demographic",
    "rpt_account_holders",
    "cnt_astronomers_by_department",
    "collab_summary",
    "ext_pct_by_institution",
    "ext_pct_by_demographic",
    "ds_jobs_by_family",
    "ds_active_user_profiles",
    "rec_summary",
    "rpt_event_path",
    "rpt_extract_path",
    "rpt_dataset_section",
)


def run(query, spark, folder: str) -> float:
    begun = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, folder)
        seconds[name] = round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
