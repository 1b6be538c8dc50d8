"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from archiveloom.plans.registered import QUERIES  # noqa: E402

HEADLINE = (
    "projects_summary", "classify_project_type", "type_tally", "list_qda_files", "file_candidates",
    "count_by_repository", "count_by_class", "repo_rollup", "repo_file_class_counts", "rank_table",
    "rank_table_files", "repo_findings", "repo_pies", "report_blocks", "archive_series",
    "constraint_violations", "cleaning_audit", "fetch_status", "delete_cascade",
    "harmonise_schema", "dedupe_projects", "link_components", "merged_archive", "dedupe_files",
    "surrogate_ids", "attach_children", "project_text", "nearest2", "project_nearest2",
    "file_nearest2", "top_tags", "detect_language", "parse_dataverse_projects",
    "parse_nada_projects", "ingest_keywords", "harvest_links", "topk_per_query",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("archiveloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM-side machinery and the Python workers before the clock runs
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        # the whole result is computed and thrown away: nothing is pruned and nothing collected
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
