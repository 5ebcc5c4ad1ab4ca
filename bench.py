"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driftspark.plans.catalog import QUERIES  # noqa: E402
from driftspark.session import local_session  # noqa: E402

HEADLINE = [
    "changed_files",
    "api_diff",
    "file_severity",
    "extracted_functions",
    "extracted_imports",
    "source_drift",
    "line_references",
    "line_references_two_phase",
    "code_examples",
    "affected_documents",
    "drifted_documents",
    "code_blocks",
    "project_context",
    "line_deltas",
    "changed_hunks",
    "validated_updates",
    "first_valid_answers",
    "update_prompts",
    "applied_documents",
    "run_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["file_languages"](spark, sf_dir).collect()  # start-up cost is not a query's
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
