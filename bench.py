"""Times the headline queries; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docwright.plans import QUERIES
from docwright.session import local_session

HEADLINE = (
    "validation_report", "text_hygiene_findings", "source_checks", "duplicate_subjects", "fee_rows", "college_checks",
    "catalogue_dedupe", "stratified_sample", "duration_resolve", "domain_resolved",
    "section_merge", "request_plan", "response_parse",
    "section_outcomes", "usage_merge", "review_items", "review_queue", "change_detection", "publish_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    documents = QUERIES["review_date"](spark, folder).count()
    print(json.dumps({
        "metric": "headline_queries_wall_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")), "cpus": cpus, "shuffle_partitions": cpus,
        "documents": documents, "documents_validated_per_sec": round(documents / seconds["validation_report"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
