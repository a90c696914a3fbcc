"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs in full; its rows are written to the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docpulse.session import local_session
from workload import QUERIES

HEADLINE = [
    "vw_document_fields", "vw_document_summary", "vw_low_confidence_fields", "vw_field_stats_by_analyzer",
    "vw_daily_ingestion", "vw_preprocess_checks", "vw_preprocess_issues", "vw_rejected_documents",
    "vw_preprocess_daily_summary", "adhoc_top20_fields", "upsert_documents", "finalize_document_stats",
    "backlink_checks", "constraint_violations", "apply_outcomes", "route_outcomes", "q_text", "q_image",
    "q_pdf_pages", "text_decode", "skew_argmax", "page_image_dpi", "image_pixel_stats", "shape_dispatch",
    "flatten_fields", "leaf_typed_values", "ingest_field_stats", "stored_fields", "stream_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["vw_daily_ingestion"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
