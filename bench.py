"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from townhall.plans.catalogue import CATALOGUE
from townhall.session import build_session

HEADLINE = [
    "kpi_overview", "kpi_support", "top_posts", "top_unanswered", "hardest_question", "answered_by_channel",
    "median_response_by_channel", "channel_summary", "type_share", "monthly_by_type", "author_activity",
    "top_authors", "poster_frequency", "response_histogram", "views_by_response_count", "filtered_dashboard",
    "typed_report", "clean_html_full", "page_links", "channel_dimension", "list_discovery",
    "nested_list_discovery", "capture_posts", "channel_posts", "flatten_union", "dedupe_first",
    "incremental_new", "conversation_posts", "term_counts", "collocations", "top_terms", "stream_windows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "townhall-bench", master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        CATALOGUE[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in names:
        run(name)  # compiles the plan once
        times[name] = round(min(run(name) for _ in range(2)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
