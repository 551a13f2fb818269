"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores (default 8). Every
query writes all of its rows to a no-op sink. All run once to warm up, then once for the clock.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import REGISTERED  # noqa: E402
from webglean.session import local_session  # noqa: E402

HEADLINE = (
    "o02_parse_payloads",
    "o08_normalize_requests",
    "o10_exclude_domains",
    "o13_to_display_lines",
    "o16_search",
    "o17_search_batch",
    "o19_research",
    "o20_merge_results",
    "o28_robots_allowed",
    "o34_block_text",
    "o37_article_record",
    "o38_rate_schedule",
    "o39_peak_in_flight",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "webglean-bench")
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        started = time.perf_counter()
        REGISTERED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in HEADLINE:
        run(name)
    seconds = {name: round(run(name), 3) for name in HEADLINE}
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
