"""Time the headline queries: BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import checks.queries  # noqa: E402,F401
from checks.base import QUERIES  # noqa: E402
from checks.compare import session  # noqa: E402
from reclink.session import configure  # noqa: E402
from reclink.sources.adapters import STORED, Tables  # noqa: E402

HEADLINES = [
    "clean_disclosure",
    "slugify",
    "add_provenance",
    "upsert_listings",
    "new_employers",
    "update_employers",
    "address_mentions",
    "update_addresses",
    "block_keys",
    "candidate_pairs",
    "score_pairs",
    "cluster_pairs",
    "link_records",
    "canonical_values",
    "canonicalize_all",
    "stream_seen",
]


def timed(spark, folder: str, name: str) -> float:
    """Seconds to build and run a query to the end, without keeping its rows."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    spark = configure(session(os.environ.get("BENCH_CPUS", "8")))
    # The derived raw tables stand for stored ones, so writing them is not part of a query.
    for table in STORED:
        Tables(spark, folder)(table)
    seconds = {n: round(statistics.median(timed(spark, folder, n) for _ in range(runs)), 3) for n in names}
    report = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
