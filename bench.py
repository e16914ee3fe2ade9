"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion with the ``noop`` sink (full plan, no
collect); one warm-up pass, then the median of ``$BENCH_RUNS`` timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from touchpath.plans import registry  # noqa: E402
from touchpath.session import get_session  # noqa: E402

HEADLINE = ["attribution_events", "chains_base", "conversion_chains", "chain_concatenation", "channel_stats",
            "attr_markov", "attribution_results", "perimeter_recap", "channel_recap"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    qs = registry.queries()
    for name in HEADLINE:  # warm-up: JIT, file listing, Python workers
        run(qs[name](spark, sf_dir))
    timings = {}
    for name in HEADLINE:
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            run(qs[name](spark, sf_dir))
            samples.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
