"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Method: one warm-up pass over all queries, then the median of $BENCH_RUNS timed
runs per query;
each run executes the full plan into the ``noop`` sink (no collect to the
driver). ``catalogue_one_pass_sec`` times the same set produced by
``plans.batch`` (one checkpointed cube per source). Prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crashgrid.plans import batch, catalogue  # noqa: E402
from crashgrid.session import build_session, checkpoint_dir  # noqa: E402


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(catalogue.QUERIES)

    spark = build_session(
        master=f"local[{cpus}]",
        app_name="crashgrid-bench",
        shuffle_partitions=cpus,
        extra_conf={"spark.eventLog.enabled": "false"},
    )
    checkpoint_dir(spark)  # the configured shared folder, or a temp one in local mode

    def once(name: str) -> float:
        t0 = time.perf_counter()
        catalogue.run(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:
        once(name)  # warm-up pass over every query first: JIT, table resolution
    results: dict[str, float] = {}
    for name in names:
        results[name] = round(statistics.median(once(name) for _ in range(runs)), 4)

    def catalogue_once() -> float:
        t0 = time.perf_counter()
        for df in batch.batch_frames(spark, sf_dir, names).values():
            df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    catalogue_once()  # warm-up
    one_pass = round(statistics.median(catalogue_once() for _ in range(runs)), 4)

    total = round(sum(results.values()), 4)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": results,
        "sf": _sf(sf_dir),
        "catalogue_one_pass_sec": one_pass,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
