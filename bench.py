"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected on the driver). The session start and a warm-up of the
same code paths on the smallest data set (sf0.001: JIT, code generation,
Spark ML class loading) are not timed, so the numbers are steady-state.
``lda_text_topics`` is the whole text pipeline: tokens, vocabulary, vectors, EM
over every document, described topics.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from termflow.plans import QUERIES  # noqa: E402
from termflow.session import local_session  # noqa: E402

HEADLINE = [
    "term_counts",
    "vocabulary",
    "doc_term_tf",
    "word_count_raw",
    "top_terms_by_label",
    "top_scores",
    "price_position",
    "lda_numeric",
    "lda_text_topics",
]
WARMUP_DIR = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    only = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, cpus, app="termflow-bench",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="termflow-bench-"),
                                 "spark.driver.memory": "16g"})
    # Untimed warm-up on the smallest data: JIT and code generation, not query work.
    if os.path.isdir(WARMUP_DIR):
        for name in ("term_counts", "price_position", "lda_numeric"):
            QUERIES[name](spark, WARMUP_DIR).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in only:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
