"""Write the physical plans of the headline queries to PLANS.md.

    python scripts/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termflow.plans import QUERIES  # noqa: E402
from termflow.session import local_session  # noqa: E402

NAMES = ["term_counts", "vocabulary", "doc_term_tf", "word_count_raw", "top_terms_by_label",
         "top_scores", "price_bars", "price_position", "quality_term_counts"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="plans-")})
    out = ["# Physical plans", "",
           f"Generated by `scripts/dump_plans.py` on `{os.path.basename(sf_dir)}`, local[8], "
           "8 shuffle partitions, before AQE re-planning. Long expressions are cut at 160 "
           "characters; checkpoint folders show as `ExistingRDD`. The `RoundRobinPartitioning` "
           "exchange right after a scan is `spread()`: the test tables are single parquet row "
           "groups; a large table has many splits and gets no such exchange.", ""]
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        lines = [ln if len(ln) <= 160 else ln[:157] + "..." for ln in plan.splitlines()]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
