"""Write the final (post-AQE) physical plans of the headline questions to
PLANS.md, after running each once at the given scale.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postlake.plans.registry import QUERIES  # noqa: E402
from postlake.session import local_session  # noqa: E402

KEYS = ["clean_posts", "category_counts_by_country", "posts_per_category_year", "top_user_by_country",
        "join_three_way", "category_counts_by_age_group", "median_followers_by_age_group", "stream_posts"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    out = ["# PLANS", "",
           f"Final physical plans (after AQE) of the headline queries at `{os.path.basename(sf_dir)}`,",
           "`local[8]`, 16 shuffle partitions. Generated by `tools/explain_plans.py`; file paths shortened.", ""]
    for key in KEYS:
        df = QUERIES[key](spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()  # runs this very plan; no rows come to the driver
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"file:/\S+?/(lake|streams)/\S*", r"<scratch>/\1/…", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        text = plan.split("+- == Initial Plan ==")[0].rstrip()
        out += [f"## {key}", "", "```", text, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
