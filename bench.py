"""Time the headline queries and print one JSON line.

Tables are read from $BENCH_SF_DIR on local[$BENCH_CPUS]. Every query writes its whole
result to the noop sink; the time includes building the plan. One untimed query warms up the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallymark import session  # noqa: E402
from tallymark.bindings import QUERIES  # noqa: E402

HEADLINE = [
    "agg_state_stats", "agg_county_stats", "jn_left_upper_name", "jn_dim_assessments", "jn_golden",
    "jn_spatial_within", "jn_within_left", "jn_inner_key", "agg_race_scores", "agg_year_race",
    "agg_score_bands", "agg_pearson", "agg_trend_line", "agg_quantile_cuts", "agg_income_brackets",
    "agg_histogram", "agg_describe", "agg_insight_stats", "agg_count_distinct", "prj_json_expand",
    "prj_typed_cast", "win_distinct_on", "win_latest_wins", "win_dupe_rank", "win_schools_in_zip",
    "win_usage_admission", "win_yoy_diff", "rsh_melt", "top_n", "smp_seeded", "snk_insert_if_absent",
    "st_ingest_dedup", "st_usage_meter", "st_live_stats",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = session.local(cores, "bench")
    QUERIES["agg_state_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    found = re.search(r"sf([0-9.]+)$", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": float(found.group(1)) if found else None,
    }))


if __name__ == "__main__":
    main()
