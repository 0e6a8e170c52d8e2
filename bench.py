"""Times the headline queries: one warm-up, three timed runs with a full result, median reported.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from guestlens import catalog
from guestlens.session import local_session

HEADLINE = (
    "kruskal_wallis",
    "kruskal_wallis_events",
    "mann_whitney_u",
    "dunn_posthoc",
    "shapiro_wilk",
    "levene",
    "anova_oneway",
    "tukey_hsd",
    "pb1",
    "describe_overall",
    "describe_by_group",
    "describe_by_group5",
    "descriptive_report",
    "boxplot_stats",
    "histogram",
    "dedup_keep_first",
    "dedup_across_batches",
    "take_whole_pages",
    "score_distribution",
    "negative_rate",
    "language_id",
    "aspect_extract",
    "aspect_bigrams",
    "aspect_sentiment_crosstab",
    "page_card_extract",
    "section_fill_forward",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, shuffle_partitions=max(8, int(cores) if cores.isdigit() else 8), memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs[1:]), 3)
    sf = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cores": cores,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
