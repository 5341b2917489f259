"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from litsieve.session import build_session  # noqa: E402

HEADLINE = (
    "normalize_records",
    "keyword_hits",
    "relevance_filter",
    "classify",
    "finalize_review",
    "manual_decisions",
    "dedupe_clusters",
    "dedupe_survivors",
    "glossary_candidates",
    "token_suggestions",
    "display_order",
    "digest_order",
    "digest_sections",
    "digest_export",
    "feed_rss",
    "html_links",
    "clean_text",
    "glossary_apply",
    "localize",
    "digest_windows",
    "window_stats",
    "limit_per_source",
    "stream_digest",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    from litsieve.plans.queries import queries

    chosen = queries()
    # Two queries first, so that neither session start-up nor that of the Python workers is charged to the first entry.
    for name in ("canonical_url", "normalize_records"):
        chosen[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        chosen[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
