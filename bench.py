"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagemill.catalogue import load_all  # noqa: E402
from pagemill.session import build_session  # noqa: E402

HEADLINES = (
    "url_canonical", "page_dedup_keep_first", "links_same_host", "link_density_by_host", "normalize_network_url",
    "content_class", "page_title", "html_text", "html_sections", "html_chunks", "token_estimate", "tokens_by_source",
    "reduce_text", "line_dedup_24", "chunk_plain", "chunk_overlap", "split_words", "pattern_matches", "skills_extract",
    "title_lookup", "field_groups", "fill_pending", "alias_coalesce", "submission_projection", "run_summary",
    "pacing_replay", "breaker_replay", "budget_gate", "bfs_depth3", "frontier_spawn", "crawl_graph", "product_page",
    "entity_graph", "atom_paper", "css_fields", "page_meta", "long_pages", "flatten_deep", "crawl_structured",
    "merged_payloads", "network_documents", "crawl_three_levels", "expand_entities", "variant_prices", "json_pointer",
    "search_subtitles", "normalised_errors", "enrich_budget",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load_all()
    # One warm-up job starts the Python workers and loads the engine; it is not timed.
    queries["page_title"](spark, sf_dir.replace("sf0.1", "sf0.01")).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "warm_up": "page_title at sf0.01, not timed", "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
