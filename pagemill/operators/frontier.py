"""Graph traversal, one level at a time.

Every level is a join, a de-duplication and an anti-join against what has been seen. The lineage
is cut per level with a reliable checkpoint, so a lost executor costs one level at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.keyed import keep_first
from pagemill.operators.links import bare_anchors, explode_links, page_links
from pagemill.operators.replay import take_first
from pagemill.session import cut_lineage

# Fixed value: default depth of a crawl.
MAX_DEPTH = 2


def bfs_levels(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """Nodes reachable from ``seeds(node)`` over ``edges(src, dst)`` with their hop depth."""
    level = cut_lineage(seeds.select("node").distinct().withColumn("depth", F.lit(0)))
    seen = level
    for depth in range(1, max_depth + 1):
        step = (
            level.join(edges, level["node"] == edges["src"])
            .select(F.col("dst").alias("node"))
            .distinct()
            .join(seen.select("node"), "node", "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        level = cut_lineage(step)
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    return seen


def discovered_by_type(nodes: DataFrame, kind: Column) -> DataFrame:
    """Distinct discovered addresses per entity type."""
    return nodes.groupBy(kind.alias("entity_type")).agg(F.count_distinct("node").alias("n"))


def spawn(links: DataFrame, seen: DataFrame) -> DataFrame:
    """New candidates: first spawned link per (platform, address) that was not seen before."""
    key = ["platform", "canonical_url"]
    return keep_first(links, key, ["parent_order", "position"]).join(seen.select(*key), key, "left_anti")


def crawl(
    seeds: DataFrame,
    pages: DataFrame,
    max_depth: int = MAX_DEPTH,
    max_pages: int | None = None,
    links: Column | None = None,
    visited: DataFrame | None = None,
    allow_external: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Traverse from seeds over a table of fetched pages.

    ``seeds`` has ``platform, canonical_url, priority, ord``; ``pages`` has one row per ``url`` with ``html``. Gives
    the records (crawled candidates) and the errors (candidates without a page). ``visited`` are
    the keys of an earlier run: they are not crawled again. The page budget is exact: within a
    level the highest priority goes first, then the order of discovery.
    """
    key = ["platform", "canonical_url"]
    if links is None:
        links = page_links(F.col("url"), bare_anchors(F.col("html")), allow_external=allow_external)
    # ``ord`` is the path of positions that led to a candidate: it orders a level by discovery.
    level = keep_first(seeds, key, [F.col("priority").desc(), "ord"]).select(
        *key, "priority", F.array(F.col("ord").cast("long")).alias("ord"), F.lit(0).alias("hop_depth"),
        F.lit(None).cast("string").alias("parent_url"), F.col("canonical_url").alias("seed_url"),
    )
    if visited is not None:
        level = level.join(visited.select(*key).distinct(), key, "left_anti")
    level = cut_lineage(level)
    seen = level.select(*key) if visited is None else level.select(*key).unionByName(visited.select(*key))
    records, errors, left = [], [], max_pages
    for depth in range(max_depth + 1):
        failed = level.join(pages.select("url"), F.col("canonical_url") == F.col("url"), "left_anti").select(
            *key, "seed_url", "hop_depth", F.lit("DISCOVERY_CRAWL_FAILED").alias("error_code")
        )
        chosen = level
        if left is not None:
            # The budget is spent on keys alone; page bodies join afterwards.
            known = level.join(pages.select("url"), F.col("canonical_url") == F.col("url"), "left_semi")
            ranked = known.withColumn("_last", -F.col("priority"))
            chosen = take_first(ranked, ["_last", "ord", *key], left).drop("_last")
        done = cut_lineage(chosen.join(pages, F.col("canonical_url") == F.col("url")))
        records.append(done.select(*key, "seed_url", "parent_url", "hop_depth", "priority"))
        errors.append(failed)
        if left is not None:
            left -= done.count()
            if left <= 0:
                break
        if depth == max_depth:
            break
        rows = explode_links(
            done.select("platform", "seed_url", "url", "html", F.col("ord").alias("parent_order")), links
        )
        fresh = spawn(rows, seen).select(
            *key, F.col("score").alias("priority"),
            F.concat("parent_order", F.array(F.col("position").cast("long"))).alias("ord"),
            F.lit(depth + 1).alias("hop_depth"), "parent_url", "seed_url",
        )
        level = cut_lineage(fresh)
        if level.isEmpty():
            break
        seen = seen.unionByName(level.select(*key))
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    return union(records), union(errors)


def checkpoint_counts(frontier: DataFrame, visited: DataFrame) -> dict[str, str]:
    """Cursor of a run: how many frontier and visited rows it has."""
    return {"frontier_cursor": str(frontier.count()), "visited_cursor": str(visited.count())}
