"""Graph traversal: reachability, frontier spawning, crawl over the page table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalogue import query, table
from pagemill.catalogue.url_queries import LINKS_SQL
from pagemill.functions import url as U
from pagemill.operators import frontier as G
from pagemill.operators import links as L


def order_part_edges(spark, sf_dir):
    """Orders and parts as a two-sided graph; parts have negative numbers."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o"), (-F.col("l_partkey") - 1).alias("p")
    ).distinct()
    return lines.select(F.col("o").alias("src"), F.col("p").alias("dst")).unionByName(
        lines.select(F.col("p").alias("src"), F.col("o").alias("dst"))
    )


@query(
    """WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT l_orderkey AS o, -l_partkey - 1 AS p FROM lineitem),
         edges AS MATERIALIZED (SELECT o AS src, p AS dst FROM e UNION ALL SELECT p, o FROM e),
         r AS (SELECT min(o_orderkey) AS node, 0 AS depth FROM orders GROUP BY o_orderpriority
           UNION SELECT dst, depth + 1 FROM r JOIN edges ON src = node WHERE depth < 3)
       SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY node"""
)
def bfs_depth3(spark, sf_dir):
    seeds = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("node"))
    return G.bfs_levels(order_part_edges(spark, sf_dir), seeds, 3)


@query(
    """WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT l_orderkey AS o, -l_partkey - 1 AS p FROM lineitem),
         edges AS MATERIALIZED (SELECT o AS src, p AS dst FROM e UNION ALL SELECT p, o FROM e),
         r AS (SELECT min(o_orderkey) AS node, 0 AS depth FROM orders GROUP BY o_orderpriority
           UNION SELECT dst, depth + 1 FROM r JOIN edges ON src = node WHERE depth < 2)
       SELECT CASE WHEN node < 0 THEN 'part' ELSE 'order' END AS entity_type, count(DISTINCT node) AS n FROM r GROUP BY 1"""
)
def discovered_by_type(spark, sf_dir):
    seeds = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("node"))
    nodes = G.bfs_levels(order_part_edges(spark, sf_dir), seeds, 2)
    return G.discovered_by_type(nodes, F.when(F.col("node") < 0, F.lit("part")).otherwise(F.lit("order")))


@query(
    f"""WITH {LINKS_SQL}, seen AS (SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS u FROM pages),
        c AS (SELECT link, page_id, position, url, row_number() OVER (PARTITION BY link ORDER BY page_id, position) AS rn FROM links)
        SELECT link AS canonical_url, page_id AS parent_order, position, url AS parent_url FROM c
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM seen WHERE u = link)"""
)
def frontier_spawn(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("parent_order"), "url", "html", F.lit("generic").alias("platform"))
    links = L.page_links(F.col("url"), L.bare_anchors(F.col("html")))
    rows = L.explode_links(pages, links)
    seen = pages.select("platform", U.without_query(F.col("url")).alias("canonical_url")).distinct()
    return G.spawn(rows, seen).select("canonical_url", "parent_order", "position", "parent_url")


@query(
    f"""WITH first AS (SELECT min(page_id) AS page_id FROM pages GROUP BY url),
        seeds AS (SELECT page_id, url, html FROM pages JOIN first USING (page_id)),
        {LINKS_SQL.replace('FROM pages)', 'FROM seeds)')},
        fresh AS (SELECT link, page_id, url, row_number() OVER (PARTITION BY link ORDER BY page_id, position) AS rn FROM links
          WHERE link NOT IN (SELECT url FROM seeds))
        SELECT url AS canonical_url, url AS seed_url, 0 AS hop_depth, 'done' AS state FROM seeds
        UNION ALL SELECT link, url, 1, 'failed' FROM fresh WHERE rn = 1"""
)
def crawl_graph(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    first = pages.groupBy("url").agg(F.min("page_id").alias("ord"))
    seeds = first.select(F.lit("generic").alias("platform"), F.col("url").alias("canonical_url"), F.lit(1.0).alias("priority"), "ord")
    fetched = pages.join(first, (pages["page_id"] == first["ord"]), "left_semi").select("url", "html")
    records, errors = G.crawl(seeds, fetched, max_depth=2, max_pages=None)
    keep = ["canonical_url", "seed_url", "hop_depth"]
    return records.select(*keep, F.lit("done").alias("state")).unionByName(errors.select(*keep, F.lit("failed").alias("state")))


@query(
    """SELECT url AS canonical_url, page_id AS ord FROM pages ORDER BY length(html) DESC, page_id LIMIT 100"""
)
def crawl_budget(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    seeds = pages.select(
        F.lit("generic").alias("platform"), F.concat(F.col("url"), F.lit("#"), F.col("page_id").cast("string")).alias("canonical_url"),
        F.length("html").cast("double").alias("priority"), F.col("page_id").alias("ord"),
    )
    keyed = pages.select(F.concat(F.col("url"), F.lit("#"), F.col("page_id").cast("string")).alias("url"), "html")
    records, _ = G.crawl(seeds, keyed, max_depth=0, max_pages=100)
    return records.select(
        F.regexp_replace("canonical_url", r"#\d+$", "").alias("canonical_url"),
        F.regexp_extract("canonical_url", r"#(\d+)$", 1).cast("bigint").alias("ord"),
    )
