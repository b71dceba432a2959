"""Whole pipelines: crawl, enrich, export."""
