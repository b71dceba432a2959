"""Command line: discover-crawl, crawl, run, enrich, fill-enrichment, export-submissions."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import functions as F

from pagemill.operators import enrich as E
from pagemill.operators import export as X
from pagemill.operators.alias import candidates
from pagemill.operators.frontier import MAX_DEPTH, crawl
from pagemill.operators.traverse import traverse
from pagemill.plans.batch import joined_with_pages
from pagemill.plans.crawl import crawl_records
from pagemill.plans.enrich import enrich_records, fill
from pagemill.session import build_session
from pagemill.sinks.files import write_jsonl, write_requests, write_run
from pagemill.sources import files as S


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="pagemill", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("discover-crawl", "crawl", "run", "enrich", "fill-enrichment", "export-submissions"):
        sub = commands.add_parser(name)
        sub.add_argument("--input", required=True)
        sub.add_argument("--output", required=True)
        sub.add_argument("--pages", help="table of fetched pages (parquet); the input is then records (JSON lines)")
        sub.add_argument("--css-schema", help="fields by CSS selector (JSON)")
        sub.add_argument("--done", help="addresses completed before (parquet)")
        sub.add_argument("--registry", help="field-group registry (JSON lines)")
        sub.add_argument("--dictionary", help="title dictionary (JSON lines)")
        sub.add_argument("--field-groups", nargs="*", default=[])
        sub.add_argument("--responses", help="answers to pending groups (JSON)")
        sub.add_argument("--dataset-id", default="")
        sub.add_argument("--generated-at")
        sub.add_argument("--max-depth", type=int, default=MAX_DEPTH)
        sub.add_argument("--max-pages", type=int, help="default: no limit")
        sub.add_argument("--strict", action="store_true")
    return out


def main(argv: list[str] | None = None) -> int:
    """Exit code 1 when a run that must be clean has errors."""
    args = parser().parse_args(argv)
    spark = build_session()
    if args.command in ("crawl", "run"):
        done = spark.read.parquet(args.done) if args.done else None
        schema = json.loads(Path(args.css_schema).read_text()) if args.css_schema else None
        if args.pages:
            found, errors = joined_with_pages(S.read_records(spark, args.input), spark.read.parquet(args.pages), done)
            results = crawl_records(found, css_schema=schema).unionByName(errors, allowMissingColumns=True)
        else:
            results = crawl_records(spark.read.parquet(args.input), done, css_schema=schema)
        results = results.persist()
        write_run(results, args.output)
        failures = results.filter(F.col("status") == "failed").count()
        if args.command == "run":
            _enrich(spark, results.filter(F.col("status") == "success").drop("chunks", "sections"), args)
        return 1 if failures and (args.strict or args.command == "run") else 0
    if args.command == "enrich":
        _enrich(spark, spark.read.json(args.input), args)
        return 0
    if args.command == "fill-enrichment":
        results = spark.read.parquet(args.input)
        fill(results, S.read_responses(spark, args.responses)).write.mode("overwrite").parquet(args.output)
        return 0
    if args.command == "discover-crawl":
        given = candidates(S.read_records(spark, args.input))
        refused = given.filter(F.col("error").isNotNull()).select("platform", "canonical_url", F.col("error").alias("error_code"))
        seeds = given.filter(F.col("error").isNull()).select(
            "platform", "canonical_url", F.col("score").alias("priority"), F.monotonically_increasing_id().alias("ord")
        )
        pages = spark.read.parquet(args.pages)
        if "platform" in pages.columns and args.max_pages is None:
            kinds = given.select("platform", "canonical_url", "resource_type").dropDuplicates(["platform", "canonical_url"])
            records, errors = traverse(seeds.join(kinds, ["platform", "canonical_url"]), pages, args.max_depth)
        else:
            records, errors = crawl(seeds, pages, args.max_depth, args.max_pages)
        write_jsonl(records, f"{args.output}/records.jsonl")
        errors = errors.unionByName(refused, allowMissingColumns=True)
        write_jsonl(errors, f"{args.output}/errors.jsonl")
        return 1 if args.strict and not errors.isEmpty() else 0
    entries = X.submission_entries(spark.read.json(args.input), args.dataset_id, F.lit(args.generated_at))
    write_requests(X.submission_requests(entries), args.output)
    return 0


def _enrich(spark, records, args) -> None:
    registry = E.builtin_groups(spark)
    if args.registry:
        registry = registry.unionByName(S.read_registry(spark, args.registry))
    dictionary = S.read_dictionary(spark, args.dictionary) if args.dictionary else None
    enrich_records(records, registry, dictionary, args.field_groups).write.mode("overwrite").parquet(f"{args.output}/enrichment")


if __name__ == "__main__":
    raise SystemExit(main())
