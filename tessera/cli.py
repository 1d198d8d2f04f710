"""Commands over landed files: ``python -m tessera.cli COMMAND ...``; see the README."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import detect, discover, leads, promote, run
from tessera.plans import report
from tessera.sources import landed


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tessera")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("run", help="merge a day's landed payloads into both snapshots")
    one.add_argument("--configs", required=True, help="Parquet of (ord, company, source, url, enabled)")
    one.add_argument("--landed", required=True, help="Parquet of (source, company, payload, ord, ok)")
    one.add_argument("--active", required=True)
    one.add_argument("--archived", required=True)
    one.add_argument("--out", required=True, help="folder of the new snapshots; the old ones stay")
    one.add_argument("--as-of", required=True)
    one.add_argument("--source", action="append", dest="sources", help="one or more sources, repeated or comma-separated")
    one.add_argument("--workers", type=int, default=1, help="companies at a time; Spark's own parallelism bounds it")
    one.add_argument("--workday-search-workers", type=int, default=None)
    one.add_argument("--strict-touch", action="store_true", help="a failed fetch does not count as touched")
    two = commands.add_parser("detect", help="platforms behind career pages")
    two.add_argument("--input", action="append", required=True, help="CSV of companies; may be repeated")
    pages = two.add_mutually_exclusive_group(required=True)
    pages.add_argument("--pages", help="landed pages as JSON lines")
    pages.add_argument("--fetcher", help="module:function that pages are asked from, such as tessera.sources.fetching:http_get")
    two.add_argument("--workers", type=int, default=8, help="fetches at a time in a task")
    two.add_argument("--out", required=True)
    two.add_argument("--limit", type=int, default=0, help="only the first N inputs; 0: all")
    two.add_argument("--max-pages", type=int, default=2)
    two.add_argument("--checkpoint-every", type=int, default=0, help="companies a part; a later call does the parts that are missing")
    three = commands.add_parser("discover", help="career pages in records")
    three.add_argument("--root", required=True)
    three.add_argument("--out", required=True)
    three.add_argument("--report", required=True)
    four = commands.add_parser("promote", help="review candidates against the catalog")
    four.add_argument("--candidates", required=True)
    four.add_argument("--sources", required=True)
    four.add_argument("--review", required=True)
    four.add_argument("--apply", help="folder of the catalog with what was accepted")
    five = commands.add_parser("compile", help="catalog rows to configs")
    five.add_argument("--sources", required=True)
    five.add_argument("--owners", required=True, help="Parquet of (company, source, url)")
    five.add_argument("--out", required=True)
    return parser.parse_args(argv)


def _numbered(rows: DataFrame) -> DataFrame:
    """``ord`` by the place in one file, which a reader of whole lines does not split."""
    return rows.withColumn("ord", F.monotonically_increasing_id())


def _named(path: str):
    module, _, name = path.partition(":")
    return getattr(import_module(module), name)


def _records(spark: SparkSession, root: str) -> DataFrame:
    parts = None
    for i, r in enumerate(landed.find_files(spark, root).collect()):  # one row per file
        rows = landed.read_records(spark, r["path"])
        walked = "record" in rows.columns and "ord" in rows.columns
        record, place = (F.col("record"), F.col("ord").cast("long")) if walked else (F.to_json(F.struct("*")), F.monotonically_increasing_id())
        rows = rows.select(record.alias("record"), F.lit(r["path"]).alias("file"), (F.lit(i << 40) + place).alias("ord"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts if parts is not None else spark.createDataFrame([], "record string, file string, ord bigint")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "run":
        configs = run.with_search_workers(spark.read.parquet(args.configs), max(1, args.workday_search_workers) if args.workday_search_workers is not None else None)
        out = run.daily_run(configs, spark.read.parquet(args.landed), spark.read.parquet(args.active), spark.read.parquet(args.archived), args.as_of, sources=run.parse_sources(args.sources), strict_touch=args.strict_touch)
        out.active.withColumn("ord", F.monotonically_increasing_id()).write.parquet(f"{args.out}/active")
        out.archived.withColumn("ord", F.monotonically_increasing_id()).write.parquet(f"{args.out}/archived")
        for r in out.counts.collect():
            print(f"- {r['name']}: {r['n']}")
    elif args.command == "detect":
        tables = [_numbered(landed.read_csv(spark, path, "company string", exact=False)) for path in args.input]
        companies = landed.company_inputs(*tables, placed=True).withColumnRenamed("career_url", "url")
        companies = companies.orderBy("ord").limit(args.limit) if args.limit else companies  # the first inputs
        pages = detect.fetched_pages(_named(args.fetcher), workers=args.workers) if args.fetcher else landed.read_pages(spark, args.pages)
        most = min(8, max(1, args.max_pages))
        if args.checkpoint_every:
            detect.detect_in_parts(companies, pages, args.out, every=args.checkpoint_every, max_pages=most, progress=lambda k, n: print(f"{k}/{n} parts", flush=True))
        else:
            report.save_candidates(detect.in_order(detect.detect(companies, pages, max_pages=most)), args.out)
    elif args.command == "discover":
        report.save_discovered(*discover.discover(_records(spark, args.root)), args.out, args.report)
    elif args.command == "promote":
        candidates = _numbered(landed.read_csv(spark, args.candidates, "company string", exact=False))
        sources = _numbered(landed.read_csv(spark, args.sources, landed.SOURCES))
        additions, review = promote.promotion(candidates, sources)
        report.save_review(review, args.review)
        if args.apply:
            report.save_csv(leads.with_additions(sources, additions).orderBy("ord"), args.apply, ["company", "url", "enabled"])
    elif args.command == "compile":
        configs, cleaned = leads.compile_catalog(_numbered(landed.read_csv(spark, args.sources, landed.SOURCES)), spark.read.parquet(args.owners))
        configs.write.parquet(f"{args.out}/configs")
        report.save_csv(cleaned, f"{args.out}/sources", ["company", "url", "enabled"])


if __name__ == "__main__":
    main()
