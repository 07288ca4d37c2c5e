"""Command line: ``spark-submit -m pageglean <job> ...``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pageglean.plans import jobs
from pageglean.session import build_session
from pageglean.sources import files
from pageglean.sources.store import Store


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pageglean")
    job = parser.add_subparsers(dest="job", required=True)

    def command(name: str, *required: str, **optional: str | None) -> None:
        sub = job.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            sub.add_argument(f"--{option.replace('_', '-')}", default=default)

    command("crawl", "pages", "seed", "urls", "date", skip="", fetch_log=None)
    crawl = job.choices["crawl"]
    crawl.add_argument("--strict", action="store_true")
    crawl.add_argument("--max-depth", type=int)
    command("purge", "mart", "domain", urls=None)
    command("classify", "mart", "urls", "pages", "keywords", "segment", "custom-segments", "date", channels=None)
    command("refresh", "mart", "warehouse", "exports", "domain", "date")
    command("publish", "warehouse", "keywords", "segment", "custom-segments", "out", "domain", "date", ids="[]")
    return parser


def main() -> None:
    args = arguments().parse_args()
    spark = build_session(f"pageglean {args.job}")
    run = f"{args.job}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S}"

    def table(path: str | None):
        return None if path is None else files.read_table(spark, path)

    if args.job == "crawl":
        jobs.crawl(table(args.pages), args.seed, args.urls, args.date, skipped=args.skip, fetch_log=table(args.fetch_log),
                   strict=args.strict, max_depth=args.max_depth)
    elif args.job == "purge":
        urls = None if args.urls is None else files.read_urls(spark, args.urls)
        print(jobs.purge(Store(spark, args.mart), urls, args.domain, run))
    elif args.job == "classify":
        jobs.classify(Store(spark, args.mart), files.read_urls(spark, args.urls), table(args.pages), table(args.keywords),
                      table(args.segment), table(args.custom_segments), args.date, run, channels=table(args.channels))
    elif args.job == "refresh":
        jobs.refresh_warehouse(Store(spark, args.mart), Store(spark, args.warehouse), args.exports, args.domain, args.date, run)
    elif args.job == "publish":
        jobs.publish_flags(Store(spark, args.warehouse), table(args.keywords), table(args.segment),
                           table(args.custom_segments), args.out, args.domain, args.date, args.ids)


if __name__ == "__main__":
    main()
