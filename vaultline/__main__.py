"""Run one warehouse batch: ``python -m vaultline SOURCE OUT [options]``.

On a cluster, submit a driver script that calls ``vaultline.__main__.main``
(or ``build_warehouse``) with ``spark-submit``; ``spark.checkpoint.dir`` must
name shared storage.  Prints the rows appended per vault table as JSON.
"""

from __future__ import annotations

import argparse
import json

from vaultline.plans.build import build_warehouse
from vaultline.session import get_spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="vaultline", description=__doc__.splitlines()[0])
    p.add_argument("source", help="root of the source tables (<name>.parquet each)")
    p.add_argument("out", help="warehouse root; layers are written under it")
    p.add_argument("--load-date", default=None, help="batch timestamp (default: now, UTC)")
    p.add_argument("--as-of", default=None,
                   help="as-of day of the point-in-time snapshot (default: today, UTC)")
    p.add_argument("--csv-feeds", default=None,
                   help="read the 13 feeds from this bronze CSV root instead of the tables")
    p.add_argument("--vault-buckets", type=int, default=None,
                   help="declare vault targets bucketed by hash key into N buckets")
    p.add_argument("--vault-database", default="raw_vault_parts")
    p.add_argument("--catalog", action="store_true",
                   help="publish the tables as views, one database per layer")
    p.add_argument("--catalog-prefix", default="", help="prefix of the database names")
    p.add_argument("--fail-on-test-failures", action="store_true",
                   help="exit with an error when any data test fails")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    args = p.parse_args(argv)

    spark = get_spark(args.master)
    feed_source = None
    if args.csv_feeds:
        from vaultline.sources.feeds import scan_feed

        def feed_source(name: str):
            return scan_feed(spark, args.csv_feeds, name)

    appended = build_warehouse(
        spark, args.source, args.out, load_date=args.load_date, as_of=args.as_of,
        feed_source=feed_source, vault_buckets=args.vault_buckets,
        vault_database=args.vault_database, fail_on_test_failures=args.fail_on_test_failures,
        catalog=args.catalog, catalog_prefix=args.catalog_prefix)
    print(json.dumps(appended, sort_keys=True))


if __name__ == "__main__":
    main()
