"""Command line: run the stages end to end, or one registered query.

    python -m marginflow build --out DIR (--testdata SF_DIR | --purchases P --purchase-prices P
                                          --vendor-invoice P --sales P) [--tier-reference CSV]
    python -m marginflow refresh --out DIR --batch NAME (--testdata SF_DIR | --purchases P ...)
    python -m marginflow text --out DIR (--testdata SF_DIR | --products-csv CSV)
    python -m marginflow query NAME --testdata SF_DIR [--show N]

Raw tables given as paths are read as Parquet with their explicit schemas.
``--out`` should be a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import json
import sys

from marginflow.session import build_session


def _raw_tables(spark, args, partial: bool = False):
    if args.testdata:
        from marginflow.sources import testdata
        return testdata.raw_tables(spark, args.testdata)
    from marginflow.sources import files, schemas
    paths = {"purchases": (args.purchases, schemas.PURCHASES),
             "purchase_prices": (args.purchase_prices, schemas.PURCHASE_PRICES),
             "vendor_invoice": (args.vendor_invoice, schemas.VENDOR_INVOICE),
             "sales": (args.sales, schemas.SALES)}
    missing = [k for k, (p, _) in paths.items() if not p]
    if missing and not partial:
        raise SystemExit(f"missing raw table paths: {', '.join(missing)} (or pass --testdata)")
    return {k: files.read_parquet(spark, p, s) for k, (p, s) in paths.items() if p}


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="marginflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("build", help="raw tables -> summary -> clean -> stats/ML outputs")
    r = sub.add_parser("refresh", help="new raw rows -> summary, from stored partial sums")
    for s in (p, r):
        s.add_argument("--out", required=True)
        s.add_argument("--testdata")
        for name in ("purchases", "purchase-prices", "vendor-invoice", "sales"):
            s.add_argument(f"--{name}")
        s.add_argument("--buckets", type=int, default=None)
    p.add_argument("--tier-reference")
    r.add_argument("--batch", required=True, help="name of the batch; a name counts once")
    t = sub.add_parser("text", help="transactions -> product text clusters")
    t.add_argument("--out", required=True)
    t.add_argument("--testdata")
    t.add_argument("--products-csv")
    t.add_argument("--stop-words", help="text file of words to leave out, one a line (default: Spark's English list)")
    q = sub.add_parser("query", help="run one registered query and print rows")
    q.add_argument("name")
    q.add_argument("--testdata", required=True)
    q.add_argument("--show", type=int, default=20)
    for s in (p, r, t, q):
        s.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)

    spark = spark or build_session(args.master)
    from marginflow.plans import jobs
    if args.cmd == "build":
        summary = jobs.build_summary_job(_raw_tables(spark, args), args.out, args.buckets)
        reliable, metrics = jobs.clean_job(summary, args.out)
        out = jobs.stats_ml_job(reliable, args.out, args.tier_reference)
        result = {"clean_metrics": metrics, "vendors": out["vendor"].count()}
        if "agreement" in out:
            result["tier_agreement"] = out["agreement"].first().asDict()
        print(json.dumps(result))
    elif args.cmd == "refresh":
        table = jobs.refresh_summary_job(spark, args.batch, _raw_tables(spark, args, partial=True), args.out, args.buckets)
        print(json.dumps({"batch": args.batch, "rows": table.count()}))
    elif args.cmd == "text":
        if args.testdata:
            from marginflow.sources import testdata
            tx = testdata.products(spark, args.testdata)
        elif args.products_csv:
            tx = jobs.read_products_csv(spark, args.products_csv)
        else:
            raise SystemExit("pass --testdata or --products-csv")
        stop_words = None
        if args.stop_words:
            stop_words = sorted({r[0].strip().lower() for r in spark.read.text(args.stop_words).collect()} - {""})
        out = jobs.text_job(tx, args.out, stop_words=stop_words)
        for r in out["summary"].collect():
            print(json.dumps(r.asDict()))
    else:
        from marginflow.plans.catalog import QUERIES
        if args.name not in QUERIES:
            raise SystemExit(f"unknown query {args.name!r}; known: {', '.join(sorted(QUERIES))}")
        QUERIES[args.name](spark, args.testdata).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
