"""Command line for one load of the lake (spark-submit friendly).

    spark-submit --py-files vaultline.zip -m vaultline.plans.run \\
        --lake s3://bucket/bank --as-of "2026-01-01 00:00:00" \\
        --customers s3://landing/customers.csv --accounts s3://landing/accounts.csv \\
        --transactions s3://landing/transactions/ --publish-db gold

Prints the written paths and the observed transaction quality counts as
one JSON line.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json

from vaultline.config import FIXTURE, SOURCE, RiskConfig
from vaultline.plans import jobs
from vaultline.session import get_spark

SOURCE_ARGS = ("customers", "accounts", "complaints", "credit_history", "transactions")


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="vaultline.plans.run")
    ap.add_argument("--lake", required=True, help="base folder of the lake on shared storage")
    ap.add_argument("--as-of", default=None, help="load instant 'YYYY-MM-DD HH:MM:SS' (default: now, UTC)")
    for name in SOURCE_ARGS:
        ap.add_argument(f"--{name.replace('_', '-')}", dest=name, default=None, help=f"raw {name} file or folder")
    ap.add_argument("--multiline-json", action="store_true", default=None, help="transactions are whole-file JSON documents (found out if not given)")
    ap.add_argument("--publish-db", default=None, help="register gold outputs in this catalog database")
    ap.add_argument("--fixture-thresholds", action="store_true", help="use the test-data thresholds")
    ap.add_argument("--config", default=None, help="JSON file overriding RiskConfig fields, e.g. {\"high_amount\": 10000}")
    args = ap.parse_args(argv)
    cfg = FIXTURE if args.fixture_thresholds else SOURCE
    if args.config:
        with open(args.config) as f:
            overrides = json.load(f)
        unknown = set(overrides) - {fl.name for fl in dataclasses.fields(RiskConfig)}
        if unknown:
            ap.error(f"unknown RiskConfig fields: {sorted(unknown)}")
        cfg = dataclasses.replace(cfg, **{k: tuple(v) if isinstance(v, list) else v for k, v in overrides.items()})

    as_of = args.as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    raw = {n: getattr(args, n) for n in SOURCE_ARGS if getattr(args, n)}
    spark = get_spark()
    out = jobs.run_jobs(
        spark, jobs.Lake(args.lake.rstrip("/")), raw, as_of, cfg,
        json_multiline=args.multiline_json, publish_db=args.publish_db,
    )
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
