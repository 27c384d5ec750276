"""Command line: build the lakehouse from CSV sources.

    python -m reelhouse --src s3a://bucket/raw --root s3a://bucket/lake \\
        [--years 2022 2023] [--database gold]
"""

from __future__ import annotations

import argparse
import json


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="reelhouse")
    ap.add_argument("--src", required=True, help="folder with movies/links/ratings/tags.csv")
    ap.add_argument("--root", required=True, help="table root on shared storage")
    ap.add_argument("--years", type=int, nargs="*", help="rating years to (re)load")
    ap.add_argument("--database", help="catalog database for the gold tables")
    args = ap.parse_args(argv)

    from reelhouse.plans.build import build_lakehouse
    from reelhouse.session import build_session

    spark = build_session()
    out = build_lakehouse(spark, args.root, src_dir=args.src, years=args.years,
                          database=args.database)
    for report in out["reports"]:
        print(json.dumps({k: v for k, v in report.items() if k != "schema"}))
    failed = [r.check for r in out["checks"].filter("NOT passed").collect()]
    if out["bronze_checks"] is not None:
        failed += [r.check for r in out["bronze_checks"].filter("NOT passed").collect()]
    print(json.dumps({"registered": out["registered"], "failed_checks": failed}))


if __name__ == "__main__":
    main()
