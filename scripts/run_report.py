"""Run the whole reporting job and write every output: the report sections,
the saved region x category matrix, and (unless --no-ml) the regression's
predictions and metrics.

    spark-submit scripts/run_report.py --star /data/sf100 --out /reports/today
    python scripts/run_report.py --csv /landing/retail/ --out /tmp/report --no-ml

On a cluster the master and spark.checkpoint.dir come from spark-submit;
without --master only a local run falls back to a scratch checkpoint folder.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.config import DEFAULT, RETAIL  # noqa: E402
from ledgerline.plans.report import run_report  # noqa: E402
from ledgerline.session import build_session, size_partitions  # noqa: E402
from ledgerline.sources.csv import load_retail_fact  # noqa: E402
from ledgerline.sources.star import bind_fact, line_shuffle_bytes  # noqa: E402


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--star", help="folder of the star-schema parquet tables")
    src.add_argument("--csv", help="retail CSV file or folder of part files")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--no-ml", action="store_true", help="skip the regression")
    ap.add_argument("--split", choices=("random", "stable"), default="random",
                    help="train/test split of the regression (default: the reference's random)")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.star:
        size_partitions(spark, line_shuffle_bytes(spark, args.star))
        fact, cfg = bind_fact(spark, args.star), DEFAULT
    else:
        fact, cfg = load_retail_fact(spark, args.csv), RETAIL
    written = run_report(spark, fact, args.out, cfg=cfg, with_ml=not args.no_ml,
                         split_mode=args.split)
    print(json.dumps(written, indent=1))
    return written


if __name__ == "__main__":
    main()
