"""Run the whole pipeline: ``python -m parley --input events.json --output /data/out``."""

from __future__ import annotations

import argparse

from parley.operators.embed import EMBEDDING_DIM
from parley.plans.jobs import run_pipeline
from parley.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="parley")
    parser.add_argument("--input", help="JSON array file, or JSON Lines with --lines; default: parley.input.path")
    parser.add_argument("--output", required=True, help="folder of the resulting tables")
    parser.add_argument("--lines", action="store_true", help="the input is JSON Lines, which Spark splits")
    parser.add_argument("--dim", type=int, default=EMBEDDING_DIM, help="embedding length")
    parser.add_argument("--master", help="Spark master, if not set by spark-submit")
    args = parser.parse_args()
    spark = build_session("parley", args.master)
    try:
        print(run_pipeline(spark, args.output, args.input, dim=args.dim, multi_line=not args.lines))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
