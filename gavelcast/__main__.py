"""Command line: ``python -m gavelcast run|tune|score``, also through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import workflow
from .sources import csv


def main() -> None:
    parser = argparse.ArgumentParser(prog="gavelcast")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("run", "train, evaluate and save"), ("tune", "search boosting settings"),
                       ("score", "price rows with saved artifacts")):
        command = commands.add_parser(name, help=text)
        command.add_argument("sales", help="CSV file or folder")
        command.add_argument("output", help="folder of reports and models")
        if name != "score":
            command.add_argument("--exact", action="store_true", help="splits of exact sizes")
        if name == "tune":
            command.add_argument("--trials", type=int, default=50)
            command.add_argument("--method", choices=sorted(workflow.SEARCHES), default="halving")
        if name == "score":
            command.add_argument("--key", action="append", default=[], help="column to carry along")
            command.add_argument("--to", required=True, help="folder of the scored parquet")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("gavelcast").getOrCreate()
    sales = csv.read_sales(spark, args.sales)
    if args.command == "run":
        outcome = workflow.run(sales, output=args.output, exact=args.exact)
        outcome.scores.show(truncate=False)
        outcome.segments.show(truncate=False)
        outcome.summary.show(truncate=False)
    elif args.command == "tune":
        _, best = workflow.tune_boosting(sales, output=args.output, exact=args.exact, method=args.method, n_trials=args.trials)
        best.show(truncate=False)
    else:
        scored = workflow.score(
            sales, f"{args.output}/preprocessor", f"{args.output}/best_model", args.key)
        scored.write.mode("overwrite").parquet(args.to)
    spark.stop()


if __name__ == "__main__":
    main()
