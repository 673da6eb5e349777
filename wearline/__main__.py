"""Command line: ``python -m wearline {run,stream,process,train,score} ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wearline.operators import audit, serving
from wearline.plans.medallion import Config, Lakehouse
from wearline.schemas import TEXT_BRONZE


REPORTS = {
    "audit": lambda lake: audit.newest_first(
        audit.current_predictions(lake.silver.changes(), lake.predictions.changes())
    ),
    "history": lambda lake: lake.silver.history(),
    "quality": lambda lake: lake.quality_audit(),
    "failures": lambda lake: serving.failure_distribution(lake.features.read()),
    "summary": lambda lake: serving.summary(lake.features.read()),
}


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wearline", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    help_root = "folder of the tables, reachable by all executors"

    run = steps.add_parser("run", help="raw files to Gold")
    run.add_argument("--source", required=True)
    process = steps.add_parser("process", help="Bronze to Gold")
    for step in (run, process):
        step.add_argument("--quality", choices=["audit", "enforce"], default="audit")
        step.add_argument("--stale", choices=["keep", "recompute"], default="keep")

    stream = steps.add_parser("stream", help="drain arrived CSV files into Bronze")
    stream.add_argument("--landing", required=True)
    stream.add_argument("--checkpoint", required=True)
    follow = steps.add_parser("follow", help="let Gold follow the new Silver commits as a stream")
    follow.add_argument("--checkpoint", required=True)
    for step in (run, process, stream):
        step.add_argument("--text", action="store_true", help="Bronze keeps values as text")

    for name, text in (("train", "fit the models"), ("score", "merge model predictions")):
        steps.add_parser(name, help=text).add_argument("--model", required=True)
    for name in REPORTS:
        steps.add_parser(name, help="print a report").add_argument("--rows", type=int, default=20)
    as_of = steps.add_parser("as-of", help="print a table as it stood")
    as_of.add_argument("--table", required=True)
    as_of.add_argument("--version", type=int)
    as_of.add_argument("--time")
    as_of.add_argument("--rows", type=int, default=20)
    for step in steps.choices.values():
        step.add_argument("--root", required=True, help=help_root)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("wearline").getOrCreate()
    options = {}
    if args.step in ("run", "process"):
        options = {"quality": args.quality, "stale": args.stale}
    if args.step in ("run", "process", "stream") and args.text:
        options["bronze_schema"] = TEXT_BRONZE
    lake = Lakehouse(spark, Config(args.root, **options))
    if args.step == "run":
        lake.run(args.source)
    elif args.step == "process":
        lake.process()
    elif args.step == "stream":
        lake.ingest_stream(args.landing, args.checkpoint)
    elif args.step == "follow":
        lake.stream_gold(args.checkpoint)
    elif args.step == "train":
        lake.train(args.model).show()
    elif args.step == "score":
        lake.score(args.model)
    elif args.step == "as-of":
        table = getattr(lake, args.table)
        rows = table.read(args.version) if args.time is None else table.read_at(args.time)
        rows.show(args.rows)
    else:
        REPORTS[args.step](lake).show(args.rows)


if __name__ == "__main__":
    main()
