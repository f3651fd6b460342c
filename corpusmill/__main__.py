"""python -m corpusmill run --config FILE, or python -m corpusmill clean INPUT.. --output-dir DIR"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import cleaning
from .plans import pipeline
from .sources import files, sinks


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corpusmill")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run a pipeline")
    run.add_argument("--config", default="config.yaml")
    clean = commands.add_parser("clean", help="clean Markdown and text files")
    clean.add_argument("inputs", nargs="+")
    clean.add_argument("--output-dir", required=True)
    clean.add_argument("--processors", nargs="*", default=list(cleaning.PROCESSORS), choices=[*cleaning.PROCESSORS, "latex"])
    clean.add_argument("--threshold", type=float, default=0.99)
    clean.add_argument("--min-words", type=int, default=2)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("corpusmill").getOrCreate()
    if args.command == "run":
        pipeline.run(spark, pipeline.load(args.config))
    else:
        docs = files.read_text(spark, args.inputs)
        sinks.export(cleaning.clean(docs, args.processors, args.threshold, args.min_words), args.output_dir, "txt")


if __name__ == "__main__":
    main()
