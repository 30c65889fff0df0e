"""The command line.

    python -m pairscore.plans.cli eval --input FILE --output FOLDER [--env FILE] [--llm-eval] [--one-file] [--log FILE]
    python -m pairscore.plans.cli questions [--output FOLDER] [--tasks N] [--judge] [--env FILE] [--log FILE]

Results go to stdout, what failed to stderr; the exit code is 0 if nothing did.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from ..sources.markdown import exists
from ..sources.sinks import report_json
from .config import load_config, load_generator
from .log import driver_logger
from .pipeline import run_eval, run_generation


@dataclass
class Outcome:
    """What a command has to say, and what went wrong."""

    lines: Iterator[str] | list[str] = field(default_factory=list)
    problems: list[str] = field(default_factory=list)

    def tell(self) -> int:
        for line in self.lines:
            print(line)
        for problem in self.problems:
            print(problem, file=sys.stderr)
        return 1 if self.problems else 0


def evaluate(spark: SparkSession, given: argparse.Namespace) -> Outcome:
    config = load_config(given.input, given.output, given.env)
    if not exists(spark, config.input_md):
        return Outcome(problems=[f"there is no Markdown at {config.input_md}"])
    judge_model = config.model_a if given.llm_eval else None
    summary, problems = run_eval(spark, config.input_md, config.output_dir, config.model_a, config.model_b, config.gold_jsonl, judge_model, one_file=given.one_file)
    return Outcome([report_json(summary)], problems)


def questions(spark: SparkSession, given: argparse.Namespace) -> Outcome:
    model = load_generator(given.env)
    found = run_generation(spark, model, given.output, given.tasks or None, judge_model=model if given.judge else None)
    return Outcome(f"{r['category']}\t{r['score']}\t{r['question']}" for r in found.toLocalIterator())


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pairscore", description="Grade two extraction models against each other, or have questions generated.")
    commands = parser.add_subparsers(required=True)
    for command, told in ((evaluate, "eval"), (questions, "questions")):
        own = commands.add_parser(told)
        own.set_defaults(command=command)
        own.add_argument("--output", help="the folder for results")
        own.add_argument("--env", help="a .env file")
        own.add_argument("--log", help="a log file, rotated")
        if command is evaluate:
            own.add_argument("--input", help="a Markdown file, folder or pattern")
            own.add_argument("--llm-eval", action="store_true", help="let model A comment on chunks with errors; the metrics do not change")
            own.add_argument("--one-file", action="store_true", help="each table as one file, for small results")
        else:
            own.add_argument("--tasks", type=int, default=1, help="how many tasks of the catalogue to cut; 0 takes all")
            own.add_argument("--judge", action="store_true", help="let the model score each question")
    return parser


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = arguments().parse_args(args)
    log = driver_logger(file=given.log)
    try:
        outcome = given.command(spark or SparkSession.builder.appName("pairscore").getOrCreate(), given)
        return outcome.tell()
    except Exception as e:
        log.error("%s: %s", type(e).__name__, e)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
