"""Command line for the jobs, e.g. ``spark-submit folioscope/__main__.py preprocess ...``."""

import argparse
import ast
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioscope.operators.learn import MAX_CLASSES, VOCABULARY_SIZE
from folioscope.plans.analyse import analyse
from folioscope.plans.classify import classify_records, merge_predictions, train_and_score
from folioscope.plans.preprocess import build_taxonomy, convert, preprocess, read_articles, read_pages
from folioscope.session import build_session, run_folder
from folioscope.sources.tables import read_table, write_table


def _setting(text: str) -> tuple[str, object]:
    """``name=value`` of an estimator parameter; numbers and the like are read as such."""
    name, _, value = text.partition("=")
    try:
        return name, ast.literal_eval(value)
    except (ValueError, SyntaxError):
        return name, value


def _learning(job: argparse.ArgumentParser, kind: str) -> None:
    job.add_argument("--kind", default=kind, choices=["NB", "LR", "RF", "GBT"])
    job.add_argument("--hashed", type=int, default=0, help="hashed features in place of a vocabulary")
    job.add_argument("--vocabulary-size", type=int, default=VOCABULARY_SIZE)
    job.add_argument("--max-classes", type=int, default=MAX_CLASSES)
    job.add_argument("--handle-invalid", default="error", choices=["error", "skip", "keep"])
    job.add_argument("--set", type=_setting, action="append", default=[], metavar="NAME=VALUE", help="parameter of the estimator, e.g. maxIter=50")


def _parameters(args: argparse.Namespace) -> dict:
    own = ("hashed", "vocabulary_size", "max_classes", "handle_invalid")
    return {name: getattr(args, name) for name in own} | dict(args.set)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="folioscope")
    parser.add_argument("--format", default="parquet", help="table format (default: parquet)")
    parser.add_argument("--master", default=None, help="Spark master, where spark-submit sets none")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("convert", help="JSON lines to delimited records")
    job.add_argument("source")
    job.add_argument("destination")
    job.add_argument("--parse", action="store_true", help="parse the JSON instead of scanning it")

    job = jobs.add_parser("taxonomy", help="saved taxonomy pages to the taxonomy table")
    job.add_argument("pages")
    job.add_argument("destination")
    job.add_argument("--overwrite", action="store_true")

    job = jobs.add_parser("preprocess", help="records to enriched, training and testing tables")
    job.add_argument("source", help="file, folder or glob such as .../part*")
    job.add_argument("taxonomy")
    job.add_argument("destination")
    job.add_argument("--json", action="store_true", help="the source holds JSON lines")
    job.add_argument("--disjoint", action="store_true", help="cut test parts from unseen articles")
    job.add_argument("--missing-authors", type=int, default=None)
    job.add_argument("--overwrite", action="store_true")

    job = jobs.add_parser("analyse", help="profiles and trends of an enriched table")
    job.add_argument("table")
    job.add_argument("destination")

    job = jobs.add_parser("classify", help="train, score, merge predictions")
    job.add_argument("tables", help="folder written by preprocess")
    job.add_argument("part", choices=["test1", "test2", "test3"])
    job.add_argument("destination", help="prediction table to write")
    job.add_argument("--current", default=None, help="prediction table to merge into")
    _learning(job, "NB")
    job.add_argument("--model", default=None, help="folder to save the model in")

    job = jobs.add_parser("classify-records", help="train and score straight from records")
    job.add_argument("source")
    job.add_argument("partitions", type=int)
    job.add_argument("test_ratio", type=float)
    job.add_argument("destination")
    job.add_argument("--current", default=None)
    _learning(job, "LR")
    job.add_argument("--short-names", action="store_true", help="the shorter category names")
    job.add_argument("--json", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"folioscope-{args.job}", args.master)
    with run_folder(spark, args.job):  # what the job stores on the way is deleted at its end
        run_job(spark, args)


def run_job(spark, args: argparse.Namespace) -> None:
    if args.job == "convert":
        convert(spark, args.source, args.destination, exact=not args.parse)
    elif args.job == "taxonomy":
        pages = read_pages(spark, args.pages)
        build_taxonomy(pages, args.destination, fmt=args.format, overwrite=args.overwrite)
    elif args.job == "preprocess":
        articles = read_articles(spark, args.source, "json" if args.json else "records")
        preprocess(
            spark,
            articles,
            read_table(spark, args.taxonomy, args.format),
            args.destination,
            fmt=args.format,
            missing_authors=args.missing_authors,
            disjoint=args.disjoint,
            overwrite=args.overwrite,
        )
    elif args.job == "analyse":
        reports = analyse(read_table(spark, args.table, args.format))
        for name, report in reports.items():
            write_table(report, f"{args.destination}/{name}", fmt=args.format)
    elif args.job == "classify":
        training = read_table(spark, f"{args.tables}/training", args.format)
        testing = read_table(spark, f"{args.tables}/testing/{args.part}", args.format)
        outcome = train_and_score(training, testing, args.kind, model_path=args.model, **_parameters(args))
        print(f"accuracy = {outcome.accuracy:g}  f1 = {outcome.f1:g}")
        merge_predictions(spark, outcome, args.current, args.destination, args.format)
    else:
        articles = read_articles(spark, args.source, "json" if args.json else "records")
        outcome = classify_records(
            articles, args.test_ratio, args.partitions, args.kind, args.short_names, **_parameters(args)
        )
        print(f"accuracy = {outcome.accuracy:g}  f1 = {outcome.f1:g}")
        merge_predictions(
            spark, outcome, args.current, args.destination, args.format, insert_all=True
        )


if __name__ == "__main__":
    main()
