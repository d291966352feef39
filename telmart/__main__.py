"""Command line of the jobs: ``spark-submit`` or ``python -m telmart <job> ...``."""

import argparse

from pyspark.sql import DataFrame, SparkSession

from telmart import schemas
from telmart.operators import enrich
from telmart.plans import jobs
from telmart.sources import files, messages
from telmart.streaming import enrichment


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="telmart")
    commands = parser.add_subparsers(dest="job", required=True)

    clean = commands.add_parser("clean", help="text files to cleaned collections and their join")
    clean.add_argument("--crm", required=True)
    clean.add_argument("--device", required=True)
    clean.add_argument("--cleaned", required=True, help="folder for crm, device and subscribers")
    clean.add_argument("--add", action="store_true", help="add the files' rows to those of earlier runs with --add")
    _rejects(clean)

    stage = commands.add_parser("stage", help="revenue text file to a table by week")
    stage.add_argument("--revenue", required=True)
    stage.add_argument("--staged", required=True)
    _rejects(stage)

    publish = commands.add_parser("publish", help="send the next week")
    publish.add_argument("--staged", required=True)
    publish.add_argument("--progress", required=True)
    _topic(publish)

    stream = commands.add_parser("enrich", help="join the topic with the subscribers")
    stream.add_argument("--cleaned", required=True)
    stream.add_argument("--facts", help="folder of the fact table")
    stream.add_argument("--format", help="append to this Spark format instead, such as jdbc")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="of the format")
    stream.add_argument("--staging", help="folder by which a --format that Spark also reads gets each batch once")
    stream.add_argument("--rejects", help="folder for messages that cannot be used")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--once", action="store_true", help="end after what is there now")
    stream.add_argument("--every", help="time between micro-batches, such as '10 minutes'")
    stream.add_argument("--max-messages", type=int, help="a broker's most messages per micro-batch")
    stream.add_argument("--broadcast-messages", action="store_true",
                        help="join limited micro-batches without shuffling the subscribers")
    _topic(stream)

    reports = commands.add_parser("marts", help="create all report tables and export them")
    reports.add_argument("--facts", required=True)
    reports.add_argument("--tables", required=True, help="folder of the report tables")
    reports.add_argument("--export", required=True)
    reports.add_argument("--week", type=int, action="append", help="a week with new facts; all weeks if none is given")
    reports.add_argument("--as-of", help="date that ages refer to; today if not given")
    args = parser.parse_args(argv)
    if args.job == "enrich":
        if args.folder and args.max_messages is not None:
            parser.error("--max-messages is for a broker; a folder has no such limit")
        if args.broadcast_messages and args.max_messages is None:
            parser.error("--broadcast-messages needs a limit, --max-messages")
        if (args.facts is None) == (args.format is None):
            parser.error("name one target, --facts or --format")
    return args


def _rejects(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--rejects", help="folder for records that cannot be used; without it they stop the job")
    parser.add_argument("--most-rejected", type=float, default=0.0, metavar="SHARE",
                        help="the share of records above which the job stops all the same")


def _topic(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--servers", help="brokers of the topic")
    parser.add_argument("--topic", default="revenue")
    parser.add_argument("--folder", help="a folder of message files instead of a broker")


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"telmart {args.job}").getOrCreate()

    if args.job == "clean":
        load = jobs.clean_added_files if args.add else jobs.clean_files
        load(spark, args.crm, args.device, args.cleaned, args.rejects, args.most_rejected)
    elif args.job == "stage":
        if args.rejects:
            revenue = jobs.scan_checked(spark, args.revenue, schemas.REVENUE, args.rejects, args.most_rejected)
        else:
            revenue = files.scan_revenue(spark, args.revenue)
        jobs.stage_revenue(revenue, args.staged)
    elif args.job == "publish":
        def send(rows: DataFrame) -> None:
            if args.folder:
                messages.publish_folder(rows, args.folder, args.topic)
            else:
                messages.publish(rows, **{"kafka.bootstrap.servers": args.servers, "topic": args.topic})

        week = jobs.publish_next_week(
            spark, jobs.read_staged_messages(spark, args.staged), args.progress, send
        )
        print("nothing to publish yet" if week is None else f"published week {week}")
    elif args.job == "enrich":
        if args.folder:
            stream = messages.folder_stream(spark, args.folder)
        else:
            stream = messages.topic_stream(spark, args.servers, args.topic, args.max_messages)
        if args.format:
            options = dict(x.split("=", 1) for x in args.option)
            if args.staging:
                write = enrichment.append_once(args.format, options, args.staging, args.checkpoint)
            else:
                write = enrichment.format_writer(args.format, options)
        else:
            write = enrichment.fact_writer(args.facts, args.checkpoint)
        jobs.enrich_stream(
            spark, stream, f"{args.cleaned}/subscribers", write, args.checkpoint, args.once, args.every,
            args.broadcast_messages, args.rejects,
        ).awaitTermination()
    else:
        activity = enrich.as_activity(jobs.read_facts(spark, args.facts))
        tables = jobs.create_marts(spark, activity, args.tables, args.as_of, weeks=args.week)
        jobs.export_tables(spark, tables, args.export)


if __name__ == "__main__":
    main()
