"""Jobs from the command line, for ``spark-submit`` or ``python -m jobmart.cli``."""

from __future__ import annotations

import argparse
import json

from jobmart.plans import jobs
from jobmart.session import build_session
from jobmart.sources.readers import kafka_options, kafka_stream
from jobmart.sources.writers import jdbc_options, search_options
from jobmart.streaming import jobs as stream_jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="jobmart")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    command("extract", "stored", "board", "output", "quarantine")
    sub = command("normalise", "output")
    sub.add_argument("--input", action="append", required=True, metavar="BOARD=PATH")
    sub.add_argument("--multi-line", action="store_true")
    sub = command("clean", "source", "output")
    sub.add_argument("--keep-duplicates", action="store_true")
    sub.add_argument("--jdbc-url")
    sub.add_argument("--jdbc-table", default="recruitment_fact")
    sub.add_argument("--jdbc-driver")
    command("warehouse", "source", "output")
    command("rebuild", "lake", "output")
    sub = command("merge", "lake", "output")
    sub.add_argument("--since", metavar="DAY")
    command("train", "clean", "model")
    command("predict", "clean", "model", "output")
    sub = command("stream", "servers", "topic", "checkpoint")
    sub.add_argument("--lake")
    sub.add_argument("--search-nodes")
    sub.add_argument("--search-index", default="it_jobs")
    sub.add_argument("--every", default="1 minute")
    return top


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = build_session(f"jobmart-{a.command}")
    if a.command == "extract":
        jobs.extract_job(spark, a.stored, a.board, a.output, a.quarantine)
    elif a.command == "normalise":
        inputs = dict(item.split("=", 1) for item in a.input)
        print(json.dumps(jobs.normalise_job(spark, inputs, a.output, a.multi_line)))
    elif a.command == "clean":
        jdbc = jdbc_options(a.jdbc_url, a.jdbc_table, a.jdbc_driver) if a.jdbc_url else None
        print(json.dumps(jobs.clean_job(spark, a.source, a.output, not a.keep_duplicates, jdbc)))
    elif a.command == "warehouse":
        jobs.warehouse_job(spark, a.source, a.output)
    elif a.command == "rebuild":
        jobs.rebuild_job(spark, a.lake, a.output)
    elif a.command == "merge":
        print(json.dumps(jobs.merge_job(spark, a.lake, a.output, since=a.since)))
    elif a.command == "train":
        print(json.dumps(jobs.train_job(spark, a.clean, a.model)))
    elif a.command == "predict":
        jobs.predict_job(spark, a.clean, a.model, a.output)
    elif a.command == "stream":
        search = search_options(a.search_index, a.search_nodes) if a.search_nodes else None
        raw = kafka_stream(spark, kafka_options(a.servers, a.topic))
        print(json.dumps(stream_jobs.run_until_one_stops(spark, raw, a.checkpoint, a.lake, search, every=a.every)))


if __name__ == "__main__":
    main()
