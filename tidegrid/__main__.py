"""Command line: ``python -m tidegrid batch|feed|stream``, for use with spark-submit too."""

from __future__ import annotations

import argparse

from tidegrid.plans import job as batch_job
from tidegrid.session import build_session
from tidegrid.sources import normalized, replay
from tidegrid.streaming import job as stream_job


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidegrid")
    parser.add_argument("--source-tz", default="UTC", help="zone of timestamps in the raw log")
    parser.add_argument("--slot-tz", default="UTC", help="zone of morning and afternoon")
    parser.add_argument("--draught-compat", action="store_true", help="read every draught as 0")
    parser.add_argument("--text-log", action="store_true",
                        help="batch, feed: the log is an already normalised text log")
    parser.add_argument("--continuous", action="store_true",
                        help="stream: go on waiting for new files")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, source in (("batch", "raw log"), ("feed", "raw log"), ("stream", "feed")):
        command = commands.add_parser(name)
        command.add_argument("source", help=source)
        command.add_argument("out")
    args = parser.parse_args(argv)
    ignored = {"batch": ("continuous",), "feed": ("continuous", "slot_tz"),
               "stream": ("source_tz", "draught_compat", "text_log")}[args.command]
    for option in ignored + (("source_tz", "draught_compat") if args.text_log else ()):
        if getattr(args, option) != parser.get_default(option):
            parser.error(f"--{option.replace('_', '-')} does not apply here")

    spark = build_session()
    if args.command == "batch":
        batch_job.run_batch(spark, args.source, args.out, args.source_tz, args.slot_tz,
                            args.draught_compat, args.text_log)
    elif args.command == "feed":
        if args.text_log:
            positions = normalized.import_text_log(spark, args.source, f"{args.out}/ingest")
        else:
            positions, _ = normalized.ingest(spark, args.source, f"{args.out}/ingest",
                                             args.source_tz, args.draught_compat)
        replay.publish(positions, f"{args.out}/feed")
    else:
        stream_job.run_feed(spark, args.source, args.out, args.slot_tz, finite=not args.continuous)


if __name__ == "__main__":
    main()
