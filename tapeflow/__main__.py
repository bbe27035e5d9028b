"""Command line: ``python -m tapeflow [ingest|stream|peek|score|close|preview|synth]``, settings from
the environment."""

import argparse
from dataclasses import replace
from datetime import datetime, timedelta

from . import constants as C
from .operators.reports import peek_trades
from .session import build_session
from .settings import load_settings
from .sources.synthetic import MINUTES, synth_window_tables
from .sources.tables import preview
from .sources.topics import read_trade_stream
from .streaming.backfill import close_windows
from .streaming.jobs import refresh_scores, start_ingest, start_pipeline


def main() -> None:
    parser = argparse.ArgumentParser(prog="tapeflow")
    commands = parser.add_subparsers(dest="command")
    ingest = commands.add_parser("ingest", help="raw messages to clean trades, rejects and statistics")
    ingest.add_argument("--to-topic", action="store_true", help="write clean trades to the topic")
    stream = commands.add_parser("stream", help="clean trades to window tables")
    score = commands.add_parser("score", help="score the window table again whenever it grows")
    score.add_argument("--symbols", nargs="*", help="only these")
    commands.add_parser("close", help="write the windows that finished queries kept back")
    peek = commands.add_parser("peek", help="show the trades of a topic")
    peek.add_argument("--topic", default=C.CLEAN_TOPIC)
    peek.add_argument("--limit", type=int)
    for command in (ingest, stream, peek):
        command.add_argument("--json-dir", help="read JSON lines instead of a topic")
    commands.add_parser("preview", help="show the tumbling table")
    commands.add_parser("synth", help="write generated window tables")
    args = parser.parse_args()

    settings = load_settings()
    spark = build_session(settings.app_name, settings.spark_master)
    spark.sparkContext.setLogLevel("WARN")
    if args.command == "preview":
        preview(spark, settings.output_path(C.TUMBLING_NAME))
    elif args.command == "synth":
        start = datetime.now() - timedelta(minutes=MINUTES)
        tables = synth_window_tables(spark, start)
        for name, table in zip((C.TUMBLING_NAME, C.SLIDING_NAME), tables):
            table.write.mode("append").parquet(settings.output_path(name))
    elif args.command == "ingest":
        raw = replace(settings, topic=C.RAW_TOPIC)
        messages = read_trade_stream(spark, raw, args.json_dir, arrival=True)
        start_ingest(messages, settings, to_topic=args.to_topic).awaitTermination()
    elif args.command == "score":
        refresh_scores(spark, settings, symbols=args.symbols).awaitTermination()
    elif args.command == "close":
        for name in (C.TUMBLING_NAME, C.SLIDING_NAME):
            print(close_windows(spark, settings, name))
    elif args.command == "peek":
        records = read_trade_stream(spark, replace(settings, topic=args.topic), args.json_dir)
        shown = peek_trades(records, args.limit).writeStream.format("console").outputMode("append")
        shown.option("truncate", "false").start().awaitTermination()
    else:
        start_pipeline(spark, settings, json_dir=getattr(args, "json_dir", None), files_per_batch=1)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
