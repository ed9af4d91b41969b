"""Command line to the end-to-end jobs.

    python -m tillwork layers  --customers C --sales S --json-lines --out ROOT
    python -m tillwork report  --customers C --products P --sales S --json-documents --out ROOT
    python -m tillwork enrich  --customers C --products P --json-lines --out ROOT --export-json J
    python -m tillwork revenue --products P --sales S --json-lines --out ROOT
    python -m tillwork lines   --documents D --out ROOT
    python -m tillwork publish --csv C.csv --servers HOST:PORT --topic T --ledger L
    python -m tillwork compact --columns id,name --sink O --out ROOT
    python -m tillwork feed    --columns id,name --servers HOST:PORT --topic T --out O --checkpoint K

The session comes from the launcher's settings. With ``--topic-dir`` in place of ``--servers`` and
``--topic`` a folder of text files serves as the topic.
"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tillwork import schemas
from tillwork.operators.revenue import revenue_by_year_month, unpriced_products
from tillwork.plans.enrichment import write_views
from tillwork.plans.feed import start_feed
from tillwork.plans.layers import build_layers, land_sales
from tillwork.plans.report import text_lines, write_report
from tillwork.session import apply_runtime_conf
from tillwork.sources.documents import land_documents
from tillwork.sources.files import read_csv, read_json, write_table
from tillwork.streaming.compaction import compact
from tillwork.streaming.endpoints import (
    file_topic_stream,
    kafka_stream,
    publish_to_files,
    publish_to_kafka,
)
from tillwork.streaming.ledger import publish_once, to_files, to_kafka


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tillwork")
    jobs = root.add_subparsers(dest="job", required=True)

    layers = jobs.add_parser("layers", help="write the cleansed and curated tables")
    report = jobs.add_parser("report", help="land the sales and write every part of the report")
    enrich = jobs.add_parser("enrich", help="write the curated and enriched views")
    revenue = jobs.add_parser("revenue", help="land the sales and write priced revenue")
    for job in (layers, report, enrich):
        job.add_argument("--customers", required=True)
    for job in (layers, report, enrich, revenue):
        job.add_argument("--out", required=True)
        layout = job.add_mutually_exclusive_group(required=True)
        layout.add_argument("--json-lines", action="store_true", help="one object per line")
        layout.add_argument("--json-documents", action="store_true", help="one document per file")
        job.add_argument("--infer-schema", action="store_true", help="types from a pass over the data")
        job.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    for job in (layers, report, revenue):
        job.add_argument("--sales", required=True)
    for job in (report, enrich, revenue):
        job.add_argument("--products", required=True)
    for job in (report, enrich):
        job.add_argument("--as-of", help="ISO date the ages refer to, by default today")
    layers.add_argument("--salt-file", help="file whose text, without line ends, salts the hashes")
    enrich.add_argument("--export-json", help="folder for the products as JSON Lines")

    lines = jobs.add_parser("lines", help="land JSON documents of any size as JSON Lines")
    lines.add_argument("--documents", required=True)
    lines.add_argument("--out", required=True)
    lines.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])

    publish = jobs.add_parser("publish", help="send each CSV row as a JSON message")
    publish.add_argument("--csv", required=True)
    publish.add_argument("--key", help="column that becomes the message key")
    publish.add_argument("--ledger", help="folder that remembers what was sent: send only what is new")
    compact_job = jobs.add_parser("compact", help="copy what a feed has stored into large files")
    compact_job.add_argument("--columns", required=True, help="stored fields, separated by commas")
    compact_job.add_argument("--sink", required=True, help="the feed's --out")
    compact_job.add_argument("--out", required=True)
    feed = jobs.add_parser("feed", help="store messages as JSON files until stopped")
    feed.add_argument("--columns", required=True, help="message fields, separated by commas")
    feed.add_argument("--out", required=True)
    feed.add_argument("--checkpoint", required=True)
    feed.add_argument("--raw", action="store_true", help="store the message text unparsed")
    feed.add_argument("--quarantine", action="store_true", help="set malformed messages aside")
    feed.add_argument("--available-now", action="store_true", help="stop when all is stored")
    feed.add_argument("--max-per-trigger", type=int, help="rows, or files, of a micro-batch")
    for job in (publish, feed):
        job.add_argument("--servers")
        job.add_argument("--topic")
        job.add_argument("--topic-dir")
    return root


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    apply_runtime_conf(spark)

    def entity(name: str) -> DataFrame:
        schema = None if args.infer_schema else getattr(schemas, name.upper())
        return read_json(spark, getattr(args, name), schema, multi_line=args.json_documents)

    if args.job == "layers":
        salt = Path(args.salt_file).read_text().rstrip("\r\n") if args.salt_file else None
        build_layers(entity("customers"), entity("sales"), args.out, args.mode, salt)
    elif args.job == "report":
        landed = land_sales(entity("sales"), f"{args.out}/sales", args.mode)
        parts = write_report(
            landed, entity("products"), entity("customers"), f"{args.out}/parts", args.mode, args.as_of
        )
        text_lines(parts["metrics"]).show(truncate=False)
    elif args.job == "enrich":
        write_views(
            entity("customers"), entity("products"), args.out, args.mode, args.as_of, args.export_json
        )
    elif args.job == "revenue":
        landed = land_sales(entity("sales"), f"{args.out}/sales", args.mode)
        products = entity("products")
        write_table(revenue_by_year_month(landed, products), f"{args.out}/revenue_by_year_month", args.mode)
        write_table(unpriced_products(landed, products), f"{args.out}/unpriced_products", args.mode)
    elif args.job == "lines":
        print(f"{land_documents(spark, args.documents, args.out, args.mode)} records landed")
    elif args.job == "compact":
        schema = schemas.all_strings(args.columns.split(","))
        print(f"{compact(spark, args.sink, args.out, schema)} files compacted")
    elif args.job == "publish":
        rows = read_csv(spark, args.csv)
        if args.ledger:
            send = to_files(args.topic_dir) if args.topic_dir else to_kafka(args.servers, args.topic)
            print(f"{publish_once(rows, args.ledger, send)} new messages")
        elif args.topic_dir:
            publish_to_files(rows, args.topic_dir)
        else:
            publish_to_kafka(rows, args.servers, args.topic, args.key)
    else:
        if args.topic_dir:
            messages = file_topic_stream(spark, args.topic_dir, args.max_per_trigger)
        else:
            messages = kafka_stream(
                spark, args.servers, args.topic, max_per_trigger=args.max_per_trigger
            )
        start_feed(
            messages,
            schemas.all_strings(args.columns.split(",")),
            args.out,
            args.checkpoint,
            parse=not args.raw,
            quarantine=args.quarantine,
            trigger={"availableNow": True} if args.available_now else None,
        ).awaitTermination()


def main(argv: list[str] | None = None) -> None:
    root = parser()
    args = root.parse_args(argv)
    if args.job in ("publish", "feed") and not (args.topic_dir or (args.servers and args.topic)):
        root.error("name --servers and --topic, or --topic-dir")
    if args.job == "publish" and args.ledger and args.key:
        root.error("with --ledger the digest is the key")
    if args.job == "publish" and args.topic_dir and args.key:
        root.error("messages in a folder have no --key")
    run(SparkSession.builder.appName(f"tillwork-{args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
