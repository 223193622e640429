"""Command-line entry for the jobs, for ``spark-submit`` or a scheduler.

    spark-submit --py-files tidewater.zip tidewater/cli.py weather  --forecast F --ports P --out DIR
    ... fleet       --ports P --vessels V --out DIR
    ... movement    (--messages M | --store S) --out DIR [--since DATE] [--until DATE]
    ... ingest-ais  (--files DIR | --kafka HOSTS --topic T) --store S [--rejects R]
    ... type-counts (--files DIR | --kafka HOSTS --topic T) --out DIR [--watermark W]
    ... forecast-load --payloads DIR --store S [--rejects R]
    ... registry-load --payloads DIR --store S --catalog ports|vessels --fetched-at EPOCH --batch-id N
    ... current-load  --payloads DIR --store S --batch-id N [--rejects R]

Store tables are Parquet with the catalog's column names (all text). Message
inputs are Parquet or JSON lines (``json:<path>``) with a ``value`` text column. Stream
checkpoints default to ``<spark.checkpoint.dir>/streams/<job>``. The master
comes from spark-submit; ``TIDEWATER_MASTER`` sets one for local runs.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from tidewater.session import get_session


def _read_table(spark, path: str):
    """Parquet by default; ``json:<path>`` or a ``.json`` path reads JSON lines.
    Works for any Hadoop-compatible path (no local file-system checks)."""
    if path.startswith("json:"):
        return spark.read.json(path[len("json:"):])
    if path.endswith(".json"):
        return spark.read.json(path)
    return spark.read.parquet(path)


def _stream_source(spark, args):
    from tidewater.streaming import ingest

    if args.kafka:
        return ingest.read_kafka(spark, args.kafka, args.topic, max_offsets=args.max_offsets)
    return ingest.read_files(spark, args.files, max_files_per_trigger=args.max_files)


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="tidewater")
    sub = parser.add_subparsers(dest="job", required=True)

    w = sub.add_parser("weather")
    w.add_argument("--forecast", required=True)
    w.add_argument("--ports", required=True)
    w.add_argument("--out", required=True)

    f = sub.add_parser("fleet")
    f.add_argument("--ports", required=True)
    f.add_argument("--vessels", required=True)
    f.add_argument("--out", required=True)

    m = sub.add_parser("movement")
    msrc = m.add_mutually_exclusive_group(required=True)
    msrc.add_argument("--messages", help="message files with a value column")
    msrc.add_argument("--store", help="message store written by ingest-ais (one row per message key)")
    m.add_argument("--out", required=True)
    m.add_argument("--since", default=None, help="first event date")
    m.add_argument("--until", default=None, help="event date after the last")

    for name in ("ingest-ais", "type-counts"):
        s = sub.add_parser(name)
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--files")
        src.add_argument("--kafka")
        s.add_argument("--topic", default="ais-stream")
        s.add_argument("--max-offsets", type=int, default=None)
        s.add_argument("--max-files", type=int, default=None)
        s.add_argument("--checkpoint", default=None)
        if name == "ingest-ais":
            s.add_argument("--store", required=True)
            s.add_argument("--rejects", default=None)
            s.add_argument("--fail-on-invalid", action="store_true")
        else:
            s.add_argument("--out", required=True)
            s.add_argument("--window", default="15 minutes")
            s.add_argument("--watermark", default="1 hour")

    fl = sub.add_parser("forecast-load")
    fl.add_argument("--payloads", required=True)
    fl.add_argument("--store", required=True)
    fl.add_argument("--rejects", default=None)

    rl = sub.add_parser("registry-load")
    rl.add_argument("--payloads", required=True)
    rl.add_argument("--store", required=True)
    rl.add_argument("--catalog", choices=("ports", "vessels"), required=True)
    rl.add_argument("--fetched-at", type=int, required=True)
    rl.add_argument("--batch-id", type=int, required=True)

    cl = sub.add_parser("current-load")
    cl.add_argument("--payloads", required=True)
    cl.add_argument("--store", required=True)
    cl.add_argument("--batch-id", type=int, required=True)
    cl.add_argument("--rejects", default=None)

    args = parser.parse_args(argv)
    spark = get_session(os.environ.get("TIDEWATER_MASTER"), app_name=f"tidewater-{args.job}")

    from tidewater.plans import jobs
    from tidewater.streaming import ingest

    if args.job == "weather":
        result = jobs.weather_job(_read_table(spark, args.forecast), _read_table(spark, args.ports), args.out)
    elif args.job == "fleet":
        result = jobs.fleet_job(_read_table(spark, args.ports), _read_table(spark, args.vessels), args.out)
    elif args.job == "movement":
        if args.store:
            messages = ingest.read_messages(spark, args.store)
        else:
            messages = _read_table(spark, args.messages)
        result = jobs.movement_job(messages, args.out, since=args.since, until=args.until)
    elif args.job == "forecast-load":
        from tidewater.sources.payloads import read_json_payloads

        result = {"store": jobs.forecast_load_job(read_json_payloads(spark, args.payloads), args.store, args.rejects)}
    elif args.job == "registry-load":
        from tidewater.sources.catalog import PORTS, VESSELS
        from tidewater.sources.payloads import read_json_payloads

        catalog = PORTS if args.catalog == "ports" else VESSELS
        result = {"batch": jobs.registry_load_job(
            read_json_payloads(spark, args.payloads), args.store, catalog, args.fetched_at, args.batch_id
        )}
    elif args.job == "current-load":
        from tidewater.sources.payloads import read_json_payloads

        result = {"batch": jobs.current_load_job(
            read_json_payloads(spark, args.payloads), args.store, args.batch_id, args.rejects
        )}
    elif args.job == "ingest-ais":
        q = ingest.ingest_ais(
            _stream_source(spark, args), args.store, args.rejects, args.checkpoint,
            fail_on_invalid=args.fail_on_invalid,
        )
        q.awaitTermination()
        result = {"store": args.store, "rejects": args.rejects}
    else:
        q = ingest.type_count_stream(
            _stream_source(spark, args), path=args.out, checkpoint=args.checkpoint,
            window=args.window, watermark=args.watermark,
        )
        q.awaitTermination()
        result = {"type_counts": args.out}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
