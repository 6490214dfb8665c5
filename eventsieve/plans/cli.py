"""Command-line jobs: ``ingest``, ``summary``, ``recover`` (what a scheduler or spark-submit runs).

    python -m eventsieve.plans.cli ingest --source kafka --bootstrap b:9092 --topics t \\
        --raw R --rejects Q --metrics M --checkpoint C --name run1 [--available-now]
    python -m eventsieve.plans.cli ingest --source parquet --input DIR ...   (file stand-in)
    python -m eventsieve.plans.cli ingest --source jsonl --input DIR ...     (JSONL replay)
    python -m eventsieve.plans.cli summary --raw R --curated OUT [--threshold 9]
    python -m eventsieve.plans.cli recover --rejects Q --raw R --ledger L --run NAME

The session comes from ``SparkSession.builder.getOrCreate()`` (master, memory and
``spark.checkpoint.dir`` from spark-submit); only the SQL settings the jobs rely on are set.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventsieve.session import RECOMMENDED_CONF, ensure_checkpoint_dir


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("eventsieve").getOrCreate()
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _lists(ns) -> dict:
    out = {}
    if ns.types:
        out["allowed_types"] = tuple(ns.types.split(","))
    if ns.sources:
        out["allowed_sources"] = tuple(ns.sources.split(","))
    return out


def cmd_ingest(spark: SparkSession, ns) -> dict:
    from eventsieve.sources import readers
    from eventsieve.streaming import ingest as I

    if ns.source == "kafka":
        lines = readers.read_kafka_stream(spark, ns.bootstrap, ns.topics.split(","), min_partitions=ns.min_partitions)
    elif ns.source == "parquet":
        lines = readers.read_lines_stream(spark, ns.input, ns.max_files)
    else:
        text = readers.read_text_stream(spark, ns.input, ns.max_files)
        # JSONL has no arrival metadata: processing time and a per-batch row id order the lines.
        lines = text.select("json_string", F.current_timestamp().cast("timestamp_ntz").alias("arrival_ts"),
                            F.monotonically_increasing_id().alias("seq"))
    cfg = I.IngestConfig(raw_path=ns.raw, rejects_path=ns.rejects, metrics_path=ns.metrics, ingest_name=ns.name,
                         files_per_batch=ns.files,
                         source_name=f"{ns.bootstrap}/{ns.topics}" if ns.source == "kafka" else ns.input,
                         broker=ns.bootstrap if ns.source == "kafka" else None,
                         topic=ns.topics if ns.source == "kafka" else None, **_lists(ns))
    q = I.start_ingest(lines, cfg, ns.checkpoint, processing_time=ns.trigger, available_now=ns.available_now)
    I.run_until_done(q, ns.timeout)
    return I.metrics_totals(I.read_metrics(spark, ns.metrics)).first().asDict()


def cmd_summary(spark: SparkSession, ns) -> dict:
    from eventsieve.plans.jobs import daily_summary

    gate = daily_summary(spark, ns.raw, ns.curated, ns.threshold, ns.files)
    rows = {r.output: r.asDict() for r in gate.collect()}  # one row per output
    if ns.catalog:
        from eventsieve.plans.jobs import curated_tables
        from eventsieve.sources.readers import read_catalog_csv

        more = curated_tables(spark, ns.raw, ns.rejects, read_catalog_csv(spark, ns.catalog), ns.curated, ns.threshold, ns.files)
        rows |= {r.output: r.asDict() for r in more.collect()}
    if not all(r["schema_ok"] and r["non_empty"] for r in rows.values()):
        raise SystemExit(f"output gate failed: {rows}")
    return rows


def cmd_recover(spark: SparkSession, ns) -> dict:
    from eventsieve.plans.jobs import run_recovery

    repair = json.loads(ns.source_map) if ns.source_map else None
    kw = _lists(ns)
    if repair is not None:
        kw["source_map"] = repair
    return {"recovered": run_recovery(spark, ns.rejects, ns.raw, ns.ledger, ns.run, **kw)}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="eventsieve")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "summary", "recover"):
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True)
        s.add_argument("--types", help="allowed event types, comma separated")
        s.add_argument("--sources", help="allowed sources, comma separated")
        s.add_argument("--files", type=int, help="files per written folder (coalesce)")
        if name == "ingest":
            s.add_argument("--source", choices=["kafka", "parquet", "jsonl"], default="kafka")
            s.add_argument("--bootstrap")
            s.add_argument("--topics")
            s.add_argument("--min-partitions", type=int)
            s.add_argument("--input")
            s.add_argument("--max-files", type=int)
            s.add_argument("--rejects", required=True)
            s.add_argument("--metrics", required=True)
            s.add_argument("--checkpoint", required=True)
            s.add_argument("--name", required=True, help="ingest name; change it with a new checkpoint")
            s.add_argument("--trigger", default="10 seconds")
            s.add_argument("--available-now", action="store_true")
            s.add_argument("--timeout", type=float)
        elif name == "summary":
            s.add_argument("--curated", required=True)
            s.add_argument("--threshold", type=int, default=9)
            s.add_argument("--catalog", help="catalog CSV; with it, counts, KPIs, categories and insights are written as well")
            s.add_argument("--rejects", default="", help="rejects table, for the KPIs and insights")
        else:
            s.add_argument("--rejects", required=True)
            s.add_argument("--ledger", required=True)
            s.add_argument("--run", required=True)
            s.add_argument("--source-map", help='JSON object mapping a bad source to its repair, e.g. {"bad": "good"}')
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ns = parser().parse_args(argv)
    spark = spark or _session()
    out = {"ingest": cmd_ingest, "summary": cmd_summary, "recover": cmd_recover}[ns.cmd](spark, ns)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
