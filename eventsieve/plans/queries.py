"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per inventory entry.

Each query reads the driver tables (through ``sources.fixtures``) and runs the
library operators over the whole tables. Column names equal those of the
matching oracle SQL in ``plans.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve import schemas
from eventsieve.operators import ledger as L
from eventsieve.operators import quality as Q
from eventsieve.operators import recovery as H
from eventsieve.operators import summary as S
from eventsieve.operators.heavy import heavy_hitters
from eventsieve.operators.latest import latest_stored
from eventsieve.session import scratch_path, stored
from eventsieve.sources import fixtures as fx
from eventsieve.streaming import windows as W

Query = Callable[[SparkSession, str], DataFrame]

RULES = {"allowed_types": fx.FIXTURE_EVENT_TYPES, "allowed_sources": fx.FIXTURE_SOURCES}
HEAL = {**RULES, "source_map": fx.FIXTURE_SOURCE_REPAIR}


# ---- shared building blocks ---------------------------------------------------------------
def parsed(spark: SparkSession, d: str) -> DataFrame:
    """The feed parsed once and stored (line, gate, envelope, row number), as the streaming ingest
    stores each parsed micro-batch; validation and its join back read it twice."""
    return Q.numbered(Q.parse_events(fx.raw_lines(spark, d)))


def validated(spark: SparkSession, d: str, with_history: bool = False) -> DataFrame:
    hist = fx.history(spark, d) if with_history else None
    return Q.validate_events(parsed(spark, d), hist, **RULES)


def split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return Q.split_events(validated(spark, d))


def raw(spark: SparkSession, d: str) -> DataFrame:
    """Valid rows of the whole feed in stored shape (the raw table of a single-batch ingest)."""
    return split(spark, d)[0]


def rejects(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d)[1]


def stored_split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The raw and rejects tables as an ingest run leaves them: the validated batch is
    written once (line, envelope, errors) and both sides are read from it."""
    v = validated(spark, d).select("json_string", "data", "errors")
    return Q.split_events(stored(v, "validated"))


def ledger(spark: SparkSession, d: str) -> DataFrame:
    return L.stock_ledger(fx.stock_moves(spark, d))


def recovered(spark: SparkSession, d: str) -> DataFrame:
    valid, rej = stored_split(spark, d)
    return H.recover(rej, valid.select("event_id"), **HEAL)


# ---- queries ------------------------------------------------------------------------------
def q_parse_envelope(spark, d):
    p = Q.parse_events(fx.raw_lines(spark, d))
    return p.select("seq", "json_ok", *Q.envelope_columns())


def q_validate_errors(spark, d):
    v = validated(spark, d)
    return v.select("seq", F.col("data.event_id").alias("event_id"), Q.is_valid().alias("is_valid"),
                    F.concat_ws("; ", "errors").alias("reasons"))


def q_split_valid(spark, d):
    return Q.flatten_raw(raw(spark, d))


def q_split_rejects(spark, d):
    return rejects(spark, d)


def q_history_duplicates(spark, d):
    v = validated(spark, d, with_history=True)
    flagged = v.filter(F.array_contains("errors", "Duplicate event_id (already processed)"))
    return flagged.select("seq", F.col("data.event_id").alias("event_id"), F.concat_ws("; ", "errors").alias("reasons"))


def q_valid_with_history(spark, d):
    valid, _ = Q.split_events(validated(spark, d, with_history=True))
    return Q.flatten_raw(valid)


def q_batch_metrics(spark, d):
    return Q.batch_counts(validated(spark, d, with_history=True))


def q_feed_ratio(spark, d):
    return Q.feed_ratio(parsed(spark, d), **RULES)


def q_event_key(spark, d):
    """F20 + F22 + S8: lines trimmed, blank lines dropped, routing key per line."""
    from eventsieve.functions.rules import event_key

    trimmed = fx.raw_lines(spark, d).select("seq", F.trim("json_string").alias("json_string"))
    return trimmed.filter(F.col("json_string") != "").select("seq", event_key(F.col("json_string")).alias("event_key"))


def q_top_items(spark, d):
    return S.top_items(raw(spark, d))


def q_low_stock_events(spark, d):
    return S.low_stock_alerts(raw(spark, d))


def q_latest_state(spark, d):
    return S.latest_state(raw(spark, d))


def q_low_stock_skus(spark, d):
    return S.low_stock_skus(S.latest_state(raw(spark, d)), fx.catalog(spark, d))


def q_low_stock_top5(spark, d):
    return S.low_stock_top(S.latest_state(raw(spark, d)), fx.catalog(spark, d), 5)


def q_low_stock_events_top5(spark, d):
    return S.low_stock_events_top(S.low_stock_alerts(raw(spark, d)), fx.catalog(spark, d), 5)


def q_catalog_enrich(spark, d):
    facts = fx.bench_facts(spark, d).select("l_orderkey", "l_linenumber", "entity_id")
    return S.enrich(facts, fx.catalog(spark, d))


def q_sku_reference_defaults(spark, d):
    return S.sku_reference_defaults(fx.catalog(spark, d), fx.sku_reference(spark, d))


def q_unknown_skus(spark, d):
    return S.unknown_skus(raw(spark, d), fx.catalog(spark, d))


def q_low_stock_or_fallback(spark, d):
    r = stored_split(spark, d)[0]
    return S.low_stock_or_fallback(S.low_stock_alerts(r), r, fx.catalog(spark, d))


def q_low_stock_fallback_branch(spark, d):
    """U3, fallback branch: the curated side (events below level 0) is empty, so the
    latest-state low SKUs of raw are returned."""
    r = stored_split(spark, d)[0]
    return S.low_stock_or_fallback(S.low_stock_alerts(r, threshold=0), r, fx.catalog(spark, d))


def q_top_categories(spark, d):
    return S.top_categories(raw(spark, d), fx.catalog(spark, d), 10)


def q_top_categories_lineitem(spark, d):
    return S.top_categories(fx.bench_facts(spark, d), fx.catalog(spark, d), 10)


def q_kpis(spark, d):
    valid, rej = stored_split(spark, d)
    return S.kpis(valid, S.low_stock_alerts(valid), rej)


def q_top_event_type(spark, d):
    return S.most_common(raw(spark, d).filter(F.col("event_type").isNotNull()), "event_type")


def q_top_sku(spark, d):
    return S.top_sku(raw(spark, d), fx.catalog(spark, d))


def q_insights(spark, d):
    valid, rej = stored_split(spark, d)
    return S.insights(valid, S.low_stock_alerts(valid), rej, fx.catalog(spark, d))


def q_hourly_histogram(spark, d):
    return S.hourly_histogram(Q.parse_events(fx.raw_lines(spark, d)))


def q_rush_vs_offpeak(spark, d):
    return S.rush_vs_offpeak(Q.parse_events(fx.raw_lines(spark, d)))


def q_stock_ledger(spark, d):
    return ledger(spark, d).drop("ts")


def q_ledger_mismatches(spark, d):
    return L.ledger_mismatches(ledger(spark, d)).drop("ts")


def q_ledger_summary(spark, d):
    return L.ledger_summary(ledger(spark, d))


def q_open_restocks(spark, d):
    return L.open_restocks(ledger(spark, d))


def q_restock_summary(spark, d):
    return L.restock_summary(ledger(spark, d))


def q_heal_rejects(spark, d):
    h = H.heal_rejects(stored_split(spark, d)[1], **HEAL)
    return h.select("json_string", *[c for c in schemas.ENVELOPE_FIELDS if c != "payload"],
                    *[F.col(f"payload.{c}").alias(c) for c in schemas.PAYLOAD_FIELDS])


def q_recover(spark, d):
    r = recovered(spark, d)
    return r.select("json_string", *[c for c in schemas.ENVELOPE_FIELDS if c != "payload"],
                    *[F.col(f"payload.{c}").alias(c) for c in schemas.PAYLOAD_FIELDS])


def q_recover_pending(spark, d):
    valid, rej = stored_split(spark, d)
    rec = H.recover(rej, valid.select("event_id"), **HEAL)
    return H.pending_rejects(rej, H.handled_keys(rec))


def q_union_files(spark, d):
    valid, rej = stored_split(spark, d)
    return S.top_items(valid).unionByName(rej.select("event_id", "rejection_reason", "json_string"),
                                          allowMissingColumns=True)


def q_raw_after_recovery(spark, d):
    valid, rej = stored_split(spark, d)
    rec = H.recover(rej, valid.select("event_id"), **HEAL)
    return Q.flatten_raw(H.raw_after_recovery(valid, rec))


def q_counts_by_type(spark, d):
    return S.counts_by(raw(spark, d), "event_type")


def q_counts_by_source(spark, d):
    return S.counts_by(Q.parse_events(fx.raw_lines(spark, d)), "data.source", "source", where=F.col("json_ok"))


def q_counts_by_hour(spark, d):
    return S.counts_per_window(raw(spark, d), "1 hour")


def q_stream_sliding_counts(spark, d):
    return W.sliding_counts(raw(spark, d), "1 hour", "15 minutes", watermark="2 hours")


def q_stream_ingest(spark, d):
    """ST1-ST9: the feed as Parquet line files → file stream → foreachBatch ingest → raw, read back."""
    from eventsieve.sources.readers import read_lines_stream, read_raw
    from eventsieve.streaming.ingest import IngestConfig, run_until_done, start_ingest

    base = scratch_path(spark, "stream_ingest")
    fx.raw_lines(spark, d).write.mode("overwrite").parquet(f"{base}/in")
    cfg = IngestConfig(raw_path=f"{base}/raw", rejects_path=f"{base}/rejects", metrics_path=f"{base}/metrics",
                       ingest_name="q", **RULES)
    q = start_ingest(read_lines_stream(spark, f"{base}/in"), cfg, f"{base}/ckpt", available_now=True)
    run_until_done(q)
    return Q.flatten_raw(read_raw(spark, cfg.raw_path))


def _ingest(spark, d, name, boundary=False, managed=False):
    """Run the feed through the streaming ingest; with ``boundary`` in two runs of one query on the
    same checkpoint, the second one with the lines after half of the sequence."""
    from eventsieve.sources.readers import read_lines_stream
    from eventsieve.streaming.ingest import IngestConfig, run_until_done, start_ingest

    base = scratch_path(spark, name)
    feed = fx.raw_lines(spark, d)
    cfg = IngestConfig(raw_path=f"{base}/raw", rejects_path=f"{base}/rejects", metrics_path=f"{base}/metrics",
                       ingest_name="01", managed=managed, **RULES)
    half = feed.agg(F.floor(F.max("seq") / 2)).first()[0] if boundary else None
    parts = [feed.filter(F.col("seq") <= half), feed.filter(F.col("seq") > half)] if boundary else [feed]
    for part in parts:
        part.write.mode("append").parquet(f"{base}/in")
        run_until_done(start_ingest(read_lines_stream(spark, f"{base}/in"), cfg, f"{base}/ckpt", available_now=True))
    return cfg


def q_stream_two_batches(spark, d):
    """ST4 + ST5 + V11: two runs on one checkpoint; the second sees the first one's ids as history."""
    from eventsieve.sources.readers import read_raw

    return Q.flatten_raw(read_raw(spark, _ingest(spark, d, "stream_two_batches", True).raw_path))


def q_stream_managed_batches(spark, d):
    """K2 + S5 + ST5: as ``stream_two_batches`` over managed tables; the history is the id index."""
    from eventsieve.sources.readers import read_raw

    return Q.flatten_raw(read_raw(spark, _ingest(spark, d, "stream_managed", True, managed=True).raw_path))


def q_compacted_raw(spark, d):
    """K7: raw written as nine batches of a managed table, merged by threes, read back."""
    from eventsieve.streaming.tables import ManagedTable

    rows = stored(stored_split(spark, d)[0].withColumn("_batch", F.pmod(F.xxhash64("event_id"), F.lit(9))), "nine-batches", by="_batch")
    t = ManagedTable(spark, f"{scratch_path(spark, 'compacted')}/raw", schemas.RAW)
    for k in range(9):
        t.write(rows.filter(F.col("_batch") == k), "stream", "q", k)
    t.compact(3)
    t.vacuum(1)
    return Q.flatten_raw(t.read())


def q_stream_rejects(spark, d):
    """K3 + ST6: the rejects side of the streaming ingest, read back."""
    from eventsieve.sources.readers import read_rejects

    return read_rejects(spark, _ingest(spark, d, "stream_rejects").rejects_path)


def q_dedup_ties(spark, d):
    """V10 on equal order values: lines delivered by two partitions under one offset and time, and
    lines delivered twice. Exactly one row of an id stays."""
    feed = fx.raw_lines(spark, d).withColumn("partition", F.lit(0))
    kind = F.col("seq") % 100
    again = feed.filter(kind.between(20, 24)).withColumn("partition", F.lit(1))
    twice = feed.filter(kind == 25)
    v = Q.validate_events(Q.parse_events(feed.unionByName(again).unionByName(twice)), **RULES)
    return v.select("seq", "partition", Q.is_valid().alias("is_valid"), F.concat_ws("; ", "errors").alias("reasons"))


def q_recover_repeated_lines(spark, d):
    """Lines quarantined twice are recovered once."""
    valid, rej = stored_split(spark, d)
    rej = rej.unionByName(rej.filter(F.col("event_id").isNull()))
    r = H.recover(rej, valid.select("event_id"), **HEAL)
    return r.select("json_string", *[c for c in schemas.ENVELOPE_FIELDS if c != "payload"],
                    *[F.col(f"payload.{c}").alias(c) for c in schemas.PAYLOAD_FIELDS])


def q_history_two_ingests(spark, d):
    """S5 + D6: the history leaves out the batch of ingest ``01`` and keeps that of ingest ``1``."""
    from eventsieve.sources.readers import history_ids
    from eventsieve.streaming.sinks import layout_filter, write_batch

    path = f"{scratch_path(spark, 'two_ingests')}/raw"
    empty = spark.createDataFrame([], schemas.RAW).drop("event_id")
    ids = fx.history(spark, d).unionByName(empty, allowMissingColumns=True).select(*schemas.ENVELOPE_FIELDS)
    number = F.regexp_extract("event_id", "([0-9]+)", 1).cast("long")
    write_batch(ids.filter(number % 200 == 60), path, "stream", "01", 0)
    write_batch(ids.filter(number % 200 == 160), path, "stream", "1", 0)
    hist = history_ids(spark, path, exclude=layout_filter("stream", "01", 0))
    v = Q.validate_events(parsed(spark, d), hist, **RULES)
    flagged = v.filter(F.array_contains("errors", "Duplicate event_id (already processed)"))
    return flagged.select("seq", F.col("data.event_id").alias("event_id"), F.concat_ws("; ", "errors").alias("reasons"))


def q_stock_ledger_reference(spark, d):
    """W3 with each SKU's own starting stock, and the default for SKUs without one."""
    return L.stock_ledger(fx.stock_moves(spark, d), fx.sku_reference(spark, d)).drop("ts")


def q_unknown_skus_reference(spark, d):
    """J5 against the SKU reference."""
    return S.unknown_skus(raw(spark, d), fx.sku_reference(spark, d))


def q_catalog_csv(spark, d):
    """The catalog written as CSV with a header and read back."""
    from eventsieve.sources.readers import read_catalog_csv

    path = scratch_path(spark, "catalog_csv")
    fx.catalog(spark, d).write.option("header", "true").csv(path)
    return read_catalog_csv(spark, path)


def q_sku_reference_file(spark, d):
    """The SKU reference written as JSON lines and read back."""
    from eventsieve.sources.readers import read_sku_reference

    path = scratch_path(spark, "sku_reference")
    fx.sku_reference(spark, d).write.json(path)
    return read_sku_reference(spark, path)


def q_jsonl_lines(spark, d):
    """The feed written as text lines and read back, trimmed, without blank lines."""
    from eventsieve.sources.readers import read_jsonl

    path = scratch_path(spark, "jsonl")
    feed = fx.raw_lines(spark, d).select(F.concat(F.lit("  "), "json_string", F.lit(" ")).alias("value"))
    feed.unionByName(feed.limit(1).select(F.lit("   ").alias("value"))).write.text(path)
    return read_jsonl(spark, path)


def q_union_mixed_files(spark, d):
    """S9 + U1: stored files with different columns, read as one frame."""
    from eventsieve.sources.readers import union_files

    path = scratch_path(spark, "mixed")
    valid, rej = stored_split(spark, d)
    S.top_items(valid).write.parquet(path)
    rej.select("event_id", "rejection_reason", "json_string").write.mode("append").parquet(path)
    return union_files(spark, path).select("event_id", "event_type", "entity_id", "rejection_reason", "json_string")


def q_output_gate(spark, d):
    """G1 (+K4, K5): write raw, run the daily summary, re-read and gate its outputs."""
    from eventsieve.plans.jobs import daily_summary
    from eventsieve.streaming.sinks import write_batch

    base = scratch_path(spark, "daily_summary")
    write_batch(raw(spark, d), f"{base}/raw", "stream", "q", 0)
    return daily_summary(spark, f"{base}/raw", f"{base}/curated")


def _tables(spark, d, name):
    """The raw and rejects tables as an ingest leaves them, as folders."""
    from eventsieve.streaming.sinks import write_batch

    base = scratch_path(spark, name)
    valid, rej = stored_split(spark, d)
    write_batch(valid, f"{base}/raw", "stream", "q", 0)
    write_batch(rej, f"{base}/rejects", "stream", "q", 0)
    return base


def q_stream_windows(spark, d):
    """ST11 on a stream: sliding windows that the watermark (2 hours) has closed when the feed ends."""
    from eventsieve.sources.readers import read_table
    from eventsieve.streaming.ingest import run_until_done

    base = scratch_path(spark, "stream_windows")
    raw(spark, d).write.parquet(f"{base}/raw")
    feed = spark.readStream.schema(schemas.RAW).parquet(f"{base}/raw")
    counts = W.sliding_counts(feed, "1 hour", "15 minutes", watermark="2 hours")
    run_until_done(W.start_window_counts(counts, f"{base}/ckpt", f"{base}/out"))
    return read_table(spark, f"{base}/out", counts.schema)


def q_recover_second_run(spark, d):
    """H8: two recovery runs; the ledger holds every quarantined line once, with its outcome."""
    from eventsieve.plans.jobs import LEDGER, run_recovery
    from eventsieve.sources.readers import read_table

    base = _tables(spark, d, "recover_second_run")
    for run in ("r1", "r2"):
        run_recovery(spark, f"{base}/rejects", f"{base}/raw", f"{base}/ledger", run, **HEAL)
    return read_table(spark, f"{base}/ledger", LEDGER).select("reject_key", "outcome", "rule_version", "run")


def _curated(spark, d, name, threshold=9):
    from eventsieve.plans.jobs import curated_tables

    base = _tables(spark, d, "curated")
    curated_tables(spark, f"{base}/raw", f"{base}/rejects", fx.catalog(spark, d), f"{base}/curated", threshold)
    return spark.read.parquet(f"{base}/curated/{name}")


def q_curated_counts(spark, d):
    """A13-A15 as a stored table of the summary job."""
    return _curated(spark, d, "counts")


def q_curated_kpis(spark, d):
    """A3 + A4 as a stored table of the summary job."""
    return _curated(spark, d, "kpis")


def _incremental(spark, d):
    """Two incremental summary runs over a managed raw table: after four of nine batches, and after all
    nine and a merge by threes."""
    from eventsieve.plans.jobs import incremental_summary
    from eventsieve.streaming.tables import ManagedTable

    base = scratch_path(spark, "incremental")
    valid, rej = stored_split(spark, d)
    rows = stored(valid.withColumn("_batch", F.pmod(F.xxhash64("event_id"), F.lit(9))), "nine-batches", by="_batch")
    t = ManagedTable(spark, f"{base}/raw", schemas.RAW)
    ManagedTable(spark, f"{base}/rejects", schemas.REJECTS).write(rej, "stream", "q", 0)
    catalog = fx.catalog(spark, d)
    for k in range(9):
        t.write(rows.filter(F.col("_batch") == k), "stream", "q", k)
        if k == 3:
            t.compact(3)
            incremental_summary(spark, t.path, f"{base}/rejects", catalog, f"{base}/curated", 9)
    t.compact(3)
    incremental_summary(spark, t.path, f"{base}/rejects", catalog, f"{base}/curated", 9)
    return base, t


def q_incremental_counts(spark, d):
    """A13-A15 from mergeable states; the second run reads new folders only."""
    return spark.read.parquet(f"{_incremental(spark, d)[0]}/curated/counts")


def q_incremental_kpis(spark, d):
    """A3 + A4 from mergeable states."""
    return spark.read.parquet(f"{_incremental(spark, d)[0]}/curated/kpis")


def q_active_skus_by_day(spark, d):
    """A4 by day: exact, and whether the estimate from hourly sketches is within four standard errors of it."""
    from eventsieve.operators.states import SKETCH_BITS, active_by_day_exact

    base, t = _incremental(spark, d)
    error = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
    estimate = spark.read.parquet(f"{base}/curated/active_by_day").withColumnRenamed("active_skus", "estimate")
    close = F.abs(F.col("estimate") - F.col("active_skus")) <= F.ceil(F.col("active_skus") * error)
    both = active_by_day_exact(t.read()).join(estimate, "day", "full")
    return both.select("day", "active_skus", F.coalesce(close, F.lit(False)).alias("estimate_is_close"))


def q_incremental_latest(spark, d):
    """A8 from mergeable states: the latest of each folder's latest rows."""
    return spark.read.parquet(f"{_incremental(spark, d)[0]}/curated/latest")


def q_incremental_low_stock(spark, d):
    """P15 + J2 over the latest-state table."""
    return spark.read.parquet(f"{_incremental(spark, d)[0]}/curated/low_stock")


def q_latest_state_stored(spark, d):
    """A8 over the stored raw table: packed maxima by a hash aggregate, then the winners' rows."""
    return latest_stored(stored_split(spark, d)[0])


def q_heavy_entities(spark, d):
    """A9 + T4 kind: the 20 most active entities of the stored raw table by sketched candidates."""
    return heavy_hitters(stored_split(spark, d)[0], "entity_id", 20)


def q_heavy_parts(spark, d):
    """The 20 most frequent SKUs of the benchmark facts, where all SKUs are about as frequent."""
    return heavy_hitters(fx.bench_facts(spark, d), "entity_id", 20)


def q_stream_keyed_dedup(spark, d):
    """ST5 by keyed state: two runs on one checkpoint, the second with the later half of the sequence."""
    from eventsieve.sources.readers import read_lines_stream, read_table
    from eventsieve.streaming import dedup
    from eventsieve.streaming.ingest import run_until_done

    base = scratch_path(spark, "keyed_dedup")
    feed = fx.raw_lines(spark, d)
    half = feed.agg(F.floor(F.max("seq") / 2)).first()[0]
    for part in (feed.filter(F.col("seq") <= half), feed.filter(F.col("seq") > half)):
        part.write.mode("append").parquet(f"{base}/in")
        marked = dedup.mark_repeats(read_lines_stream(spark, f"{base}/in"))
        run_until_done(dedup.start_marked(marked, f"{base}/ckpt", f"{base}/out"))
    return read_table(spark, f"{base}/out", dedup.MARKED).select("seq", "event_id", "is_duplicate")


def q_insights_fallback(spark, d):
    """F25 without any low-stock event (levels below 0): the all-clear row."""
    return _curated(spark, d, "insights", 0)


QUERIES: dict[str, Query] = {
    "parse_envelope": q_parse_envelope,
    "validate_errors": q_validate_errors,
    "split_valid": q_split_valid,
    "split_rejects": q_split_rejects,
    "history_duplicates": q_history_duplicates,
    "valid_with_history": q_valid_with_history,
    "batch_metrics": q_batch_metrics,
    "feed_ratio": q_feed_ratio,
    "event_key": q_event_key,
    "top_items": q_top_items,
    "low_stock_events": q_low_stock_events,
    "latest_state": q_latest_state,
    "low_stock_skus": q_low_stock_skus,
    "low_stock_top5": q_low_stock_top5,
    "low_stock_events_top5": q_low_stock_events_top5,
    "catalog_enrich": q_catalog_enrich,
    "sku_reference_defaults": q_sku_reference_defaults,
    "unknown_skus": q_unknown_skus,
    "low_stock_or_fallback": q_low_stock_or_fallback,
    "low_stock_fallback_branch": q_low_stock_fallback_branch,
    "top_categories": q_top_categories,
    "top_categories_lineitem": q_top_categories_lineitem,
    "kpis": q_kpis,
    "top_event_type": q_top_event_type,
    "top_sku": q_top_sku,
    "insights": q_insights,
    "hourly_histogram": q_hourly_histogram,
    "rush_vs_offpeak": q_rush_vs_offpeak,
    "stock_ledger": q_stock_ledger,
    "ledger_mismatches": q_ledger_mismatches,
    "ledger_summary": q_ledger_summary,
    "open_restocks": q_open_restocks,
    "restock_summary": q_restock_summary,
    "heal_rejects": q_heal_rejects,
    "recover": q_recover,
    "recover_pending": q_recover_pending,
    "union_files": q_union_files,
    "raw_after_recovery": q_raw_after_recovery,
    "counts_by_type": q_counts_by_type,
    "counts_by_source": q_counts_by_source,
    "counts_by_hour": q_counts_by_hour,
    "stream_sliding_counts": q_stream_sliding_counts,
    "stream_ingest": q_stream_ingest,
    "output_gate": q_output_gate,
    "dedup_ties": q_dedup_ties,
    "recover_repeated_lines": q_recover_repeated_lines,
    "history_two_ingests": q_history_two_ingests,
    "stream_two_batches": q_stream_two_batches,
    "stream_rejects": q_stream_rejects,
    "stream_managed_batches": q_stream_managed_batches,
    "compacted_raw": q_compacted_raw,
    "stock_ledger_reference": q_stock_ledger_reference,
    "unknown_skus_reference": q_unknown_skus_reference,
    "catalog_csv": q_catalog_csv,
    "sku_reference_file": q_sku_reference_file,
    "jsonl_lines": q_jsonl_lines,
    "union_mixed_files": q_union_mixed_files,
    "stream_windows": q_stream_windows,
    "recover_second_run": q_recover_second_run,
    "curated_counts": q_curated_counts,
    "curated_kpis": q_curated_kpis,
    "incremental_counts": q_incremental_counts,
    "incremental_kpis": q_incremental_kpis,
    "active_skus_by_day": q_active_skus_by_day,
    "insights_fallback": q_insights_fallback,
    "incremental_latest": q_incremental_latest,
    "incremental_low_stock": q_incremental_low_stock,
    "latest_state_stored": q_latest_state_stored,
    "heavy_entities": q_heavy_entities,
    "heavy_parts": q_heavy_parts,
    "stream_keyed_dedup": q_stream_keyed_dedup,
}
