"""Curated summaries over raw (valid) events: P3, P7, P8, P15, J2-J5, A3-A9, A11-A15, T1-T4, U3, F16-F19, F21, F25.

Conventions: raw frames have the stored shape (envelope + ``payload`` struct).
Every per-key result is an aggregate (partial aggregation first), dimension
joins happen after pre-aggregation where the result allows it, and top-k
results are ``orderBy(...).limit(k)`` (planned as TakeOrderedAndProject) with a
unique last sort key so that ties are deterministic (decision D21).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators.keys import DEFAULT_BROADCAST_ROWS, sized_broadcast

UNKNOWN_CATEGORY = "Unknown"


# ---- projections and filters ---------------------------------------------------------
def top_items(raw: DataFrame) -> DataFrame:
    """The bare ``event_id, event_type, entity_id`` projection."""
    return raw.select("event_id", "event_type", "entity_id")


def low_stock_alerts(raw: DataFrame, threshold: int = R.LOW_STOCK_THRESHOLD) -> DataFrame:
    """P8 + P3: low-stock **events** (strictly below the threshold); the nested filter is pushed to Parquet."""
    return raw.filter(F.col("payload.current_stock_level") < F.lit(threshold)).select(
        "event_id", "event_type", "entity_id", "payload.*"
    )


# ---- dimension lookups ---------------------------------------------------------------
def enrich(facts: DataFrame, catalog: DataFrame, key: str = "entity_id",
           broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join facts to the catalog on ``key = sku_id``; the right key is dropped.

    The catalog is broadcast only under a checked row bound; beyond it Spark plans a
    shuffle join, and AQE splits a hot SKU's partition on the fact side.
    """
    cat = catalog.select(F.col("sku_id").alias(key), "product_name", "category")
    return facts.join(sized_broadcast(cat, broadcast_rows), key, "left")


def lookup_names(rows: DataFrame, catalog: DataFrame, key: str = "entity_id") -> DataFrame:
    """J3 for a handful of rows (a top-k result): ``display_name = coalesce(product_name, key)``.

    ``rows`` is tiny by construction (a limit), so its keys are broadcast to filter the
    catalog first; only matching catalog rows are joined.
    """
    keys = F.broadcast(rows.select(F.col(key).alias("sku_id")).distinct())
    names = catalog.join(keys, "sku_id", "left_semi").groupBy("sku_id").agg(F.min("product_name").alias("product_name"))
    named = rows.join(F.broadcast(names.withColumnRenamed("sku_id", key)), key, "left")
    return named.withColumn("display_name", F.coalesce(F.col("product_name"), F.col(key))).drop("product_name")


def sku_reference_defaults(catalog: DataFrame, sku_ref: DataFrame, *,
                           default_price: float = R.DEFAULT_PRICE,
                           default_stock: int = R.DEFAULT_STARTING_STOCK) -> DataFrame:
    """Catalog with reference price/stock, defaults where the reference has no row."""
    ref = sku_ref.select("sku_id", F.col("price").alias("_p"), F.col("starting_stock").alias("_s"))
    return catalog.join(ref, "sku_id", "left").select(
        "sku_id", "product_name", "category",
        F.coalesce(F.col("_p"), F.lit(default_price)).alias("price"),
        F.coalesce(F.col("_s"), F.lit(default_stock)).cast("int").alias("starting_stock"),
    )


def unknown_skus(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """SKUs named by events that have no catalog row, with their event counts.

    Events are counted per SKU first (partial aggregation), so the anti join sees
    one row per SKU instead of one per event.
    """
    per_sku = raw.groupBy(F.col("payload.sku_id").alias("sku_id")).agg(F.count(F.lit(1)).alias("events"))
    return per_sku.filter(F.col("sku_id").isNotNull()).join(catalog.select("sku_id"), "sku_id", "left_anti")


# ---- latest state per entity (A8, P15, T1, T3) ------------------------------------------
def latest_state(raw: DataFrame) -> DataFrame:
    """The latest whole row per entity by parsed event time; unparsable times lose,
    ties go to the larger ``event_id``; rows without an entity are dropped (D9).

    ``max_by`` is a declarative aggregate: it is combined map-side, so a hot entity
    costs one partial row per task.
    """
    flat = raw.select(
        "entity_id",
        F.struct(
            "event_id", "event_type", "event_ts", "source",
            *[F.col(f"payload.{c}").alias(c) for c in schemas.PAYLOAD_FIELDS],
        ).alias("row"),
        F.struct(R.parse_iso(F.col("event_ts")).alias("t"), F.col("event_id").alias("i")).alias("ord"),
    )
    return (
        flat.filter(F.col("entity_id").isNotNull())
        .groupBy("entity_id")
        .agg(F.max_by("row", "ord").alias("row"))
        .select("entity_id", "row.*")
    )


def low_stock_skus(latest: DataFrame, catalog: DataFrame, threshold: int = R.LOW_STOCK_THRESHOLD,
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """P15 + J2: entities whose latest level is below the threshold, with a display name."""
    low = latest.filter(F.col("current_stock_level") < F.lit(threshold))
    named = enrich(low, catalog, "entity_id", broadcast_rows)
    return named.select(
        "entity_id", "event_id", "current_stock_level",
        F.coalesce(F.col("product_name"), F.col("entity_id")).alias("display_name"),
        "category",
    )


def lowest(rows: DataFrame, k: int, tie: str) -> DataFrame:
    """The k lowest stock rows, ties by ``tie``."""
    return rows.orderBy(F.col("current_stock_level").asc_nulls_last(), F.col(tie).asc()).limit(k)


def low_stock_top(latest: DataFrame, catalog: DataFrame, k: int = 5,
                  threshold: int = R.LOW_STOCK_THRESHOLD) -> DataFrame:
    """The k lowest latest-state SKUs under the threshold, named."""
    low = latest.filter(F.col("current_stock_level") < F.lit(threshold))
    top = lowest(low.select("entity_id", "event_id", "current_stock_level"), k, "entity_id")
    return lookup_names(top, catalog)


def low_stock_events_top(alerts: DataFrame, catalog: DataFrame, k: int = 5) -> DataFrame:
    """T2 + J3: the k lowest low-stock events, named; level truncated to int."""
    top = lowest(alerts.select("event_id", "entity_id", F.col("current_stock_level").cast("int")), k, "event_id")
    return lookup_names(top, catalog)


def low_stock_or_fallback(curated: DataFrame, raw: DataFrame, catalog: DataFrame,
                          threshold: int = R.LOW_STOCK_THRESHOLD) -> DataFrame:
    """Curated low-stock events if there are any, else latest-state low SKUs from raw.

    The choice is one ``isEmpty()`` probe (reads at most one row), not a data transfer.
    """
    cols = ["entity_id", "current_stock_level", "display_name", "origin"]
    if not curated.isEmpty():
        named = enrich(curated.select("entity_id", "current_stock_level"), catalog)
        return named.select(
            "entity_id", "current_stock_level",
            F.coalesce(F.col("product_name"), F.col("entity_id")).alias("display_name"),
            F.lit("curated").alias("origin"),
        )
    low = low_stock_skus(latest_state(raw), catalog, threshold)
    return low.select("entity_id", "current_stock_level", "display_name", F.lit("latest_state").alias("origin")).select(*cols)


# ---- counts ----------------------------------------------------------------------------
def kpis(raw: DataFrame, alerts: DataFrame, rejects: DataFrame, approx: bool = False) -> DataFrame:
    """A3 + A4: one row of dashboard counts.

    The three inputs are tagged and unioned, then reduced by one aggregate: one job,
    no cross join of one-row frames.
    """
    tagged = (
        raw.select(F.lit(1).alias("_k"), F.col("entity_id"))
        .unionByName(alerts.select(F.lit(2).alias("_k"), F.lit(None).cast("string").alias("entity_id")))
        .unionByName(rejects.select(F.lit(3).alias("_k"), F.lit(None).cast("string").alias("entity_id")))
    )
    ent = F.when(F.col("_k") == 1, F.col("entity_id"))
    distinct = F.approx_count_distinct(ent) if approx else F.count_distinct(ent)
    return tagged.agg(
        F.count_if(F.col("_k") == 1).alias("total_transactions"),
        distinct.alias("active_skus"),
        F.count_if(F.col("_k") == 2).alias("low_stock_events"),
        F.count_if(F.col("_k") == 3).alias("quarantined_events"),
    )


def counts_by(df: DataFrame, col: str, name: str | None = None, where: Column | None = None) -> DataFrame:
    """Events per value of a column, of the rows for which ``where`` is true.

    The condition is counted, not filtered on: a filter on a derived column is pushed below the
    projection that derives it (and through a repartitioning), so a line would be parsed twice."""
    per = df.groupBy(F.col(col).alias(name or col))
    if where is None:
        return per.agg(F.count(F.lit(1)).alias("events"))
    return per.agg(F.count_if(where).alias("events")).filter("events > 0")


def most_common(df: DataFrame, col: str) -> DataFrame:
    """The most frequent value; ties go to the smaller value."""
    return counts_by(df, col).orderBy(F.col("events").desc(), F.col(col).asc()).limit(1)


def top_sku(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """A9 + J3: the most active entity with its display name."""
    top = most_common(raw.filter(F.col("entity_id").isNotNull()), "entity_id")
    return lookup_names(top, catalog).select("entity_id", "display_name", "events")


def top_categories(facts: DataFrame, catalog: DataFrame, k: int = 10, key: str = "entity_id",
                   broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A6 + T4: transactions per category (unmatched → ``Unknown``), top k, ties by name.

    Facts are counted per SKU before the catalog join, so the join sees one row per
    SKU; then per-SKU counts are summed per category.
    """
    per_sku = facts.groupBy(F.col(key).alias("sku_id")).agg(F.count(F.lit(1)).alias("n"))
    return ranked_categories(per_sku, catalog, k, broadcast_rows)


def ranked_categories(per_sku: DataFrame, catalog: DataFrame, k: int = 10,
                      broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``top_categories`` of facts that are counted per SKU already: ``(sku_id, n)``."""
    cat = sized_broadcast(catalog.select("sku_id", "category"), broadcast_rows)
    joined = per_sku.join(cat, "sku_id", "left")
    per_cat = joined.groupBy(F.coalesce(F.col("category"), F.lit(UNKNOWN_CATEGORY)).alias("category")).agg(
        F.sum("n").alias("transactions")
    )
    return per_cat.orderBy(F.col("transactions").desc(), F.col("category").asc()).limit(k)


def event_hours(parsed: DataFrame) -> DataFrame:
    """hour of day of every line, null unless it parses and its event time has the ISO shape."""
    ts = F.col("data.event_ts")
    return parsed.select(F.when(R.iso_shape(ts), F.substring(ts, 12, 2).cast("int")).alias("hour"))


def hourly_histogram(parsed: DataFrame) -> DataFrame:
    """Events per hour of day. Lines without an hour are dropped after counting (see ``counts_by``)."""
    return event_hours(parsed).groupBy("hour").agg(F.count("hour").alias("events")).filter("events > 0")


# Rush hours and off-peak hours of the traffic-shape check.
LUNCH_RUSH = (12, 13)
EVENING_RUSH = (17, 18)
MORNING_OFF_PEAK = (8, 9)
AFTERNOON_OFF_PEAK = (14, 15)


def rush_vs_offpeak(parsed: DataFrame) -> DataFrame:
    """Rush-hour and off-peak sums in one aggregate."""
    h = F.col("hour")
    return event_hours(parsed).agg(
        F.count_if(h.isin(list(LUNCH_RUSH))).alias("lunch_rush"),
        F.count_if(h.isin(list(EVENING_RUSH))).alias("evening_rush"),
        F.count_if(h.isin(list(MORNING_OFF_PEAK))).alias("morning_off_peak"),
        F.count_if(h.isin(list(AFTERNOON_OFF_PEAK))).alias("afternoon_off_peak"),
    )


def counts_per_window(raw: DataFrame, duration: str = "1 hour", slide: str | None = None) -> DataFrame:
    """A15 (tumbling) / ST11 (sliding) windows over the parsed event time, batch form."""
    t = R.parse_iso(F.col("event_ts"))
    w = F.window(t, duration, slide) if slide else F.window(t, duration)
    return (
        raw.filter(t.isNotNull())
        .groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
            F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"),
            "events",
        )
    )


# ---- insights (F25) ------------------------------------------------------------------------
# The texts of the all-clear and of the top-SKU message.
def insights(raw: DataFrame, alerts: DataFrame, rejects: DataFrame, catalog: DataFrame,
             threshold: int = R.LOW_STOCK_THRESHOLD) -> DataFrame:
    """one message row per insight, each text built from an aggregate.

    Without curated low-stock events, the items whose latest state is low are counted instead;
    without either, one row says that nothing is low. Messages are rows (``kind, message``) unioned from tiny aggregates, so nothing is
    collected and no one-row frames are cross-joined.
    """
    q = rejects.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0).select(
        F.lit("quarantine").alias("kind"),
        F.format_string("%d event(s) quarantined, pending recovery", F.col("n")).alias("message"),
    )
    latest = low_stock_skus(latest_state(raw), catalog, threshold)
    counts = alerts.agg(F.count(F.lit(1)).alias("n")).select(F.lit(1).alias("k"), "n").unionByName(
        latest.agg(F.count(F.lit(1)).alias("n")).select(F.lit(2).alias("k"), "n"))
    n = counts.agg(F.max(F.when(F.col("k") == 1, F.col("n"))).alias("events"), F.max(F.when(F.col("k") == 2, F.col("n"))).alias("items"))
    low = n.select(
        F.lit("low_stock").alias("kind"),
        F.when(F.col("events") > 0, F.format_string("%d low-stock event(s) below the threshold of %d", F.col("events"), F.lit(threshold)))
        .when(F.col("items") > 0, F.format_string("%d item(s) below the threshold of %d in their latest state", F.col("items"), F.lit(threshold)))
        .otherwise(F.lit("No immediate low-stock risk detected")).alias("message"),
    )
    typ = most_common(raw.filter(F.col("event_type").isNotNull()), "event_type").select(
        F.lit("top_event_type").alias("kind"),
        F.format_string("Most common event type: %s", F.col("event_type")).alias("message"),
    )
    sku = top_sku(raw, catalog).select(
        F.lit("top_sku").alias("kind"),
        F.format_string("Top active SKU: %s (%s)", F.col("display_name"), F.col("entity_id")).alias("message"),
    )
    return q.unionByName(low).unionByName(typ).unionByName(sku)
