"""Parse, validate and split events.

``validate_events`` adds ``errors ARRAY<STRING>``: eleven rule slots in a fixed
order, nulls removed. All rules are built-in column expressions in one
projection; the two duplicate rules need one aggregate over the batch keys and
one join back (see ``operators.keys``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators.keys import HOT_KEY_ROWS, history_hits, join_back, join_key, order_struct, present_key, winners
from eventsieve.session import stored

# Columns that order the rows of one id, oldest first; those that a frame lacks are left out.
DEFAULT_ORDER = ("arrival_ts", "partition", "seq")
FALLBACK_ORDER = ("timestamp",)
# Stored row number that makes any order total (see ``numbered``).
ROW_ID = "_row_id"


def parse_events(lines: DataFrame, json_col: str = "json_string") -> DataFrame:
    """Add ``json_ok`` (the V1 gate, computed once) and the parsed envelope ``data``.

    A line that fails the gate gets a null envelope, so a truncated line never
    competes in duplicate ranking and is never healed (decision D2).
    """
    s = F.col(json_col)
    return lines.withColumn("json_ok", R.json_gate(s)).withColumn(
        "data", F.when(F.col("json_ok"), F.from_json(s, schemas.ENVELOPE))
    )


def envelope_columns(prefix: str = "data") -> list[Column]:
    """P2 + P3 + F17: envelope fields and payload fields as top-level columns."""
    env = [F.col(f"{prefix}.{c}").alias(c) for c in schemas.ENVELOPE_FIELDS if c != "payload"]
    pay = [F.col(f"{prefix}.payload.{c}").alias(c) for c in schemas.PAYLOAD_FIELDS]
    return env + pay


def _field(name: str) -> Column:
    return F.col(f"data.{name}")


def rule_columns(allowed_types: Sequence[str], allowed_sources: Sequence[str], *,
                 strict_ts: bool = False, strict_payload: bool = False) -> list[Column]:
    """V1-V9 as nine nullable message columns (slot order is part of the contract)."""
    ok = F.col("json_ok")
    eid, etype, ets, src, payload = (_field(c) for c in ("event_id", "event_type", "event_ts", "source", "payload"))
    bad_ts = ~R.iso_shape(ets)
    if strict_ts:
        bad_ts = bad_ts | R.parse_iso(ets).isNull()
    missing_payload = payload.isNull()
    if strict_payload:
        inner = None
        for c in ("sku_id", "quantity_delta", "current_stock_level", "price"):
            t = _field(f"payload.{c}").isNull()
            inner = t if inner is None else inner | t
        missing_payload = missing_payload | inner
    return [
        F.when(~ok, F.lit(R.MSG_PARSE)),
        F.when(ok & R.blank(eid), F.lit(R.MSG_MISSING_ID)),
        F.when(ok & R.blank(etype), F.lit(R.MSG_MISSING_TYPE)),
        F.when(ok & R.blank(ets), F.lit(R.MSG_MISSING_TS)),
        F.when(ok & R.blank(src), F.lit(R.MSG_MISSING_SOURCE)),
        F.when(ok & missing_payload, F.lit(R.MSG_MISSING_PAYLOAD)),
        F.when(ok & R.present(etype) & R.not_in(etype, allowed_types), R.labelled(R.MSG_BAD_TYPE, etype)),
        F.when(ok & R.present(src) & R.not_in(src, allowed_sources), R.labelled(R.MSG_BAD_SOURCE, src)),
        F.when(ok & R.present(ets) & bad_ts, R.labelled(R.MSG_BAD_TS, ets)),
    ]


def numbered(parsed: DataFrame) -> DataFrame:
    """The frame with a stored row number. Equal order values (offsets of two partitions, a line
    delivered twice) then still leave one newest row, the same one in every pass and retry."""
    return stored(parsed.withColumn(ROW_ID, F.monotonically_increasing_id()), "numbered")


def _ordered_rows(parsed: DataFrame, order_by: Sequence[str | Column], total_order: bool) -> tuple[DataFrame, DataFrame]:
    """The parsed frame, and the same rows with ``_id``, the join key ``_jk`` and a total ``_order``."""
    if ROW_ID not in parsed.columns and not total_order:
        parsed = numbered(parsed)
    has = set(parsed.columns)
    order = [c for c in order_by if not isinstance(c, str) or c in has] or [c for c in FALLBACK_ORDER if c in has]
    order += [ROW_ID] if ROW_ID in has else []
    eid = _field("event_id")
    rows = parsed.withColumn("_id", F.when(F.col("json_ok") & R.present(eid), eid))
    return parsed, rows.withColumn("_jk", join_key("_id")).withColumn("_order", order_struct(order))


def validate_events(parsed: DataFrame, history: DataFrame | Callable[[DataFrame], DataFrame] | None = None, *,
                    allowed_types: Sequence[str] = R.DEFAULT_EVENT_TYPES,
                    allowed_sources: Sequence[str] = R.DEFAULT_SOURCES,
                    order_by: Sequence[str | Column] = DEFAULT_ORDER,
                    strict_ts: bool = False, strict_payload: bool = False,
                    dedup_valid_only: bool = False,
                    total_order: bool = False,
                    hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """V1-V12 over a parsed batch; returns the input columns plus ``errors``.

    * V10: a row with an id that is not the newest row of that id in the batch (``order_by``
      descending, columns that the frame lacks left out). Exactly one row of an id stays:
      ties are broken by a stored row number, which is added here unless the frame has one
      (``numbered``) or the caller states that the order is total. By default invalid rows
      take part in the ranking (D5); ``dedup_valid_only`` ranks only rows without V1-V9 errors.
    * V11: the id occurs in ``history`` (a frame with an ``event_id`` column, such
      as the ids of the raw table). The history is semi-joined to the batch keys,
      so a repeated id there never multiplies rows (D17). It may also be a function from
      the batch's keys (column ``_hid``) to the known ones, such as ``IdIndex.known``.

    Only ids with more than one row, or with a hit in the history, are joined back: a lone id
    is its own newest row. These ids are stored first, so Spark knows their size in bytes and
    broadcasts them when they are few; the rows are then not shuffled at all.
    """
    if "json_ok" not in parsed.columns:
        parsed = parse_events(parsed)
    rules9 = rule_columns(allowed_types, allowed_sources, strict_ts=strict_ts, strict_payload=strict_payload)
    parsed, rows = _ordered_rows(parsed, order_by, total_order)
    eligible = None
    if dedup_valid_only:
        eligible = F.size(F.array_compact(F.array(*rules9))) == 0
    keys = winners(rows, "_jk", ["_order"], newest=True, eligible=eligible, out="_winner").filter("_jk.k")
    if history is not None:
        keys = stored(keys, "batch-keys")
        batch_keys = keys.select(F.col("_jk.v").alias("_hid"))
        hits = history(batch_keys) if callable(history) else history_hits(batch_keys, history, "_hid")
        hits = hits.select(present_key("_hid").alias("_jk"), F.lit(True).alias("_seen"))
        keys = keys.join(hits, "_jk", "left")
    else:
        keys = keys.withColumn("_seen", F.lit(None).cast("boolean"))
    flagged = stored(keys.filter((F.col("_n") > 1) | F.coalesce("_seen", F.lit(False))), "flagged-keys")
    # Join back; hot ids and id-less rows are spread, not sent to one task.
    joined = join_back(rows, flagged, "_jk", spread=F.col("_id").isNull(), hot_rows=hot_rows)
    newest = F.col("_winner").isNull() | (F.col("_order") == F.col("_winner._order"))
    dup_batch = F.when(F.col("_id").isNotNull() & ~newest, F.lit(R.MSG_BATCH_DUP))
    dup_hist = F.when(F.col("json_ok") & F.coalesce(F.col("_seen"), F.lit(False)), F.lit(R.MSG_HISTORY_DUP)) \
        if history is not None else F.lit(None).cast("string")
    errors = F.array_compact(F.array(*rules9, dup_batch, dup_hist))
    out_cols = [c for c in parsed.columns if c != ROW_ID]
    return joined.select(*[F.col(c) for c in out_cols], errors.alias("errors"))


def is_valid() -> Column:
    return F.size("errors") == 0


def split_events(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows as raw envelope, rejected rows with joined reasons)."""
    valid = validated.filter(is_valid()).select("data.*")
    rejects = validated.filter(~is_valid()).select(
        F.col("json_string"),
        F.concat_ws("; ", F.col("errors")).alias("rejection_reason"),
        *[_field(c).alias(c) for c in ("event_id", "event_type", "event_ts", "source", "entity_id")],
    )
    return valid, rejects


def flatten_raw(raw: DataFrame) -> DataFrame:
    """Raw rows with payload fields as columns."""
    return raw.select(
        *[F.col(c) for c in schemas.ENVELOPE_FIELDS if c != "payload"],
        *[F.col(f"payload.{c}").alias(c) for c in schemas.PAYLOAD_FIELDS],
    )


def batch_counts(validated: DataFrame) -> DataFrame:
    """A1: total, valid and rejected rows in one aggregate (one job, one scan)."""
    return validated.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(is_valid()).alias("valid_records"),
        F.count_if(~is_valid()).alias("rejected_records"),
    )


def feed_ratio(parsed: DataFrame, *, allowed_types: Sequence[str] = R.DEFAULT_EVENT_TYPES,
               allowed_sources: Sequence[str] = R.DEFAULT_SOURCES,
               order_by: Sequence[str | Column] = ("seq",), hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """A10: valid/bad counts of a feed, the **first** line of an id counting as valid.

    A line is valid when it parses, has a non-empty id seen for the first time (in
    feed order, among parsed lines), an allowed type and source, an ISO-shaped time
    and a non-empty payload object (``{}`` is bad here, decision D23).
    """
    if "json_ok" not in parsed.columns:
        parsed = parse_events(parsed)
    ok = F.col("json_ok")
    _, rows = _ordered_rows(parsed, order_by, total_order=False)
    firsts = winners(rows, "_jk", ["_order"], newest=False, out="_first")
    firsts = stored(firsts.filter((F.col("_n") > 1) & F.col("_jk.k")), "repeated-keys")  # a lone id is its own first
    joined = join_back(rows, firsts, "_jk", spread=F.col("_id").isNull(), hot_rows=hot_rows)
    first = F.col("_id").isNotNull() & (F.col("_first").isNull() | (F.col("_order") == F.col("_first._order")))
    etype, ets, src = _field("event_type"), _field("event_ts"), _field("source")
    good = (
        ok & first
        & F.coalesce(etype.isin(list(allowed_types)), F.lit(False))
        & F.coalesce(R.iso_shape(ets), F.lit(False))
        & F.coalesce(src.isin(list(allowed_sources)), F.lit(False))
        & R.payload_truthy(F.col("json_string"))
    )
    return joined.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(good).alias("valid_lines"),
        F.count_if(~good).alias("bad_lines"),
    )
