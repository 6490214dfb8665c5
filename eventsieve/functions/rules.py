"""Column expressions for the quality rules, event keys and healing.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so
that the whole rule set stays inside one whole-stage-codegen projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the behaviour being reproduced) -------------------
# Shape of an ISO-8601 event time: date, 'T', time, optional fraction, optional zone.
ISO_TIMESTAMP_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}(:?\d{2})?)?$"
# Default allowed lists of the original pipeline.
DEFAULT_EVENT_TYPES = ("inventory.stock_change",)
DEFAULT_SOURCES = ("streamflow-producer",)
# Rejection messages, in slot order V1..V11.
MSG_PARSE = "Failed to parse JSON"
MSG_MISSING_ID = "Missing event_id"
MSG_MISSING_TYPE = "Missing event_type"
MSG_MISSING_TS = "Missing event_ts"
MSG_MISSING_SOURCE = "Missing source"
MSG_MISSING_PAYLOAD = "Missing payload"
MSG_BAD_TYPE = "Invalid event_type"
MSG_BAD_SOURCE = "Invalid source"
MSG_BAD_TS = "Invalid timestamp"
MSG_BATCH_DUP = "Duplicate event_id in batch"
MSG_HISTORY_DUP = "Duplicate event_id (already processed)"
# Healing defaults of the recovery job.
HEAL_SLASHED_TS_PREFIX = r"^\d{4}/\d{2}/\d{2}"
HEAL_SLASHED_TS_FORMAT = "yyyy/MM/dd HH:mm:ss"
HEAL_DEFAULT_TS = "2026-07-09T12:00:00Z"
HEAL_SOURCE_MAP = {"invalid-source": "streamflow-producer"}
HEAL_PAYLOAD_DELTA = -1
HEAL_PAYLOAD_LEVEL = 50
HEAL_PAYLOAD_LANE = "lane-1"
HEAL_PAYLOAD_PRICE = 9.99
# Output time format (literal Z; the session zone is UTC).
ISO_OUT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Dimension defaults (catalog joined to SKU reference data).
DEFAULT_PRICE = 9.99
DEFAULT_STARTING_STOCK = 100
# Dashboard thresholds.
LOW_STOCK_THRESHOLD = 9
RESTOCK_TRIGGER_LEVEL = 15
# -------------------------------------------------------------------------------


def json_gate(s: Column) -> Column:
    """V1 gate: the line is a non-empty JSON document (``get_json_object(s,'$')``)."""
    return F.coalesce(s.isNotNull() & (s != F.lit("")) & F.get_json_object(s, "$").isNotNull(), F.lit(False))


def blank(c: Column) -> Column:
    """Null or empty string."""
    return c.isNull() | (c == F.lit(""))


def present(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def labelled(label: str, value: Column) -> Column:
    """``'<label>: <value>'`` (``concat_ws`` skips a null value)."""
    return F.concat_ws(": ", F.lit(label), value)


def iso_shape(ts: Column) -> Column:
    return ts.rlike(ISO_TIMESTAMP_REGEX)


def parse_iso(ts: Column) -> Column:
    """Lenient event-time parse: unparsable text gives null, never an error."""
    return F.try_to_timestamp(ts)


def event_key(line: Column, ok: Column | None = None) -> Column:
    """Routing key of a line: ``entity_id``, else ``payload.sku_id``; empty or malformed gives null."""
    ok = json_gate(line) if ok is None else ok
    key = F.coalesce(
        F.nullif(F.get_json_object(line, "$.entity_id"), F.lit("")),
        F.nullif(F.get_json_object(line, "$.payload.sku_id"), F.lit("")),
    )
    return F.when(ok, key)


def payload_truthy(line: Column) -> Column:
    """The payload is present and not an empty or zero value (a feed-check notion): a non-empty object,
    list or text, a number other than 0, or true. ``{}``, ``[]``, ``""``, 0, false and null are bad."""
    value = F.get_json_object(line, "$.payload")
    entries = F.coalesce(F.size(F.json_object_keys(value)), F.json_array_length(value))
    is_text = line.rlike(r'"payload"\s*:\s*"')
    zero = value.rlike(r"^(false|-?0(\.0*)?([eE][+-]?[0-9]+)?)$")
    nothing = (value == "") | (~is_text & (F.coalesce(entries == 0, F.lit(False)) | zero))
    return F.coalesce(~nothing, F.lit(False))


def not_in(c: Column, allowed: Iterable[str]) -> Column:
    return ~c.isin(list(allowed))


def mapped(c: Column, mapping: Mapping[str, str]) -> Column:
    """Replace values by a small literal mapping (CASE WHEN chain), others unchanged."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return c if out is None else out.otherwise(c)
