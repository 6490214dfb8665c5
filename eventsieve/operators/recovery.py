"""Healing of quarantined records.

``heal_rejects`` reproduces the repair step as is (no revalidation, D14), with
the fixes of D11 (a stable generated id: ``md5`` of the original line) and D12
(an unparsable slashed time gives null and the row is not recovered).
``recover`` then runs the full rule set (V1-V11) over the healed rows against
the raw ids, so only clean rows go back to raw. ``pending_rejects`` uses a
ledger of handled reject keys instead of deleting the rejects folder (D13).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventsieve import schemas
from eventsieve.functions import rules as R
from eventsieve.operators.quality import validate_events


# Outcomes of a quarantined line in the recovery ledger.
RECOVERED, KEPT = "recovered", "kept"


def reject_key(line_col: str = "json_string"):
    """Identity of a quarantined line (two identical lines are one reject)."""
    return F.md5(F.col(line_col))


def heal_rejects(rejects: DataFrame, *, source_map: Mapping[str, str] = R.HEAL_SOURCE_MAP,
                 default_ts: str = R.HEAL_DEFAULT_TS,
                 allowed_types: Sequence[str] = R.DEFAULT_EVENT_TYPES,
                 allowed_sources: Sequence[str] = R.DEFAULT_SOURCES) -> DataFrame:
    """H1-H6 + P10/P11: healed rows in raw column order, plus the original line.

    * H1: the kept line is parsed again (the stored envelope columns are only used
      for the source and type, as stored).
    * H2: a null id becomes ``md5(line)`` (an empty id is not healed).
    * H3: ``yyyy/MM/dd HH:mm:ss`` → ISO; null → ``default_ts``; anything else unchanged.
    * H4: sources repaired through ``source_map``.
    * H5: a null payload is synthesised from the entity id and fixed defaults.
    * H6: keep rows whose healed source and (unhealed) type are allowed, and whose time is not null.
    """
    full = F.from_json(F.col("json_string"), schemas.ENVELOPE)
    df = rejects.withColumn("_full", full)
    ets = F.col("_full.event_ts")
    healed_ts = (
        F.when(ets.rlike(R.HEAL_SLASHED_TS_PREFIX),
               F.date_format(F.try_to_timestamp(ets, F.lit(R.HEAL_SLASHED_TS_FORMAT)), R.ISO_OUT_FORMAT))
        .when(ets.isNull(), F.lit(default_ts))
        .otherwise(ets)
    )
    synth = F.struct(
        F.col("entity_id").alias("sku_id"),
        F.lit(R.HEAL_PAYLOAD_DELTA).cast("int").alias("quantity_delta"),
        F.lit(R.HEAL_PAYLOAD_LEVEL).cast("int").alias("current_stock_level"),
        F.lit(R.HEAL_PAYLOAD_LANE).alias("checkout_lane"),
        F.lit(R.HEAL_PAYLOAD_PRICE).cast("double").alias("price"),
    )
    healed = df.select(
        F.col("json_string"),
        F.when(F.col("_full.event_id").isNull(), F.md5(F.col("json_string")))
        .otherwise(F.col("_full.event_id")).alias("event_id"),
        F.col("_full.event_type").alias("event_type"),
        healed_ts.alias("event_ts"),
        R.mapped(F.col("source"), source_map).alias("source"),
        F.col("_full.entity_id").alias("entity_id"),
        F.when(F.col("_full.payload").isNull(), synth).otherwise(F.col("_full.payload")).alias("payload"),
        F.col("event_type").alias("_stored_type"),
    )
    keep = (
        F.coalesce(F.col("source").isin(list(allowed_sources)), F.lit(False))
        & F.coalesce(F.col("_stored_type").isin(list(allowed_types)), F.lit(False))
        & F.col("event_ts").isNotNull()
    )
    return healed.filter(keep).drop("_stored_type")


def healed_as_parsed(healed: DataFrame) -> DataFrame:
    """Healed rows in the validator's input shape: the original line, the gate, the healed envelope.

    Order for the in-batch duplicate rule: healed event time, then the line text
    (a deterministic total order; rejects carry no arrival order).
    """
    env = F.struct(*[F.col(c) for c in schemas.ENVELOPE_FIELDS])
    return healed.select(
        "json_string",
        F.lit(True).alias("json_ok"),
        env.alias("data"),
        F.col("event_ts").alias("_heal_ts"),
    )


def recover(rejects: DataFrame, raw_ids: DataFrame | None, *,
            source_map: Mapping[str, str] = R.HEAL_SOURCE_MAP,
            default_ts: str = R.HEAL_DEFAULT_TS,
            allowed_types: Sequence[str] = R.DEFAULT_EVENT_TYPES,
            allowed_sources: Sequence[str] = R.DEFAULT_SOURCES) -> DataFrame:
    """H7: heal, then validate again (V1-V11 against ``raw_ids``); returns clean rows in raw shape.

    A line that was quarantined several times is healed once (identical lines share an id,
    D11); the first step of that grouping runs before the shuffle, so a line that repeats
    very often costs one row per task. The line itself is kept as ``json_string`` so that the caller can record which
    rejects were handled.
    """
    rejects = rejects.dropDuplicates(["json_string"])
    healed = heal_rejects(rejects, source_map=source_map, default_ts=default_ts,
                          allowed_types=allowed_types, allowed_sources=allowed_sources)
    parsed = healed_as_parsed(healed)
    validated = validate_events(parsed, raw_ids, allowed_types=allowed_types, allowed_sources=allowed_sources,
                                order_by=("_heal_ts", "json_string"), total_order=True)
    valid = validated.filter(F.size("errors") == 0)
    return valid.select("json_string", "data.*")


def pending_rejects(rejects: DataFrame, handled_keys: DataFrame | None, rule_version: str | None = None) -> DataFrame:
    """H8: rejects whose key is not in the handled ledger (``reject_key`` column).

    With ``rule_version``, ledger rows of lines that were kept in quarantine (``outcome`` other
    than ``recovered``) count only for that version of the rules: such a line is healed again when
    the rules change, and not on every run.

    The ledger side is not de-duplicated: an anti join does not need it, and with two
    plain shuffles AQE can split a hot key (many identical quarantined lines).
    """
    if handled_keys is None:
        return rejects
    if rule_version is not None:
        handled_keys = handled_keys.filter((F.col("outcome") == RECOVERED) | (F.col("rule_version") == rule_version))
    keyed = rejects.withColumn("reject_key", reject_key())
    return keyed.join(handled_keys.select("reject_key"), "reject_key", "left_anti").drop("reject_key")


def processed_keys(pending: DataFrame, recovered: DataFrame, rule_version: str) -> DataFrame:
    """H8: one ledger row per pending line: recovered, or kept in quarantine under these rules."""
    done = handled_keys(recovered).distinct().withColumn("_done", F.lit(True))
    keys = pending.select(reject_key().alias("reject_key")).distinct().join(done, "reject_key", "left")
    outcome = F.when(F.col("_done"), F.lit(RECOVERED)).otherwise(F.lit(KEPT))
    return keys.select("reject_key", outcome.alias("outcome"), F.lit(rule_version).alias("rule_version"))


def handled_keys(recovered: DataFrame) -> DataFrame:
    """Ledger rows for recovered lines (one per recovered row; repeats are harmless)."""
    return recovered.select(reject_key().alias("reject_key"))


def raw_after_recovery(raw: DataFrame, recovered: DataFrame) -> DataFrame:
    """The raw view after recovery: stored rows plus recovered rows, by column name."""
    return raw.select(*schemas.ENVELOPE_FIELDS).unionByName(recovered.select(*schemas.ENVELOPE_FIELDS))

