"""Evidence of outages, the intervals it makes, and labels with explicit censoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import vocabulary as V
from quarry.functions.scalars import DAY_US, HOUR_US, digest16, state_of

MINUTE_US = 60_000_000


def alarms_to_events(alarms: DataFrame) -> DataFrame:
    """An ACTIVATED event at each alarm's start and a CLEARED one at its clear time.

    An alarm without a start makes none. Acknowledgement is no recovery and makes none.
    ``alarms`` has device_id, alarm_id, alarm_type, start_us and clear_us.
    """
    scope = F.when(F.col("alarm_type").rlike(V.CAMERA_CHANNEL), "camera").otherwise("device")
    event = lambda state, us: F.struct(F.lit(state).alias("state"), F.col(us).alias("us"))
    both = F.filter(F.array(event("ACTIVATED", "start_us"), event("CLEARED", "clear_us")), lambda e: e["us"].isNotNull())
    return alarms.where("start_us IS NOT NULL").select(
        "device_id", "alarm_id", "alarm_type", scope.alias("scope"), F.explode(both).alias("e")
    ).select("device_id", "alarm_id", "alarm_type", "scope", "e.state", "e.us")


def payload_field(fields: Column, data: Column, names: Sequence[str]) -> Column:
    """The first non-blank of the named fields, in a payload's fields or in those of its ``data``."""
    picks = [F.try_element_at(m, F.lit(n)) for n in names for m in (fields, data)]
    return F.get(F.filter(F.array(*picks), lambda v: F.trim(v) != ""), F.lit(0))


def classify_events(events: DataFrame) -> DataFrame:
    """Add evidence_type and evidence_strength; events of no known kind are dropped.

    ``events`` has event_type, payload (JSON text) and, for bridged alarms, scope and
    state (else null).
    """
    kind = F.upper("event_type")
    json = "map<string, string>"
    parsed = events.withColumn("_fields", F.from_json("payload", json)).withColumn("_data", F.from_json(F.col("_fields.data"), json))
    parsed = parsed.withColumns(
        {
            "_method": F.lower(F.trim(payload_field(F.col("_fields"), F.col("_data"), ["method", "event", "action", "type", "status", "state"]))),
            "_blob": F.coalesce(F.trim(payload_field(F.col("_fields"), F.col("_data"), ["alarmType", "type", "name"])), F.col("payload")),
        }
    )
    method, blob = F.coalesce("_method", F.lit("")), F.col("_blob")
    lifecycle = kind.isin("LC_EVENT", "LIFECYCLE")
    alarm = kind.startswith("ALARM")
    evidence = (
        F.when(lifecycle & method.isin(V.LIFECYCLE_OFFLINE), "lc_disconnect")
        .when(lifecycle & method.isin(V.LIFECYCLE_ONLINE), "lc_connect")
        .when(alarm & (F.col("scope") == "camera"), "alarm_channel")
        .when(alarm & (F.col("state") == "ACTIVATED"), "alarm_offline")
        .when(alarm & (F.col("state") == "CLEARED"), "alarm_cleared")
        .when(alarm & blob.rlike(V.CAMERA_CHANNEL), "alarm_channel")
        .when(alarm & blob.rlike(V.ALARM_OFFLINE_TEXT) & ~blob.rlike(V.ALARM_ONLINE_TEXT), "alarm_offline")
        .when(alarm & blob.rlike(V.ALARM_ONLINE_TEXT), "alarm_cleared")
        .when(kind == "ERROR", "error_event")
        .when(F.col("_data.currentAttr").isNotNull(), "current_attr_snapshot")
    )
    strength = F.create_map(*(F.lit(x) for pair in V.EVIDENCE_STRENGTH.items() for x in pair))
    found = parsed.select(*events.columns, evidence.alias("evidence_type")).where("evidence_type IS NOT NULL")
    return found.withColumn("evidence_strength", strength[F.col("evidence_type")])


def classify_state(c: Column) -> Column:
    return state_of(c)


def outage_windows(
    evidence: DataFrame, offline: Column, online: Column, *, by: Sequence[str] = ("device_id",), min_minutes: float = 5, order: str = "arrival_seq"
) -> DataFrame:
    """Pair each first offline event with the next online event.

    Further offline events before the online one belong to the same outage. An online
    event always ends the outage, but one shorter than ``min_minutes`` is left out. An
    outage without an online event after it stays open: outage_end is null.
    """
    marks = evidence.withColumns({"_off": offline, "_on": online}).where("_off OR _on")
    before = Window.partitionBy(*by).orderBy("us", order).rowsBetween(Window.unboundedPreceding, -1)
    island = F.coalesce(F.sum(F.col("_on").cast("int")).over(before), F.lit(0))
    found = marks.withColumn("_island", island).groupBy(*by, "_island").agg(
        F.min(F.when(F.col("_off"), F.col("us"))).alias("outage_start"), F.max(F.when(F.col("_on"), F.col("us"))).alias("outage_end")
    )
    length = F.col("outage_end") - F.col("outage_start")
    kept = F.col("outage_end").isNull() | (length >= min_minutes * MINUTE_US)
    return found.where(F.col("outage_start").isNotNull() & kept).select(
        *by, "outage_start", "outage_end", (length / MINUTE_US).alias("duration_minutes"), F.col("outage_end").isNotNull().alias("window_closed")
    )


def alarm_labels(alarms: DataFrame) -> DataFrame:
    """An interval per alarm, ended by its clear time and never by acknowledgement."""
    return alarms.where("start_us IS NOT NULL").select(
        "device_id", "alarm_id", F.col("start_us").alias("outage_start"), F.col("clear_us").alias("outage_end"),
        F.when(F.col("clear_us").isNotNull(), "high").otherwise("medium").alias("confidence"),
    )


def dedupe_labels(labels: DataFrame, tolerance_s: int = 60) -> DataFrame:
    """One label per device and time bucket: the best confidence, then the earliest, then by source."""
    rank = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).when(F.col("confidence") == "low", 1).otherwise(0)
    bucket = F.floor(F.col("outage_start") / (tolerance_s * 1_000_000))
    best = Window.partitionBy("device_id", bucket).orderBy(rank.desc(), "outage_start", "source")
    return labels.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")


def evidence_spans(evidence: DataFrame) -> DataFrame:
    """Per device the days between its first and last strong evidence, and how many there are."""
    return evidence.where("evidence_strength = 'strong'").groupBy("device_id").agg(
        ((F.max("us") - F.min("us")) / float(DAY_US)).alias("span_days"), F.count(F.lit(1)).alias("n_strong")
    )


def coverage_verdicts(ledger: DataFrame, coverage_end_us: int, min_days: float = 7) -> DataFrame:
    """Per device: covered (some source query succeeded), newest_us and stale."""
    good = F.lower("completeness").isin(V.COVERED_STATUSES)
    newest = F.max(F.when(good, F.col("newest_us")))
    return ledger.groupBy("device_id").agg(F.max(good).alias("covered"), newest.alias("newest_us")).withColumn(
        "stale", F.coalesce((F.lit(coverage_end_us) - F.col("newest_us")) > min_days * DAY_US, F.lit(True))
    )


def sweep(samples: DataFrame, windows: DataFrame, horizon_us: int) -> DataFrame:
    """Add inside and n_ahead to samples (device_id, anchor_us, ...): what intervals (outage_start, outage_end) mean for them.

    ``inside``: an interval that has an end holds the anchor, ends included. ``n_ahead``: how many start in
    (anchor, anchor + horizon]. Starts, starts less the horizon and anchors of a device pass once in
    order of time: of starts that came by less the horizon, those that came by themselves
    are not ahead any more. So work grows with samples and intervals, not with pairs of them.
    """
    sample = F.struct(*(F.col(f"`{c}`") for c in samples.columns))
    marks = windows.where("outage_start IS NOT NULL").select("device_id", F.inline(F.array(
        F.struct(F.col("outage_start").alias("_us"), F.lit(-1).alias("_n"), F.col("outage_end").alias("_end")),
        F.struct((F.col("outage_start") - horizon_us).alias("_us"), F.lit(1).alias("_n"), F.lit(None).cast("long").alias("_end")),
    )))
    anchors = samples.select("device_id", F.col("anchor_us").alias("_us"), F.lit(0).alias("_n"), F.lit(None).cast("long").alias("_end"), sample.alias("_sample"))
    rows = anchors.unionByName(marks, allowMissingColumns=True)
    # marks of an anchor's own time come before it
    upto = Window.partitionBy("device_id").orderBy("_us", F.col("_sample").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = rows.withColumns({"_ahead": F.sum("_n").over(upto), "_last": F.max("_end").over(upto)}).where("_sample IS NOT NULL")
    inside = F.coalesce(F.col("_last") >= F.col("_us"), F.lit(False))
    return passed.select("_sample.*", inside.alias("inside"), F.col("_ahead").cast("long").alias("n_ahead"))


def next_start(samples: DataFrame, windows: DataFrame) -> DataFrame:
    """Add first_start to samples: the earliest start of an interval after the anchor."""
    sample = F.struct(*(F.col(f"`{c}`") for c in samples.columns))
    anchors = samples.select("device_id", F.col("anchor_us").alias("_us"), F.lit(None).cast("long").alias("_start"), sample.alias("_sample"))
    marks = windows.select("device_id", F.col("outage_start").alias("_us"), F.col("outage_start").alias("_start")).where("_us IS NOT NULL")
    rows = anchors.unionByName(marks, allowMissingColumns=True)
    # backwards in time, and anchors before starts of their own time, which are not after them
    later = Window.partitionBy("device_id").orderBy(F.desc("_us"), F.col("_sample").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("first_start", F.last("_start", ignorenulls=True).over(later)).where("_sample IS NOT NULL")
    return found.select("_sample.*", "first_start")


def label_samples(
    samples: DataFrame, windows: DataFrame, spans: DataFrame, coverage_end_us: int, *, verdicts: DataFrame | None = None,
    horizon_hours: int = 24, min_span_days: float = 7,
) -> DataFrame:
    """Add y (1, 0 or null), label_status and censor_reason to samples (device_id, anchor_us, split).

    A negative needs proof that an outage would have been seen; what cannot be
    known is censored, by the first reason that holds. Intervals meet anchors in one
    pass in order of time (``sweep``); all facts about a device are one row.
    """
    horizon = horizon_hours * HOUR_US
    verified = windows.where("window_closed")
    any_verified = verified.limit(1).select(F.lit(True).alias("_any"))
    open_since = windows.where("NOT window_closed").groupBy("device_id").agg(F.min("outage_start").alias("_open"))
    columns = [F.col(f"`{c}`") for c in samples.columns]
    swept = sweep(samples, verified, horizon).withColumnsRenamed({"inside": "_inside", "n_ahead": "_n_ahead"})
    facts = swept.join(open_since, "device_id", "left").join(spans, "device_id", "left").join(F.broadcast(any_verified), how="left")
    gated = F.lit(verdicts is not None)
    if verdicts is not None:
        facts = facts.join(verdicts.select("device_id", F.col("covered").alias("_covered"), F.col("stale").alias("_stale")), "device_id", "left")
    else:
        facts = facts.withColumns({"_covered": F.lit(None).cast("boolean"), "_stale": F.lit(None).cast("boolean")})
    t, ahead = F.col("anchor_us"), F.col("_n_ahead") > 0
    reason = (
        F.when(F.col("_any").isNull(), "no_verified_outage_source")
        .when(F.col("split") == "purged", "split_purge_gap")
        .when(t + horizon > coverage_end_us, "future_label_coverage_incomplete")
        .when(F.col("_open") <= t, "inside_verified_outage")
        .when(F.col("_inside"), "inside_verified_outage")
        .when(ahead, F.lit(None))
        .when(gated & ~F.coalesce("_covered", F.lit(False)), "no_label_source_coverage_for_device")
        .when(gated & F.coalesce("_stale", F.lit(True)), "label_source_history_stale")
        .when(~gated & (F.coalesce("span_days", F.lit(0.0)) < min_span_days), "unverified_negative_coverage")
        .when(F.col("_open").isNotNull(), "open_outage_window_unverified")
    )
    return facts.withColumn("censor_reason", reason).select(
        *columns,
        F.when(F.col("censor_reason").isNull(), F.when(ahead, 1).otherwise(0)).alias("y"),
        F.when(F.col("censor_reason").isNull(), "measured").otherwise("censored").alias("label_status"),
        "censor_reason",
    )


def eligibility(samples: DataFrame) -> DataFrame:
    """Add eligible and anomaly_eligible to labelled samples that have n_rows, last_age_h and split."""
    ready = F.coalesce(F.col("n_rows") > 0, F.lit(False))
    in_split = F.col("split").isin("train", "validation", "test")
    fresh = F.coalesce(F.col("last_age_h") <= 24, F.lit(False))
    reason = (
        F.when(~ready, "no_history").when(F.col("censor_reason").isNotNull(), F.col("censor_reason")).when(~fresh, "stale_data")
    )
    return samples.withColumns(
        {
            "ineligible_reason": reason,
            "eligible": ready & (F.col("label_status") == "measured") & in_split & fresh,
            "anomaly_eligible": ready & in_split,
        }
    )


def redacted_reference(*columns: Column) -> Column:
    return digest16(*columns)
