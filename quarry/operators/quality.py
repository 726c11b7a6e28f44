"""Quarantine of bad records, key policy, device policy and redaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import vocabulary as V
from quarry.functions.scalars import HOUR_US, first_match, iso_micros

EPOCH_FLOOR_US = 946_684_800_000_000  # 2000-01-01


class PolicyError(ValueError):
    """An output would break the feature policy."""


def quarantine(raw: DataFrame, now_us: int, *, future_hours: int = 6) -> DataFrame:
    """Give every raw record its time, its kind and the reason why it is bad, if it is.

    ``raw`` has device_id, key, arrival_seq, time (text), value_num and value_text.
    Reasons by precedence: null_ts, unparseable_ts, epoch_like, future_ts, no_value,
    then duplicate for all but the last arrival of one device, key and time. Only
    good records compete as duplicates.
    """
    us = iso_micros(F.col("time"))
    reason = (
        F.when(F.col("time").isNull(), "null_ts")
        .when(F.col("us").isNull(), "unparseable_ts")
        .when(F.col("us") < EPOCH_FLOOR_US, "epoch_like")
        .when(F.col("us") > now_us + future_hours * HOUR_US, "future_ts")
        .when(F.col("value_num").isNull() & F.col("value_text").isNull(), "no_value")
    )
    judged = raw.withColumn("us", us).withColumn("reason", reason)
    last = Window.partitionBy("device_id", "key", "us", F.col("reason").isNull()).orderBy(F.col("arrival_seq").desc())
    later = F.row_number().over(last) > 1
    return judged.withColumn("reason", F.when(F.col("reason").isNull() & later, "duplicate").otherwise(F.col("reason"))).withColumn(
        "value_kind", F.when(F.col("value_num").isNotNull(), "numeric").otherwise("text")
    )


def quarantine_stats(raw: DataFrame, now_us: int, *, future_hours: int = 6) -> DataFrame:
    """One row: how many records meet each condition, whether or not another came first."""
    judged = quarantine(raw, now_us, future_hours=future_hours)
    us = F.col("us")
    return judged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("time").isNull()).alias("null_ts"),
        F.count_if(F.col("time").isNotNull() & us.isNull()).alias("unparseable_ts"),
        F.count_if(us < EPOCH_FLOOR_US).alias("epoch_like"),
        F.count_if(us > now_us + future_hours * HOUR_US).alias("future_ts"),
        F.count_if(F.col("value_num").isNull() & F.col("value_text").isNull()).alias("no_value"),
        F.count_if(F.col("reason") == "duplicate").alias("duplicate"),
        F.count_if(F.col("reason").isNull()).alias("clean"),
    )


def exclusion_reason(key: Column, rules: Sequence[tuple[str, str]] = V.EXCLUSIONS) -> Column:
    """Why a key may not be a feature; null if it may."""
    return first_match(key, rules)


def policy_reason(key: Column, allowed: Sequence[str] = V.ALLOWED_KEYS, denied: Sequence[tuple[str, str]] = V.EXCLUSIONS) -> Column:
    """Default deny: a denylist reason, null for allowed keys, else ``unreviewed``."""
    return F.coalesce(
        first_match(key, denied, "denylist:"), F.when(~key.isin(list(allowed)), "unreviewed:not_in_allowlist")
    )


def guard_columns(df: DataFrame, prohibited: Sequence[str] = V.PROHIBITED_OUTPUTS) -> DataFrame:
    """Return ``df``, or raise if one of its columns must not be output."""
    import re

    bad = [c for c in df.columns if any(re.search(p, c, re.IGNORECASE) for p in prohibited)]
    if bad:
        raise PolicyError(f"prohibited output columns: {bad}")
    return df


def decide_devices(
    devices: DataFrame,
    *,
    names: Sequence[str] = V.TEST_NAMES,
    types: Sequence[str] = V.TEST_TYPES,
    require_customer: bool = False,
    min_keys: int = 0,
    allow: Sequence[str] = (),
    deny: Sequence[str] = (),
) -> DataFrame:
    """Add keep and reason to devices (device_id, name, type, customer_id, key_count).

    A name alone never excludes a device; its type or a count of no keys must agree.
    """
    kind = F.lower(F.coalesce("type", F.lit("")))
    hit = first_match(F.coalesce("name", F.lit("")), [(p, p) for p in names])
    second = F.when(kind == "", "unknown-type").otherwise(kind)
    doubtful = second.contains("test") | second.contains("demo") | second.contains("sim")
    no = lambda reason: F.struct(F.lit(False).alias("keep"), reason.alias("reason"))
    yes = lambda reason: F.struct(F.lit(True).alias("keep"), reason.alias("reason"))
    decision = (
        F.when(F.col("device_id").isin(list(allow)), yes(F.lit("explicit_allow")))
        .when(F.col("device_id").isin(list(deny)), no(F.lit("explicit_deny")))
        .when(kind.isin(list(types)), no(F.concat(F.lit("test_type:"), kind)))
        .when(hit.isNotNull() & doubtful, no(F.concat(F.lit("name_pattern+type:"), hit, F.lit("+"), kind)))
        .when(hit.isNotNull() & (F.col("key_count") == 0), no(F.concat(F.lit("name_pattern+no_keys:"), hit)))
        .when(hit.isNotNull(), yes(F.concat(F.lit("name_pattern_only:"), hit, F.lit("|kept_pending_review"))))
        .when(F.lit(require_customer) & (F.coalesce("customer_id", F.lit("")) == ""), no(F.lit("no_customer")))
        .when(
            F.lit(min_keys > 0) & (F.coalesce("key_count", F.lit(0)) < min_keys), no(F.lit(f"inactive:min_keys={min_keys}"))
        )
        .otherwise(yes(F.lit("real_device")))
    )
    return devices.withColumn("_d", decision).select(*devices.columns, "_d.keep", "_d.reason")


def latest_ledger(ledger: DataFrame, identity: Sequence[str], order: str = "seq") -> DataFrame:
    """The last record of each request."""
    last = Window.partitionBy(*identity).orderBy(F.col(order).desc())
    return ledger.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")


def usable_pairs(ledger: DataFrame) -> DataFrame:
    """(device_id, key) with a complete latest record."""
    latest = latest_ledger(ledger, ["device_id", "key", "request"])
    return latest.where("completeness = 'complete'").select("device_id", "key").distinct()


def select_feature_keys(
    stats: DataFrame, *, watchlist: Sequence[str] = (), force_in: Sequence[str] = (), force_out: Sequence[str] = (),
    numeric_top: int = 25, text_top: int = 8,
) -> DataFrame:
    """Keys to build features from: kind by majority, watched keys first, then by volume and name.

    ``stats`` has key, n_rows, n_num and n_text.
    """
    eligible = stats.where(~F.col("key").isin(list(force_out))).where(
        F.col("key").isin(list(force_in)) | exclusion_reason(F.col("key")).isNull()
    )
    kind = F.when((F.col("n_num") >= F.col("n_text")) & (F.col("n_num") > 0), "numeric").when(F.col("n_text") > 0, "text")
    ranked = eligible.withColumn("kind", kind).where("kind IS NOT NULL")
    by = Window.partitionBy("kind").orderBy(F.col("key").isin(list(watchlist)).desc(), F.col("n_rows").desc(), F.col("key"))
    top = F.when(F.col("kind") == "numeric", numeric_top).otherwise(text_top)
    return ranked.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
