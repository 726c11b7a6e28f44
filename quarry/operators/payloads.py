"""Summaries of JSON payloads, and attribute tables made wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import first_value, is_offline_word, number, state_of

#: Words of storage cards and health fields that mean a fault.
BAD_CARD = ["error", "fault", "full", "missing", "bad", "offline", "0", "false"]
UNHEALTHY = ["unhealthy", "not healthy", "fault", "error", "down"]
RECORDER_OFF = ["dahuanvr_off", "dahuanvr_offline", "offline", "off"]
NO_BYTES = ["na", "n/a", "", "none"]
ZONE_EVENTS = ["triggered", "alarm", "fault"]
USAGE_KEYS = ["usage", "usage_mb", "data_mb", "total", "value", "Usage"]
#: The scopes of attributes, the first that has a key wins.
SCOPES = ["SERVER_SCOPE", "CLIENT_SCOPE", "SHARED_SCOPE"]


def _word(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def _count(rows: Column, when) -> Column:  # noqa: ANN001
    return F.coalesce(F.size(F.filter(rows, when)), F.lit(0)).cast("int")


def storage_cards(payload: Column) -> Column:
    """Number of cards, of bad ones, and their free and used GB; one object counts as a list of one."""
    cards = F.filter(
        F.from_json(payload, "array<struct<sd_status: string, free_space: string, used_space: string>>"), lambda c: c.isNotNull()
    )
    total = lambda field: F.aggregate(
        F.coalesce(cards, F.array().cast("array<struct<sd_status: string, free_space: string, used_space: string>>")),
        F.lit(0.0), lambda a, c: a + F.coalesce(number(c[field]), F.lit(0.0)) / 1024,
    )
    return F.struct(
        _count(cards, lambda c: F.lit(True)).alias("n_cards"), _count(cards, lambda c: _word(c["sd_status"]).isin(BAD_CARD)).alias("n_bad"),
        total("free_space").alias("free_gb"), total("used_space").alias("used_gb"),
    )


def rock_summary(payload: Column) -> Column:
    """Health word, flags for ill health and an absent recorder, cameras, and cameras without a card."""
    card = "array<struct<TotalBytes: string>>"
    p = F.from_json(payload, f"struct<healthyStatus: string, DahuaNVR_Heartbeat: string, SdCardINFO: {card}, HddINFO: {card}>")
    cards = F.when(F.size(p["SdCardINFO"]) > 0, p["SdCardINFO"]).otherwise(p["HddINFO"])
    return F.struct(
        _word(p["healthyStatus"]).alias("health"), _word(p["healthyStatus"]).isin(UNHEALTHY).cast("int").alias("unhealthy"),
        _word(p["DahuaNVR_Heartbeat"]).isin(RECORDER_OFF).cast("int").alias("recorder_off"),
        _count(cards, lambda c: c.isNotNull()).alias("n_cameras"),
        _count(cards, lambda c: c.isNotNull() & _word(c["TotalBytes"]).isin(NO_BYTES)).alias("n_without_card"),
    )


def bas_summary(payload: Column) -> Column:
    """Heartbeat, panel state, power states, and the number of zones with an event."""
    p = F.from_json(
        payload,
        "struct<basMainInfo: struct<heartbeat: string, panelState: string>, basPowerStatus: struct<mainStatus: string, batteryStatus: string>, "
        "zoneInfo: array<struct<zoneEvent: string>>>",
    )
    text = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return F.struct(
        text(p["basMainInfo"]["heartbeat"]).alias("heartbeat"), text(p["basMainInfo"]["panelState"]).alias("panel_state"),
        text(p["basPowerStatus"]["mainStatus"]).alias("main_status"), text(p["basPowerStatus"]["batteryStatus"]).alias("battery_status"),
        _count(p["zoneInfo"], lambda z: _word(z["zoneEvent"]).isin(ZONE_EVENTS)).alias("n_zone_events"),
    )


def latest_usage(payload: Column) -> Column:
    """The usage of the last entry of a list, of an object, or the number itself; null if none is there."""
    last = F.try_element_at(F.from_json(payload, "array<map<string, string>>"), F.lit(-1))
    entry = F.coalesce(last, F.from_json(F.when(F.trim(payload).startswith("{"), payload), "map<string, string>"))
    named = F.coalesce(*(number(F.try_element_at(entry, F.lit(k))) for k in USAGE_KEYS))
    any_ = F.get(F.filter(F.transform(F.map_values(entry), number), lambda v: v.isNotNull()), F.lit(0))
    plain = number(F.try_element_at(F.from_json(payload, "array<string>"), F.lit(-1)))
    listed = F.trim(payload).startswith("[")
    return F.when(listed, F.coalesce(named, any_, plain)).otherwise(F.coalesce(number(payload), named))


def merged_attributes(attributes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per device with the named keys; of several scopes the first in SCOPES that has the key."""
    place = F.array_position(F.array(*map(F.lit, SCOPES)), F.col("scope"))
    best = Window.partitionBy("device_id", "key").orderBy(F.when(place > 0, place).otherwise(len(SCOPES) + 1), F.col("last_update_us").desc())
    wanted = attributes.where(F.col("key").isin(list(keys)) & F.col("value").isNotNull())
    chosen = wanted.withColumn("_rn", F.row_number().over(best)).where("_rn = 1")
    return chosen.groupBy("device_id").agg(*(F.max(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys))


def current_outage(wide: DataFrame) -> DataFrame:
    """A low-confidence open outage for devices whose attributes say they are offline now.

    ``wide`` has device_id, active, status and four times in microseconds, of which the
    first that is known is the start; without one there is no outage.
    """
    down = (state_of(F.coalesce("active", F.lit(""))) == "offline") | (state_of(F.coalesce("status", F.lit(""))) == "offline")
    start = F.coalesce("inactive_since", "last_disconnect", "inactivity_alarm", "last_activity")
    return wide.where(down & start.isNotNull()).select("device_id", start.alias("outage_start"), F.lit("low").alias("confidence"))


def device_state(wide: DataFrame) -> DataFrame:
    """device_id, status as first told by any of its sources, and whether the device is offline."""
    status = first_value(F.col("status"), F.col("state"), F.col("active"))
    return wide.select("device_id", status.alias("status"), is_offline_word(status).alias("is_offline"))
