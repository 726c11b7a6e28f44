"""Transparent rule scores: ladders of conditions, each with points and a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import scalars as S


@dataclass(frozen=True)
class Step:
    """If ``when`` holds (and no step before it on its ladder), add ``points`` and say ``reason``."""

    when: Column
    points: Column | float
    reason: Column | str


Ladder = Sequence[Step]


def score(rows: DataFrame, ladders: Sequence[Ladder], *, reasons: int = 5) -> DataFrame:
    """Add score (capped at 100), severity and the first few reasons, ``OK`` if there are none."""
    parts = []
    for ladder in ladders:
        found = F.lit(None).cast("struct<points: double, reason: string>")
        for step in reversed(ladder):
            points = step.points if isinstance(step.points, Column) else F.lit(step.points)
            reason = step.reason if isinstance(step.reason, Column) else F.lit(step.reason)
            hit = F.struct(points.cast("double").alias("points"), reason.alias("reason"))
            found = F.when(F.coalesce(step.when, F.lit(False)), hit).otherwise(found)
        parts.append(found)
    hits = rows.withColumn("_hits", F.array_compact(F.array(*parts)))
    total = F.round(F.least(F.lit(100.0), F.aggregate("_hits", F.lit(0.0), lambda a, h: a + h["points"])), 2)
    said = F.array_join(F.transform(F.slice("_hits", 1, reasons), lambda h: h["reason"]), " | ")
    return hits.select(
        *rows.columns, total.alias("score"), S.severity(total).alias("severity"), F.when(said == "", "OK").otherwise(said).alias("reasons")
    )


def with_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with every named column; those that are absent are null."""
    return rows.select("*", *(F.lit(None).cast("string").alias(n) for n in names if n not in rows.columns))


def _per_unit(n: Column, each: int, most: int, label: str) -> Ladder:
    points = F.least(n * each, F.lit(most)).cast("int")
    return [Step(n > 0, points, F.concat(F.lit(f"{label}="), n.cast("string"), F.lit("(+"), points.cast("string"), F.lit(")")))]


def _whole(v: Column) -> Column:
    return F.bround(v, 0).cast("long").cast("string")


#: Fixed values: (column, points, label) of rules that fire on one word.
DAILY_FALSE = [("statusbox_system_on", 35, "SYS_OFF"), ("statusbox_system_healthy", 25, "SYS_UNHEALTHY"), ("statusbox_mains_on", 20, "MAINS_OFF")]
DAILY_TRUE = [("statusbox_battery_low", 15, "BATT_LOW"), ("statusbox_battery_reverse", 10, "BATT_REVERSE"), ("statusbox_sos_status", 20, "SOS_ACTIVE")]
DAILY_OFFLINE = [
    ("heartbeat_BAS", 15), ("heartbeat_FAS", 15), ("heartbeat_CCTV", 12), ("heartbeat_IBAS", 12), ("heartbeat_access_control", 12),
    ("heartbeat_time_lock", 10), ("heartBeatBAS", 8), ("heartBeatFAS", 8), ("heartBeatCCTV", 6), ("heartBeatTL", 6),
]
DAILY_FLAGS = [("heartbeat_flat_offline", 15, "HB_FLAT_OFFLINE"), ("rock_unhealthy", 20, "ROCK_UNHEALTHY"), ("rock_nvr_offline", 12, "ROCK_NVR_OFFLINE")]
DAILY_FAULTS = [
    ("nvr_status_snapshot", 30, "NVR_FAULT"), ("hdd_status_snapshot", 30, "HDD_FAULT"), ("fas_status_snapshot", 20, "FAS_FAULT"),
    ("ias_status_snapshot", 15, "IAS_FAULT"), ("bas_status_snapshot", 12, "BAS_FAULT"), ("acs_status_snapshot", 15, "ACS_FAULT"),
    ("tls_status_snapshot", 10, "TLS_FAULT"), ("gw_status_snapshot", 15, "GW_FAULT"), ("cctv_status_snapshot", 10, "CCTV_FAULT"),
    ("integrated_status_snapshot", 15, "INT_FAULT"),
]
DAILY_COUNTS = [
    ("BASfaultCOUNT", "BAS_F", 3, 12), ("FASfaultCOUNT", "FAS_F", 3, 12), ("IASfaultCOUNT", "IAS_F", 3, 12),
    ("camera_disconnect_count", "CAM_DC", 3, 20), ("camera_tampered_count", "CAM_TAMP", 3, 15), ("hdd_error_count", "HDD_ERR", 5, 20),
]
DAILY_OTHERS = [
    "rock_sd_na_count", "rock_cam_count", "bas_hb", "bas_panel_state", "bas_main_status", "bas_battery_status", "bas_zone_triggered",
    "battery_voltage", "ac_voltage", "log_fault_count", "hik_sd_bad_count", "dahua_sd_bad_count", "cpplus_sd_bad_count",
    "BAS_Downtime_Minutes", "Total_Data_Usage_num", "disk", "cpu", "memory", "temperature", "sw_state",
]


def daily_ladders() -> list[Ladder]:
    """Rules for a device and day. A missing value never scores: missing is not faulty."""
    number = lambda c: S.number(F.col(c).cast("string"))
    whole = lambda c: F.coalesce(number(c).cast("long"), F.lit(0).cast("long"))
    one = lambda when, points, label: [Step(when, points, f"{label}(+{points})")]
    word = lambda c: F.lower(F.trim(F.col(c).cast("string")))
    out = [one(S.says_false(F.col(c)), p, label) for c, p, label in DAILY_FALSE]
    out += [one(S.says_true(F.col(c)), p, label) for c, p, label in DAILY_TRUE]
    out += [one(S.is_offline_word(F.col(c)), p, f"{c}_OFFLINE") for c, p in DAILY_OFFLINE]
    out += [one(whole(c) != 0, p, label) for c, p, label in DAILY_FLAGS]
    na, cams = whole("rock_sd_na_count"), whole("rock_cam_count")
    all_na = F.concat(F.lit("ROCK_SD_ALL_NA("), na.cast("string"), F.lit("/"), cams.cast("string"), F.lit(")(+10)"))
    out.append([Step((cams > 0) & (na == cams), 10, all_na), *_per_unit(na, 3, 9, "ROCK_SD_NA")])
    hb, panel = word("bas_hb"), word("bas_panel_state")
    out.append([Step(S.is_offline_word(F.col("bas_hb")), 12, F.concat(F.lit("BAS_HB_"), F.upper(hb), F.lit("(+12)")))])
    calm = panel.isin("armed", "disarmed", "normal", "stay", "ok")
    out.append([Step(~S.is_missing(F.col("bas_panel_state")) & ~calm, 8, F.concat(F.lit("BAS_PANEL_"), F.upper(panel), F.lit("(+8)")))])
    out.append(one(word("bas_main_status").isin("off", "offline", "down", "fault", "error"), 15, "BAS_MAIN_OFF"))
    out.append(one(word("bas_battery_status").isin("low", "fault", "reverse", "bad"), 10, "BAS_BATT_BAD"))
    out.append(_per_unit(whole("bas_zone_triggered"), 5, 15, "BAS_ZONE_TRIG"))
    bv, av = number("battery_voltage"), number("ac_voltage")
    volts = lambda label, p: F.concat(F.lit(label + "("), F.format_string("%.1f", bv), F.lit(f"V)(+{p})"))
    out.append([Step((bv > 0) & (bv < 11), 15, volts("BATT_V_CRIT", 15)), Step((bv >= 11) & (bv < 12), 8, volts("BATT_V_WARN", 8))])
    out.append([Step((av > 0) & (av < 180), 10, F.concat(F.lit("AC_V_LOW("), _whole(av), F.lit("V)(+10)")))])
    fe = whole("log_fault_count")
    events = lambda p: F.concat(F.lit("FAULT_EVT="), fe.cast("string"), F.lit(f"(+{p})"))
    out.append([Step(fe >= 20, 20, events(20)), Step(fe >= 10, 12, events(12)), Step(fe >= 3, 6, events(6))])
    out.append(_per_unit(whole("hik_sd_bad_count") + whole("dahua_sd_bad_count") + whole("cpplus_sd_bad_count"), 5, 15, "SD_BAD"))
    out += [one(S.is_fault_word(F.col(c)), p, label) for c, p, label in DAILY_FAULTS]
    bd = number("BAS_Downtime_Minutes")
    down = lambda p: F.concat(F.lit("BAS_DT_"), _whole(bd), F.lit(f"m(+{p})"))
    out.append([Step(bd >= 1440, 30, down(30)), Step(bd >= 480, 20, down(20)), Step(bd >= 60, 10, down(10))])
    out.append(one(number("Total_Data_Usage_num") == 0, 20, "ZERO_DATA"))
    said = lambda label, v, unit: F.concat(F.lit(label + "("), _whole(v), F.lit(unit + ")"))
    cpu, disk, memory, heat = (number(c) for c in ("cpu", "disk", "memory", "temperature"))
    out.append([Step(cpu >= 90, 10, said("CPU_HIGH", cpu, "%"))])
    out.append([Step(disk >= 90, 20, said("DISK_CRIT", disk, "%")), Step(disk >= 80, 12, said("DISK_HIGH", disk, "%")), Step(disk >= 75, 6, said("DISK_WARN", disk, "%"))])
    out.append([Step(memory >= 90, 10, said("MEM_HIGH", memory, "%"))])
    out.append([Step(heat >= 70, 12, said("TEMP_CRIT", heat, "°")), Step(heat >= 60, 6, said("TEMP_WARN", heat, "°"))])
    out += [_per_unit(whole(c), each, most, label) for c, label, each, most in DAILY_COUNTS]
    out.append(one(F.upper(F.col("sw_state").cast("string")).isin("FAILED", "FAILED_UPDATE", "ERROR"), 10, "FW_FAIL"))
    return out


def score_daily(rows: DataFrame) -> DataFrame:
    """Score rows of the daily grid; columns that the grid lacks count as missing."""
    names = [r[0] for r in (*DAILY_FALSE, *DAILY_TRUE, *DAILY_OFFLINE, *DAILY_FLAGS, *DAILY_FAULTS, *DAILY_COUNTS)] + DAILY_OTHERS
    return score(with_columns(rows, names), daily_ladders()).select(*rows.columns, "score", "severity", "reasons")


AUDIT_COLUMNS = [
    "gap_days", "bas_downtime_min", "total_data_mb", "inactive_since", "nvr_status", "flag_dvr_off", "hdd_status", "flag_hdd_error",
    "flag_power_off", "gw_status", "camera_disconnects", "flag_camera_disconnect", "fas_status", "flag_fas_off", "flag_fas_fault",
    "ias_status", "flag_ias_off", "integrated_status", "flag_integrated_off", "acs_status", "bas_status", "tls_status", "flag_tls_off",
    "flag_battery_low", "flag_battery_reverse", "fw_state", "disk", "cpu",
]


def audit_ladders() -> list[Ladder]:
    """Rules for a device's state at audit time; here a missing data volume counts as none.

    The points, thresholds and labels are fixed values.
    """
    number = lambda c: F.coalesce(S.number(F.col(c).cast("string")), F.lit(0.0))
    flag = lambda c: ~F.coalesce(F.lower(F.col(c).cast("string")).isin("false", "0", "", "null"), F.lit(True))
    fault = lambda c: S.is_audit_fault(F.col(c))
    step = lambda when, points, label: Step(when, points, f"{label}(+{points})")
    gap, down, disk, cams = number("gap_days"), number("bas_downtime_min"), number("disk"), number("camera_disconnects")
    cam_points = F.least(cams * 5, F.lit(25.0))
    said = F.concat(F.lit("CAM_DC="), _whole(cams), F.lit("(+"), _whole(cam_points), F.lit(")"))
    percent = lambda label, v: F.concat(F.lit(label + "("), _whole(v), F.lit("%)"))
    return [
        [step(gap >= d, p, f"GAP_{d}D") for d, p in ((90, 50), (30, 40), (7, 25), (3, 12))],
        [step(down >= m, p, f"BAS_DT_{m}M") for m, p in ((1440, 30), (480, 20), (60, 10))],
        [step(number("total_data_mb") == 0, 15, "ZERO_DATA")],
        [step(S.first_value(F.col("inactive_since")).isNotNull(), 20, "INACTIVE")],
        [step(fault("nvr_status"), 30, "NVR_FAULT"), step(flag("flag_dvr_off"), 28, "DVR_OFF")],
        [step(fault("hdd_status"), 30, "HDD_FAULT"), step(flag("flag_hdd_error"), 25, "HDD_ERROR")],
        [step(flag("flag_power_off"), 20, "POWER_OFF"), step(fault("gw_status"), 15, "GW_FAULT")],
        [Step(cams > 0, cam_points, said), step(flag("flag_camera_disconnect"), 15, "CAM_DISCONNECT")],
        [step(fault("fas_status"), 20, "FAS_FAULT"), step(flag("flag_fas_off"), 20, "FAS_OFF"), step(flag("flag_fas_fault"), 18, "FAS_FLAG")],
        [step(fault("ias_status") | flag("flag_ias_off"), 15, "IAS_FAULT")],
        [step(fault("integrated_status"), 15, "INT_FAULT"), step(flag("flag_integrated_off"), 15, "INT_OFF")],
        [step(fault("acs_status"), 15, "ACS_FAULT")],
        [step(fault("bas_status"), 12, "BAS_FAULT")],
        [step(fault("tls_status") | flag("flag_tls_off"), 10, "TLS_FAULT")],
        [step(flag("flag_battery_low"), 10, "BATT_LOW")],
        [step(flag("flag_battery_reverse"), 8, "BATT_REVERSE")],
        [step(F.upper(F.col("fw_state").cast("string")).isin("FAILED", "FAILED_UPDATE", "ERROR"), 10, "FW_FAIL")],
        [Step(disk >= 90, 20, percent("DISK_CRIT", disk)), Step(disk >= 80, 15, percent("DISK_HIGH", disk)), Step(disk >= 75, 8, percent("DISK_WARN", disk))],
        [Step(number("cpu") >= 90, 10, percent("CPU_HIGH", number("cpu")))],
    ]


def score_audit(rows: DataFrame) -> DataFrame:
    return score(with_columns(rows, AUDIT_COLUMNS), audit_ladders(), reasons=6).select(*rows.columns, "score", "severity", "reasons")
