"""Word lists, patterns and thresholds that results depend on."""

from __future__ import annotations

#: Strings that mean "no value"; never a fault.
MISSING = ["", "none", "null", "nan", "n/a", "na", "unknown", "undefined", "-"]
#: Fault words of snapshots; the audit's list also has N/A.
FAULT = ["OFFLINE", "OFF", "FAULT", "ERROR", "INACTIVE", "DISCONNECTED", "DOWN", "FAILED", "FAILED_UPDATE", "BAD", "FALSE", "0"]
AUDIT_FAULT = ["OFFLINE", "OFF", "FAULT", "ERROR", "INACTIVE", "DISCONNECTED", "DOWN", "FAILED", "0", "FALSE", "N/A", "FAILED_UPDATE"]
OFFLINE = ["offline", "off", "down", "disconnected", "0", "false"]
FALSE_WORDS = ["false", "0", "no", "off"]
TRUE_WORDS = ["true", "1", "yes", "on", "active"]

#: State words, and patterns for longer texts.
OFFLINE_STATES = ["false", "0", "off", "offline", "inactive", "disconnected", "disconnect", "down", "no_data", "no data"]
ONLINE_STATES = ["true", "1", "on", "online", "active", "connected", "connect", "up", "healthy"]
OFFLINE_TEXT = r"(?i)\b(disconnect(?:ed)?|offline|inactive|inactivity|no[_ -]?data|heartbeat[_ -]?stop|down)\b"
ONLINE_TEXT = r"(?i)\b(connect(?:ed)?|online|active|activity|up)\b"
#: Texts that speak of a device out of reach, and texts that are a number.
BAD_TEXT = r"(?i)offline|no[_ -]?data|inactiv|disconnect|heartbeat[_ -]?stop|down|not responding"
NUMBER_TEXT = r"^\s*-?\d+(\.\d+)?\s*$"
CAMERA_CHANNEL = r"(?i)^(BOI-\s*)?CAMERA\s+(TAMPER|DISCONNECT)"

#: Keys that must not become features; the first match gives the reason.
EXCLUSIONS = [
    (r"(^|_)(device|tenant|customer|branch|org|gateway|node|site)_?id$", "identifier"),
    (r"(^|_)(device|branch|zone|customer|nbg|zo|ro|ho|co)_?name$", "identifier"),
    (r"title|formatted", "identifier"),
    (r"imei|iccid|mac_?address|serial|hostname|ip_address|^ip$|tailscale", "network_identifier"),
    (r"password|passwd|secret|token|api_?key|credential|private_?key|webhook|slack", "secret"),
    (r"latitude|longitude|^lat$|^lon$|arrlat|arrlon|^gps|_gps|geo", "gps_location"),
    (r"payload|raw|dexter_config|dexter_date|camerainfo|hddis|sd_card_info|sdinfo|integration|^rock$", "raw_payload"),
    (r"fault_?score|health_?score|risk|prognosis|prediction|anomaly|_score$|^score", "rule_derived_score"),
    (r"severity|critical|major|warning|alarm|^active$|active_state|notification", "alert_or_severity"),
    (
        r"lastconnect|lastdisconnect|lastactivity|inactiv|offline|outage|^y_|^label|^target|downtime|panelstate|triggered|tamper|heartbeat",
        "target_like_or_label_proxy",
    ),
    (r"status|systemhealth|provisionstate|subsystem|^health", "derived_status_flag"),
    (r"usage_history|history|_res$|^res$", "history_or_result_blob"),
]
#: Keys that may become features without review.
ALLOWED_KEYS = [
    "temperature", "disk", "cpu", "memory", "net_sent_mb", "net_recv_mb", "battery_voltage", "system_current", "ac_voltage",
    "frequency", "usage_daily", "usage_last_7_days", "usage_last_15_days", "Total_Data_Usage", "rpi_usage", "cavlidata_ontime",
    "errorCount", "cctvUptime", "basUptime", "gatewayUptime", "uptimeTotal", "BAS_Uptime_Minutes", "iasLastHour",
    "cctvLastHour", "basLastHour", "fasLastHour", "gatewayLastHour", "accessControlLastHour", "timeLockLastHour",
]
#: Columns that no output may have.
PROHIBITED_OUTPUTS = [
    "fault.?score", "severity", "critical", "major", "warning", "alarm", "label", "target", "^y_", "risk", "prognosis",
    "prediction", "anomaly", "imei", "mac", "serial", "latitude", "longitude", "password", "secret", "token", "payload",
    "heartbeat", "offline", "outage", "^active$", "status$",
]
#: Names and types of devices that are not in service.
TEST_NAMES = ["test", "demo", "simul", "synth", r"\blab\b", r"\bqa\b", "staging", "staging-", "dummy", "sample"]
TEST_TYPES = ["test", "demo", "simulator", "synthetic"]
#: How much an evidence type proves.
EVIDENCE_STRENGTH = {
    "lc_disconnect": "strong", "lc_connect": "strong", "alarm_offline": "strong", "alarm_cleared": "strong",
    "alarm_channel": "weak", "error_event": "weak", "current_attr_snapshot": "weak", "unknown": "none",
}
LIFECYCLE_OFFLINE = ["ondisconnect", "disconnect", "inactive", "offline"]
LIFECYCLE_ONLINE = ["onconnect", "connect", "onactivity", "activity"]
ALARM_OFFLINE_TEXT = r"(?i)off|disconnect|fault|low battery|power fail|activated"
ALARM_ONLINE_TEXT = r"(?i)cleared|restored|reconnect"
#: Score limits of severities, and probability limits of tiers.
SEVERITIES = [(70, "CRITICAL"), (45, "HIGH"), (20, "MEDIUM")]
TIERS = [(0.50, "CRITICAL"), (0.40, "HIGH"), (0.25, "MEDIUM")]
COVERED_STATUSES = ["ok", "complete", "success", "empty_verified"]
#: How an exported output text names its class, score and reasons.
FAULT_CLASS = r"(?i)fault_class\s*:\s*([A-Za-z]+)"
FAULT_SCORE = r"(?i)fault_score\s*:\s*([0-9]+(?:\.[0-9]+)?)"
FAULT_REASONS = r"(?is)reasons\s*:\s*(.+)$"
