"""All named queries and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import trailing
from quarry.sources.tables import shape

from . import exchange, features, fleet, labels, registry, streams, devices, sinks, dataset, pulls  # noqa: F401, I001


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leak-checked point-in-time features of quarantined telemetry."""
    from quarry.operators.quality import quarantine

    clean = quarantine(shape(spark, sf_dir, "raw_telemetry"), features.NOW_US).where("reason IS NULL")
    wide = features.device_features(clean, features.KEYS)
    return trailing.require_no_leakage(wide, source="max_source_us")


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
