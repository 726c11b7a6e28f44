"""Analytics over fleet telemetry, declared as Spark plans."""
