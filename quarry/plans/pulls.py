"""Queries that pull the synthetic readings through the paged source, with planted faults and stops."""

from __future__ import annotations

import contextlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import chain
from quarry.sources import paged, registry_pull, staged_series
from quarry.sources.tables import shape, table
from quarry.streaming import runs

from .features import NOW_US
from .registry import query

DAY_US = 86_400_000_000
BUCKETS = 16
#: Small pages, so that every pair needs several and times repeat at their borders.
LIMIT = 4


def _staged(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the readings as a paged service has them."""
    folder = runs.scratch(spark, "series")
    readings = shape(spark, sf_dir, "telemetry").select("device_id", "key", F.col("us").alias("ts"), F.col("value_num").alias("value"))
    staged_series.stage(readings, folder, BUCKETS)
    spark.dataSource.register(paged.SeriesSource)
    return folder


def _options(folder: str, start: int, end: int, faults: str = "") -> dict[str, str]:
    return {
        "client": "quarry.sources.staged_series:StagedSeries", "store": folder, "buckets": str(BUCKETS), "start": str(start), "end": str(end),
        "limit": str(LIMIT), "faults": faults, "base_s": "0.001",
    }


def _first_pair(spark: SparkSession, sf_dir: str) -> str:
    return shape(spark, sf_dir, "telemetry").agg(F.min(F.concat_ws("|", "device_id", "key")).alias("p")).first().p or ""


def _values(rows: DataFrame) -> DataFrame:
    return rows.select("device_id", "key", F.col("ts").alias("us"), F.col("value").cast("double").alias("value_num"))


@query("SELECT DISTINCT device_id, key, us, value_num FROM telemetry")
def fetch_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All points once, though pages are small, the first call for each pair is turned away and the token runs out."""
    found = spark.read.format("paged_series").options(**_options(_staged(spark, sf_dir), 0, 2 * NOW_US, "busy,expired")).load()
    return _values(found.where("ts IS NOT NULL"))


@query(f"""WITH first_pair AS (SELECT min(device_id || '|' || key) AS pair FROM telemetry),
  pairs AS (SELECT DISTINCT device_id, key, device_id || '|' || key = pair AS refused FROM telemetry CROSS JOIN first_pair),
  own AS (SELECT DISTINCT device_id, key, us, value_num FROM telemetry WHERE us BETWEEN {NOW_US - 15 * DAY_US} AND {NOW_US}),
  sums AS (SELECT p.device_id, p.key, refused, count(us) AS n, min(us) AS oldest, max(us) AS newest FROM pairs p LEFT JOIN own o ON NOT refused AND (o.device_id, o.key) = (p.device_id, p.key) GROUP BY ALL)
  SELECT device_id, key, CASE WHEN refused THEN 'failed' WHEN n = 0 THEN 'empty_verified' ELSE 'complete' END AS completeness,
    CASE WHEN refused THEN 'PermanentError: 403' END AS error, n AS n_rows, oldest AS oldest_us, newest AS newest_us FROM sums""")
def src_series_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of a pull of half the month: one pair is refused for good, which is a row and not the end."""
    faults = f"busy,refused={_first_pair(spark, sf_dir)}"
    found = spark.read.format("paged_series").options(**_options(_staged(spark, sf_dir), NOW_US - 15 * DAY_US, NOW_US, faults)).load()
    return found.groupBy("device_id", "key", "completeness", "error").agg(
        F.count("ts").alias("n_rows"), F.min("ts").alias("oldest_us"), F.max("ts").alias("newest_us")
    )


#: The ends of three windows. The second run stops half-way; the third takes it up, though a later window is asked for by then, and the fourth goes on.
ENDS = (NOW_US - 20 * DAY_US, NOW_US - 10 * DAY_US, 2 * NOW_US)


def _pulls(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The streams of the runs in order; the second fails at a pair."""
    folder = _staged(spark, sf_dir)
    down = f"down={_first_pair(spark, sf_dir)}"
    asked = [(ENDS[0], "busy"), (ENDS[1], down), (ENDS[2], ""), (ENDS[2], "")]
    return [spark.readStream.format("paged_series").options(**_options(folder, 0, end, faults)).load() for end, faults in asked]


@query("SELECT DISTINCT device_id, key, us, value_num FROM telemetry")
def stm_incremental_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point once, over four runs of which one stops half-way."""
    out, progress = runs.scratch(spark, "pulled"), runs.scratch(spark, "progress")
    for number, stream in enumerate(_pulls(spark, sf_dir)):
        with contextlib.suppress(StreamingQueryException) if number == 1 else contextlib.nullcontext():
            runs.carry_on(stream, out, progress)
    return _values(spark.read.parquet(out))


@query(f"""WITH d AS (SELECT DISTINCT device_id, key, us, value_num FROM telemetry)
  SELECT CASE WHEN us <= {ENDS[0]} THEN 0 WHEN us <= {ENDS[1]} THEN 1 ELSE 2 END AS batch, count(*) AS n_rows, count(DISTINCT device_id) AS n_devices, min(us) AS oldest_us, max(us) AS newest_us FROM d GROUP BY 1""")
def fetch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch held: the one that stopped kept its frozen window when it was taken up."""
    out, progress = runs.scratch(spark, "resumed"), runs.scratch(spark, "progress")

    def handle(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for number, stream in enumerate(_pulls(spark, sf_dir)):
        with contextlib.suppress(StreamingQueryException) if number == 1 else contextlib.nullcontext():
            runs.run_batches(stream, handle, progress)
    pulled = spark.read.schema("device_id string, key string, ts long, value string, completeness string, error string, batch int").parquet(out)
    return pulled.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("device_id").alias("n_devices"), F.min("ts").alias("oldest_us"), F.max("ts").alias("newest_us")
    )


def _listing(spark: SparkSession, sf_dir: str, kinds: dict[str, DataFrame], schema: str, **options: str) -> dict[str, DataFrame]:
    """Each kind's rows as a paged service lists them."""
    folder = runs.scratch(spark, "registry")
    spark.dataSource.register(registry_pull.RegistrySource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for kind, rows in kinds.items():
        registry_pull.stage(rows, folder, kind)
    common = {"client": "quarry.sources.registry_pull:SlicedRegistry", "store": folder, "page_size": "7", "partitions": "4", "base_s": "0.001", "faults": "busy"}
    return {kind: spark.read.format("paged_registry").schema(schema).options(**common, kind=kind, **options).load() for kind in kinds}


@query("""SELECT 'device' AS kind, device_id AS id, name, type, customer_id FROM devices
  UNION ALL SELECT 'customer', CAST(n_nationkey AS VARCHAR), n_name, NULL, NULL FROM nation
  UNION ALL SELECT 'asset', CAST(r_regionkey AS VARCHAR), r_name, 'region', NULL FROM region""")
def src_registry_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices, customers and assets, page after page, each entity once though first calls are turned away."""
    kinds = {
        "device": shape(spark, sf_dir, "devices").select(F.col("device_id").alias("id"), "name", "type", "customer_id"),
        "customer": table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")),
        "asset": table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"), F.lit("region").alias("type")),
    }
    listed = _listing(spark, sf_dir, kinds, "id string, name string, type string, customer_id string")
    whole = None
    for kind, rows in listed.items():
        own = rows.select(F.lit(kind).alias("kind"), "id", "name", "type", "customer_id")
        whole = own if whole is None else whole.unionByName(own)
    return whole


@query("SELECT device_id AS id, name, customer_id FROM devices WHERE type = 'gateway' AND customer_id = '3'")
def fetch_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gateways of one customer: the service searches by both columns, and four tasks share two hundred calls a second."""
    devices = shape(spark, sf_dir, "devices").select(F.col("device_id").alias("id"), "name", "type", "customer_id")
    listed = _listing(spark, sf_dir, {"device": devices}, "id string, name string, type string, customer_id string", calls_per_second="200")
    return listed["device"].where("type = 'gateway' AND customer_id = '3'").select("id", "name", "customer_id")


_PULLED = """registry AS (SELECT device_id FROM devices), keys AS (SELECT DISTINCT device_id, key FROM telemetry),
  series AS (SELECT DISTINCT device_id, key, us, value_num FROM telemetry), alarm_rows AS (SELECT * FROM alarms WHERE start_us IS NOT NULL)"""


def pull_steps(spark: SparkSession, sf_dir: str, faulty: bool = False) -> list[chain.Step]:
    """The steps of a full pull; with ``faulty`` the keys cannot be read, and what needs them is skipped."""
    def series(done: dict[str, DataFrame]) -> DataFrame:
        return _values(spark.read.format("paged_series").options(**_options(_staged(spark, sf_dir), 0, 2 * NOW_US, "busy")).load().where("ts IS NOT NULL"))

    def keys(done: dict[str, DataFrame]) -> DataFrame:
        found = shape(spark, sf_dir, "telemetry").select("device_id", "key").distinct()
        return found.where(F.raise_error(F.lit("keys service down")).isNull()) if faulty else found

    def events(done: dict[str, DataFrame]) -> DataFrame:
        return shape(spark, sf_dir, "evidence").join(done["registry"].select("device_id"), "device_id", "left_semi")

    return [
        chain.Step("registry", lambda done: shape(spark, sf_dir, "devices"), tolerated=False),
        chain.Step("keys", keys, ("registry",)), chain.Step("series", series, ("keys",)), chain.Step("events", events, ("registry",)),
        chain.Step("alarms", lambda done: shape(spark, sf_dir, "alarms").where("start_us IS NOT NULL"), ("registry",)),
    ]


@query(f"""WITH {_PULLED}, c(step, place, first_status, n_rows, attempt) AS (
    SELECT 'registry', 0, 'ok', count(*), 1 FROM registry UNION ALL SELECT 'keys', 1, 'failed', count(*), 2 FROM keys UNION ALL SELECT 'series', 2, 'skipped', count(*), 2 FROM series
    UNION ALL SELECT 'events', 3, 'ok', count(*), 1 FROM evidence WHERE device_id IN (SELECT device_id FROM registry) UNION ALL SELECT 'alarms', 4, 'ok', count(*), 1 FROM alarm_rows)
  SELECT step, place, first_status, 'ok' AS status, n_rows, attempt, 5 AS first_outcome, 0 AS outcome FROM c""")
def pull_orchestrator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of a pull in which one step fails, and of the rerun that does what was left."""
    path = runs.scratch(spark, "pull")
    first, _, manifest = chain.run(spark, pull_steps(spark, sf_dir, faulty=True), path)
    before = runs.written(manifest.select("step", F.col("status").alias("first_status")), "manifest")
    last, _, manifest = chain.run(spark, pull_steps(spark, sf_dir), path)
    both = manifest.drop("error").join(before, "step")
    return both.select("step", "place", "first_status", "status", "n_rows", "attempt", F.lit(int(first)).alias("first_outcome"), F.lit(int(last)).alias("outcome"))
