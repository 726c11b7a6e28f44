"""Levels of an organisation by asset type or name, and nested trees for dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.scalars import first_match
from quarry.streaming import runs

#: Name patterns of levels, the first match wins.
NAME_LEVELS = [
    (r"\bLHO\b|Local\s+Head\s+Office", "lho"), (r"\bRBO\b|Regional\s+Banking", "rbo"), (r"\bNBG\b|\bFGMO\b", "nbg"),
    (r"\bZO\b|\bZONE\b|Zonal\s+Office", "zo"), (r"\bRO\b|Regional\s+Office", "ro"), (r"\bCO\b|Circle\s+Office", "co"),
    (r"\bHO\b|Head\s+Office|Corporate\s+Office|Central\s+Office", "ho"),
]


def level_of_name(name: Column) -> Column:
    return first_match(name, NAME_LEVELS)


def asset_levels(assets: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add level to assets (bank, asset_type) by a table (org, asset_type, level, priority).

    A row for the asset's own organisation wins over a general one (org null), and a
    general type that is only part of the asset's type comes last; ``_ignore`` never
    matches in part. Types without a match are ``other``.
    """
    own = mapping.where("org IS NOT NULL").select("org", F.col("asset_type").alias("_t1"), F.col("level").alias("_own"), F.col("priority").alias("_first"))
    # a bank may match several organisations: one level a bank and type, of the least priority
    named = (F.col("asset_type") == F.col("_t1")) & F.contains(F.lower("bank"), F.lower("org"))
    own = assets.select("bank", "asset_type").distinct().join(own, named).groupBy("bank", "asset_type").agg(F.min_by("_own", "_first").alias("_own"))
    general = mapping.where("org IS NULL").select(F.col("asset_type").alias("_t2"), F.col("level").alias("_general"))
    # the mapping is a list of type names kept with the code; partial matches are tried on distinct types only
    types = assets.select("asset_type").distinct()
    inside = F.contains(F.lower("asset_type"), F.lower("_t3")) & (F.col("_partial") != "_ignore")
    parts = mapping.where("org IS NULL").select(F.col("asset_type").alias("_t3"), F.col("level").alias("_partial"), "priority")
    partial = types.join(parts, inside).groupBy("asset_type").agg(F.min_by("_partial", "priority").alias("_partial"))
    found = assets.join(own, ["bank", "asset_type"], "left")
    found = found.join(general, F.col("asset_type") == F.col("_t2"), "left").join(partial, "asset_type", "left")
    return found.select(*assets.columns, F.coalesce("_own", "_general", "_partial", F.lit("other")).alias("level"))


def tree(devices: DataFrame, levels: Sequence[str]) -> DataFrame:
    """One row per top node: its summary and nested children, down to the lowest level.

    A node holds its children's summaries, not its devices, so its size is that of
    the organisation below it.
    """
    summary = F.struct("n_devices", "total_score", "n_critical")
    nodes = devices.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("n_devices"), F.sum("score").alias("total_score"), F.count_if(F.col("severity") == "CRITICAL").alias("n_critical")
    )
    child: Column | None = None
    for depth in range(len(levels), 0, -1):
        name = F.col(levels[depth - 1]).alias("name")
        fields = [name, summary.alias("summary")] + ([F.col("children")] if child is not None else [])
        node = nodes.withColumn("node", F.struct(*fields))
        if depth == 1:
            return node.select(F.col(levels[0]), "node")
        sums = [F.sum(c).alias(c) for c in ("n_devices", "total_score", "n_critical")]
        nodes = node.groupBy(*levels[: depth - 1]).agg(*sums, F.sort_array(F.collect_list("node")).alias("children"))
        child = F.col("children")
    raise ValueError("a tree needs a level")


def level_summaries(devices: DataFrame, levels: dict[str, list[str]], *, gap_fault_days: int, present: dict[str, Column], fault: Column) -> DataFrame:
    """The aggregates of every level in one pass: scores, severities, gaps, volumes and downtimes.

    ``levels`` name the columns of a level, no two the same; ``present`` gives columns whose
    filled values are counted. A null in a level's own columns is a group; other columns of the levels are null.
    """
    columns = list(dict.fromkeys(c for cs in levels.values() for c in cs))
    held = F.grouping_id(*columns)
    number = {name: sum(0 if c in cs else 1 << (len(columns) - 1 - i) for i, c in enumerate(columns)) for name, cs in levels.items()}
    level = F.coalesce(*(F.when(held == n, F.lit(name)) for name, n in number.items()))
    hours = lambda c: F.round(F.sum(c) / 60, 1).alias(c.replace("_downtime_min", "_down_hrs"))
    return devices.groupingSets(list(levels.values()), *columns).agg(
        level.alias("level"), F.count(F.lit(1)).alias("n_devices"), F.round(F.avg("score"), 1).alias("avg_score"), F.max("score").alias("max_score"),
        *(F.count_if(F.col("severity") == s).alias(f"n_{s.lower()}") for s in ("CRITICAL", "HIGH", "MEDIUM", "HEALTHY")),
        F.count_if(F.col("gap_days") >= gap_fault_days).alias("gap_devices"), F.max("gap_days").alias("max_gap_days"), F.sum("total_data_mb").alias("total_data_mb"),
        *(hours(f"{k}_downtime_min") for k in ("bas", "nvr", "fas", "ias")), F.sum("camera_disconnects").alias("cam_dc_total"),
        *(F.count_if(F.coalesce(c, F.lit("")) != "").alias(n) for n, c in present.items()), F.count_if(fault).alias("integrated_faults"),
    )


#: The order of levels in a full path.
PATH_LEVELS = ("bank_name", "ho_name", "nbg_name", "lho_name", "zo_name", "ro_name", "co_name", "rbo_name", "branch_name")
#: Parents that a walk goes through: a device's own are the first.
MOST_DEPTH = 8
_NO_FIELDS = "map<string,string>"


def _first_fields(hits: DataFrame, by: str) -> DataFrame:
    """(by, field, path, value): of each field the value on the path that comes first; an empty value counts."""
    named = hits.select(by, "path", F.explode("fields").alias("field", "value"))
    return named.groupBy(by, "field").agg(F.min_by(F.struct("path", "value"), "path").alias("first")).select(by, "field", "first.*")


def resolve_upwards(relations: DataFrame, entities: DataFrame, starts: DataFrame, *, depth: int = MOST_DEPTH - 1) -> DataFrame:
    """(node, fields): what each of ``starts`` (column node) gets from the entities above it.

    ``relations`` (child, parent, ord) name the parents of a node in order, ``entities`` (id,
    ``expands``, fields) what a parent gives; parents that are no entities are passed over,
    and those that do not expand have nothing above them. The walk goes depth first: a
    field has the value of the first entity that names it, parent by parent, each before
    what is above it.

    Frontiers are joined level by level. A node comes up again only on a path that is first
    in order among those no longer than itself: on a later one, or round a cycle, all it
    and its parents name is named already. So a frontier has a row at most for each
    start and node, and each is written to cut the lineage.
    """
    spark = relations.sparkSession
    order = Window.partitionBy("child").orderBy("ord", "parent")
    edges = relations.where("child <> parent").select("child", "parent", F.row_number().over(order).alias("_at"))
    known = entities.select(F.col("id").alias("parent"), "expands", F.col("fields").cast(_NO_FIELDS).alias("fields"))
    steps = runs.written(edges.join(known, "parent"), "walk-steps")
    frontier = starts.select("node", F.col("node").alias("at"), F.array().cast("array<int>").alias("path")).distinct()
    seen, best = None, None
    for _ in range(depth):
        reached = frontier.join(steps, frontier["at"] == steps["child"]).select(
            "node", F.col("parent").alias("at"), F.concat("path", F.array("_at")).alias("path"), "expands", "fields"
        ).where("node <> at")
        reached = reached.groupBy("node", "at").agg(F.min_by(F.struct("path", "expands", "fields"), "path").alias("r")).select("node", "at", "r.*")
        if best is not None:
            before = best.groupBy("node", "at").agg(F.min("path").alias("_before"))
            reached = reached.join(before, ["node", "at"], "left").where(F.col("_before").isNull() | (F.col("path") < F.col("_before"))).drop("_before")
        reached = runs.written(reached, "walk-level")
        if reached.isEmpty():
            break
        seen = reached if seen is None else seen.unionByName(reached)
        best = seen.select("node", "at", "path")
        frontier = reached.where("expands").select("node", "at", "path")
    if seen is None:
        return spark.createDataFrame([], "node string, fields map<string,string>")
    first = _first_fields(seen.select("node", "path", "fields"), "node")
    return first.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("fields"))


def merge_hierarchy(devices: DataFrame, relations: DataFrame, entities: DataFrame, customers: DataFrame) -> DataFrame:
    """Add fields, full_path and hierarchy_depth to devices (device_id, customer_id, fields).

    A device's own fields come first. One without a branch or a bank group takes its empty fields
    from a walk over its relations, where an empty value of an entity that comes first hides
    later ones. If the bank group is empty still, group and bank are those of the device's
    customer (customer_id, bank_name, nbg_name). The path names the filled levels from the top.
    """
    own = F.coalesce(F.col("fields").cast(_NO_FIELDS), F.map_from_arrays(F.array(), F.array()).cast(_NO_FIELDS))
    base = devices.withColumn("fields", own)
    lacks = lambda name: F.coalesce(F.try_element_at("fields", F.lit(name)), F.lit("")) == ""
    wanting = base.where(lacks("nbg_name") | lacks("branch_name")).select(F.col("device_id").alias("child"))
    order = Window.partitionBy("child").orderBy("ord", "parent")
    first_steps = wanting.join(relations, "child").select("child", "parent", F.row_number().over(order).alias("_at"))
    first_steps = runs.written(first_steps.join(entities.select(F.col("id").alias("parent"), "expands", F.col("fields").alias("_own")), "parent"), "walk-parents")
    # parents are shared by many devices, and what is above one is worked out once
    above = resolve_upwards(relations, entities, first_steps.where("expands").select(F.col("parent").alias("node")))
    named = first_steps.join(above.withColumnsRenamed({"node": "parent", "fields": "_above"}), "parent", "left")
    parts = named.select("child", F.inline(F.array(
        F.struct(F.array("_at", F.lit(0)).alias("path"), F.col("_own").alias("fields")), F.struct(F.array("_at", F.lit(1)).alias("path"), F.col("_above").alias("fields"))
    )))
    walked = _first_fields(parts.where("fields IS NOT NULL"), "child").where("value <> ''")
    walked = walked.groupBy("child").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_walked"))
    filled = F.map_filter("fields", lambda _, v: F.coalesce(v, F.lit("")) != "")
    rest = F.map_filter(F.coalesce("_walked", F.map_from_arrays(F.array(), F.array()).cast(_NO_FIELDS)), lambda k, _: ~F.map_contains_key(filled, k))
    merged = base.join(walked, base["device_id"] == walked["child"], "left").withColumn("fields", F.map_concat(filled, rest)).drop("child", "_walked")
    fallback = customers.select(F.col("customer_id"), F.col("bank_name").alias("_bank"), F.col("nbg_name").alias("_nbg"))
    merged = merged.join(fallback, "customer_id", "left")
    given = F.map_filter(F.create_map(F.lit("bank_name"), "_bank", F.lit("nbg_name"), "_nbg"), lambda _, v: F.coalesce(v, F.lit("")) != "")
    others = F.map_filter("fields", lambda k, _: ~k.isin("bank_name", "nbg_name"))
    known = F.col("_bank").isNotNull() | F.col("_nbg").isNotNull()
    merged = merged.withColumn("fields", F.when(lacks("nbg_name") & known, F.map_concat(others, given)).otherwise(F.col("fields"))).drop("_bank", "_nbg")
    levels = F.array_compact(F.array(*(F.try_element_at("fields", F.lit(name)) for name in PATH_LEVELS)))
    return merged.withColumns({"full_path": F.concat_ws(" → ", levels), "hierarchy_depth": F.size(levels)})
