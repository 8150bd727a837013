"""Grid cells: selection, scan outcome, completeness and rollups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from placeledger.functions.geo import distance_m


def next_cells(cells: DataFrame, retry_limit: int, n: int, allow: Sequence[int] | DataFrame | None = None) -> DataFrame:
    """First `n` pending, retryable cells of every region by cell order, or in the
    caller's order when `allow` lists the cell ids (as DataFrame: id, pos).

    The rank filter is applied before the shuffle too, so a task sends at most n rows
    per region however large the region.
    """
    open_cells = cells.filter((F.col("status") == "pending") & (F.col("attempts") < retry_limit))
    order = [F.col("cell_order")]
    if allow is not None:
        if not isinstance(allow, DataFrame):
            listed = [(int(cell), pos) for pos, cell in enumerate(allow)]
            allow = cells.sparkSession.createDataFrame(listed, "id bigint, pos int")
        open_cells = open_cells.join(allow.select("id", F.col("pos").alias("_pos")), "id")
        order = [F.col("_pos"), *order]
    ranked = open_cells.withColumn("_rank", F.row_number().over(W.partitionBy("region_id").orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank", "_pos")


def ordered_allowlist(cells: DataFrame, allow: DataFrame, region_id: int | None = None) -> DataFrame:
    """Every listed cell (id, pos) with `problem` NULL when it may be used, else
    `missing` or `not_pending`."""
    scope = cells if region_id is None else cells.filter(F.col("region_id") == region_id)
    found = scope.select("id", "region_id", "cell_order", F.col("status").alias("cell_status"))
    return allow.join(found, "id", "left").withColumn(
        "problem",
        F.when(F.col("cell_status").isNull(), "missing").when(F.col("cell_status") != "pending", "not_pending"),
    )


def require_usable(listed: DataFrame) -> DataFrame:
    """Raise when an allowlist has a problem; at most ten of them are named."""
    bad = listed.filter("problem IS NOT NULL").select("id", "problem").limit(10).collect()
    if bad:
        raise ValueError("cells cannot be used: " + ", ".join(f"{r['id']} {r['problem']}" for r in bad))
    return listed.drop("problem", "cell_status")


def nearest_cells(cells: DataFrame, lat: float, lon: float, limit: int,
                  exclude: DataFrame | None = None) -> DataFrame:
    """Pending cells nearest to a point, ties by cell order; `exclude` has column id."""
    pending = cells.filter(F.col("status") == "pending")
    if exclude is not None:
        pending = pending.join(exclude.select("id"), "id", "left_anti")
    away = distance_m(F.lit(float(lat)), F.lit(float(lon)), F.col("center_lat"), F.col("center_lon"))
    return pending.withColumn("distance_m", away).orderBy("distance_m", "cell_order").limit(limit)


def status_counts(cells: DataFrame) -> DataFrame:
    """Cells per region and status."""
    return cells.groupBy("region_id", "status").agg(F.count("*").alias("n"))


def settle_cells(cells: DataFrame, attempts: DataFrame, retry_limit: int) -> DataFrame:
    """Cell status after its latest attempt: complete ends it, a failure or an
    interruption re-opens it while attempts are left. An interrupted cell without
    attempts left stays as it is. `attempts` has id, grid_cell_id, status."""
    newest = attempts.groupBy(F.col("grid_cell_id").alias("id")).agg(
        F.max_by("status", "id").alias("_attempt")
    )
    retry = F.col("attempts") < retry_limit
    status = (
        F.when(F.col("_attempt") == "complete", "completed")
        .when(F.col("_attempt") == "failed", F.when(retry, "pending").otherwise("failed"))
        .when((F.col("status") == "in_progress") & retry, "pending")
        .otherwise(F.col("status"))
    )
    return cells.join(newest, "id", "left").withColumn("status", status).drop("_attempt")


def audit_grids(metadata: DataFrame, cells: DataFrame, cell_size: int, version: str) -> DataFrame:
    """Is each region's stored grid complete? `reason` names the first mismatch."""
    counted = cells.groupBy("region_id").agg(F.count("*").alias("actual_cells"))
    joined = metadata.join(counted, "region_id", "left").withColumn(
        "actual_cells", F.coalesce("actual_cells", F.lit(0).cast("bigint"))
    )
    counts_agree = (F.col("actual_cells") == F.col("expected_cells")) & (
        F.col("persisted_cells") == F.col("expected_cells")
    )
    reason = (
        F.when(~F.col("status").eqNullSafe("complete"), "not_complete")
        .when(~F.col("cell_size_meters").eqNullSafe(cell_size), "cell_size_changed")
        .when(~F.col("generator_version").eqNullSafe(version), "generator_changed")
        .when(~F.coalesce(counts_agree, F.lit(False)), "count_mismatch")
    )
    return joined.withColumn("reason", reason).withColumn("complete", F.col("reason").isNull())


def _per_region(cells: DataFrame) -> DataFrame:
    def of(status: str) -> Column:
        return F.count_if(F.col("status") == status).alias(status)

    return cells.groupBy("region_id").agg(
        F.count("*").alias("total_cells"), *[of(s) for s in ("pending", "in_progress", "completed", "failed")]
    )


def _accepted_per_region(salons: DataFrame) -> DataFrame:
    return salons.groupBy("region_id").agg(
        F.count_if(F.col("filter_status") == "accepted").alias("accepted"),
        F.count_if(F.col("filter_status") == "rejected").alias("rejected"),
    )


def accepted_per_region(salons: DataFrame) -> DataFrame:
    """Accepted and rejected rows per region."""
    return _accepted_per_region(salons)


def region_completion(regions: DataFrame, metadata: DataFrame, cells: DataFrame, salons: DataFrame) -> DataFrame:
    """Per region: may it be closed (complete grid, no open cell), its totals and the
    closing comment. Both big sides are aggregated before they meet the regions."""
    zero = F.lit(0).cast("bigint")
    grids = metadata.select("region_id", (F.col("status") == "complete").alias("_grid"))
    joined = (
        regions.withColumnRenamed("id", "region_id")
        .join(grids, "region_id", "left")
        .join(_per_region(cells), "region_id", "left")
        .join(_accepted_per_region(salons), "region_id", "left")
    )
    n = {c: F.coalesce(c, zero) for c in (
        "total_cells", "pending", "in_progress", "completed", "failed", "accepted", "rejected")}
    closed = F.coalesce("_grid", F.lit(False)) & (n["pending"] + n["in_progress"] == 0)
    comment = F.concat(
        F.lit("Rejected salons: "), n["rejected"].cast("string"),
        F.lit("; failed cells: "), n["failed"].cast("string"),
    )
    return joined.select(
        "region_id", "name",
        closed.alias("closed"),
        F.when(closed, "completed").otherwise(F.col("status")).alias("status"),
        n["total_cells"].alias("total_cells"),
        n["completed"].alias("completed_cells"),
        n["accepted"].alias("salons_found"),
        F.when(closed, comment).alias("comment"),
    )


def attempt_rollup(observed: DataFrame, by: Sequence[str] = ("grid_cell_id",)) -> DataFrame:
    """Scan counters per cell (or other key) from decided sightings with columns
    filter_status and merged."""
    return observed.groupBy(*by).agg(
        F.count("*").alias("raw_organizations_found"),
        F.count_if(F.col("filter_status") == "accepted").alias("accepted_salons"),
        F.count_if(F.col("filter_status") == "rejected").alias("rejected_results"),
        F.count_if("merged").alias("duplicates_merged"),
    )


def run_metrics(rollup: DataFrame, completed_before: int = 0, completed_after: int = 0) -> DataFrame:
    """Totals of one run. `salons_created` subtracts all merges, also those of rejected
    rows, so it can under-report; that is its definition."""
    sums = rollup.agg(
        F.count("*").alias("cells_attempted"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
            for c in ("raw_organizations_found", "accepted_salons", "rejected_results", "duplicates_merged")
        ],
    )
    created = F.greatest(F.col("accepted_salons") - F.col("duplicates_merged"), F.lit(0).cast("bigint"))
    return sums.withColumn("salons_created", created).withColumn(
        "cells_completed", F.lit(max(0, completed_after - completed_before)).cast("bigint")
    )


def attempt_errors(pages: DataFrame) -> DataFrame:
    """Per cell whether its scan failed: the first failed page ends a cell's scan, so a cell
    counts one error at most."""
    return pages.groupBy("grid_cell_id").agg(
        F.max(F.when(F.col("status") == "error", 1).otherwise(0)).cast("bigint").alias("errors"))
