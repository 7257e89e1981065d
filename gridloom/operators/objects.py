"""Choosing and grouping the objects of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.aggregates import add_totals, adaptive_factor
from gridloom.operators.grid import Grid


def body_flags(segments: DataFrame, segment_range: tuple[int, int], body_range: tuple[int, int], pieces_range: tuple[int, int], subset: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Segments (segment, body, size) with their body's size and number of segments, keep_segment and keep_body; nothing is dropped, so what is left out can be reported."""
    totals = segments.groupBy(F.col("body").alias("_b")).agg(F.sum("size").alias("body_size"), F.count("*").alias("segments"))
    out = segments.join(totals, F.col("body") == F.col("_b")).drop("_b")
    keep = F.col("body_size").between(*body_range) & F.col("segments").between(*pieces_range)
    for other, wanted in ((subset, True), (existing, False)):
        if other is not None:
            mark = other.select(F.col("body").alias("_m")).distinct()
            out = out.join(mark, F.col("body") == F.col("_m"), "left").withColumn("_keep", F.col("_m").isNotNull() == F.lit(wanted)).drop("_m")
            out = out.withColumn("_all", F.col("_keep") & (F.col("_all") if "_all" in out.columns else F.lit(True))).drop("_keep")
    if "_all" in out.columns:
        keep &= F.col("_all")
    return out.withColumns({"keep_segment": F.col("size").between(*segment_range), "keep_body": keep}).drop("_all")


def group_key(scheme: str, label: str = "label", body: str | None = None) -> Column:
    """The key of a mesh archive: hundreds of labels, the mapped body (the label itself without one), or each alone."""
    if scheme == "hundreds":
        return F.col(label) - F.pmod(F.col(label), F.lit(100))
    if scheme == "mapped":
        return F.coalesce(F.col(body), F.col(label))
    if scheme == "singletons":
        return F.col(label)
    raise ValueError("scheme is hundreds, mapped or singletons")


def grouped_objects(objects: DataFrame, key: Column, label: str = "label", skip: DataFrame | None = None) -> DataFrame:
    """(key, members): sorted ids of each archive, but for those to skip."""
    rows = objects.select(key.alias("key"), F.col(label).alias("_l"))
    if skip is not None:
        rows = rows.join(skip.select("key").distinct(), "key", "left_anti")
    return rows.groupBy("key").agg(F.array_sort(F.collect_list("_l")).alias("members"))


def oversized(objects: DataFrame, payload: str, most: int, key: str = "label") -> DataFrame:
    """Bodies whose payloads add up to more than a task should hold."""
    return objects.groupBy(key).agg(F.sum(F.octet_length(payload)).alias("bytes")).where(F.col("bytes") > most)


def by_status(work: DataFrame, done: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """The part of a work list that is done, and the part that isn't."""
    made = done.select(*key).distinct()
    return work.join(made, key, "left_semi"), work.join(made, key, "left_anti")


def roi_partition(roi_blocks: DataFrame, block: int, partition: int) -> DataFrame:
    """(z, y, x, blocks): grid-aligned substacks that hold blocks (z, y, x in blocks) of a region."""
    grid = Grid((partition // block,) * 3)
    return roi_blocks.groupBy(*((grid.cell(i) * partition).alias(a) for i, a in enumerate(AXES))).agg(F.count("*").alias("blocks"))


def mask_factors(segments: DataFrame, limit: int, least: int = 1) -> DataFrame:
    """Segment statistics (label, count, box) with body totals' box size and the factor that brings it near the limit, largest first."""
    size = (F.col("z1") - F.col("z0")).cast("double") * (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    return segments.withColumn("box_size", size.cast("long")).withColumn("factor", adaptive_factor(size, limit, least)).orderBy(F.desc("box_size"), "label")


def groups_in_bricks(labelled: DataFrame, groups: DataFrame, brick: list[str], least: int = 2) -> DataFrame:
    """Labels of a brick whose group has at least so many of its members there, with consecutive numbers in the brick from 1.
    A brick's labels are ranked where they meet; there are no more of them than its voxels."""
    present = labelled.where("label <> 0").select(*brick, "label").distinct().join(groups.select("label", "group").distinct(), "label")
    full = present.groupBy(*brick, "group").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).drop("_n")
    kept = present.join(full, [*brick, "group"], "left_semi").select(*brick, "label").distinct()
    return kept.withColumn("number", F.row_number().over(Window.partitionBy(*brick).orderBy("label")))


def share_of_total(rows: DataFrame, key: str, value: str) -> DataFrame:
    totals = add_totals(rows, key, value, "_total")
    return totals.withColumn("share", F.col(value) / F.col("_total")).drop("_total")
