"""Size ranges, masks, and what is kept or erased under them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.aggregates import body_stats
from gridloom.operators.grid import Box, Grid, within


def size_filter(counts: DataFrame, sv_range: tuple[int, int], body_range: tuple[int, int], subset: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """(sv, body, sv_size, body_size) with both sizes in their ranges (both ends included), in the subset, and not yet made."""
    out = body_stats(counts).where(F.col("sv_size").between(*sv_range) & F.col("body_size").between(*body_range))
    if subset is not None:
        out = out.join(subset.select("sv").distinct(), "sv", "left_semi")
    return out if existing is None else out.join(existing.select("sv").distinct(), "sv", "left_anti")


def combine_with_output(new: DataFrame, old: DataFrame, new_labels: DataFrame | None = None, old_labels: DataFrame | None = None) -> DataFrame:
    """New voxels where their label and the one they replace are in the lists (None: any), the old ones elsewhere."""
    a = new.select(*AXES, F.col("label").alias("_new"))
    b = old.select(*AXES, F.col("label").alias("_old"))
    both = a.join(b, list(AXES), "full_outer").fillna(0, ["_new", "_old"])
    use = F.lit(True)
    for column, labels in (("_new", new_labels), ("_old", old_labels)):
        if labels is not None:
            flag = labels.select(F.col("label").alias(f"{column}_l")).distinct()
            both = both.join(flag, F.col(column) == F.col(f"{column}_l"), "left")
            use &= F.col(f"{column}_l").isNotNull()
    return both.select(*AXES, F.when(use, F.col("_new")).otherwise(F.col("_old")).alias("label")).where("label <> 0")


def under_mask(voxels: DataFrame, mask: DataFrame) -> DataFrame:
    """Voxels where the mask isn't background; the others become background, so their rows go."""
    return voxels.join(mask.where("label <> 0").select(*AXES).distinct(), list(AXES), "left_semi")


def mask_counts(mask: DataFrame, grid: Grid) -> DataFrame:
    """Mask voxels in each brick."""
    return mask.where("label <> 0").groupBy(*grid.cells()).agg(F.count("*").alias("mask_voxels"))


def erase_under(voxels: DataFrame, mask: DataFrame, block: int = 64) -> tuple[DataFrame, DataFrame]:
    """Voxels outside the mask, and block statistics of those erased."""
    from gridloom.operators.aggregates import block_statistics

    inside = mask.where("label <> 0").select(*AXES).distinct()
    return voxels.join(inside, list(AXES), "left_anti"), block_statistics(voxels.join(inside, list(AXES), "left_semi"), block)


def dilate(mask: DataFrame, radius: int = 1, connectivity: int = 1) -> DataFrame:
    """The mask's coordinates grown by steps to neighbours over faces (1), edges (2) or corners (3)."""
    steps = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if abs(a) + abs(b) + abs(c) <= connectivity]
    out = mask.select(*AXES).distinct()
    for _ in range(radius):
        moved = F.explode(F.array(*[F.struct((F.col("z") + a).alias("z"), (F.col("y") + b).alias("y"), (F.col("x") + c).alias("x")) for a, b, c in steps]))
        out = out.select(moved.alias("_n")).select("_n.*").distinct()
    return out


def complement(mask: DataFrame, box: Box) -> DataFrame:
    """The box's coordinates that the mask hasn't."""
    from gridloom.operators.grid import dense

    whole = dense(mask.select(*AXES).distinct().withColumn("label", F.lit(1)), box)
    return whole.where("label = 0").select(*AXES)


def erode(mask: DataFrame, box: Box, radius: int = 1, connectivity: int = 1) -> DataFrame:
    """The complement of the complement's growth; what lies outside the box doesn't erode."""
    gone = dilate(complement(mask, box), radius, connectivity)
    return mask.select(*AXES).distinct().join(gone, list(AXES), "left_anti")


def drop_tiny_interior(voxels: DataFrame, box: Box, least: int) -> DataFrame:
    """Without the labels of fewer voxels than `least`, but for those that touch the box's faces."""
    edge = F.lit(False)
    for i, a in enumerate(AXES):
        edge |= (F.col(a) == box[0][i]) | (F.col(a) == box[1][i] - 1)
    kept = voxels.where("label <> 0").groupBy("label").agg(F.count("*").alias("_n"), F.bool_or(edge).alias("_e")).where((F.col("_n") >= least) | F.col("_e"))
    return voxels.join(kept.select("label"), "label", "left_semi").select(*voxels.columns)


def spread_or_large(parts: DataFrame, key: str, size: str, least: int) -> DataFrame:
    """Rows of objects that occur in several bricks or are large enough in one."""
    kept = parts.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"), F.max(size).alias("_s")).where((F.col("_n") > 1) | (F.col("_s") >= least))
    return parts.join(kept.select("_k"), F.col(key) == F.col("_k"), "left_semi")


def groups_with_flags(rows: DataFrame, group: str, flag: Column, least: int) -> DataFrame:
    """Rows of the groups in which the flags add up to at least so much."""
    kept = rows.groupBy(F.col(group).alias("_g")).agg(F.sum(flag.cast("long")).alias("_n")).where(F.col("_n") >= least)
    return rows.join(kept.select("_g"), F.col(group) == F.col("_g"), "left_semi")


def groups_where_all(rows: DataFrame, group: list[str], flag: Column) -> DataFrame:
    """Rows of the groups in which the flag holds throughout."""
    kept = rows.groupBy(*group).agg(F.bool_and(flag).alias("_all")).where("_all").drop("_all")
    return rows.join(kept, group, "left_semi")


def split_by_count(rows: DataFrame, group: list[str], name: str = "n_rows") -> DataFrame:
    """Each row with its group's number of rows: one, or several."""
    counts = rows.groupBy(*group).agg(F.count("*").alias(name))
    return rows.join(counts, group)


def in_roi(voxels: DataFrame, roi_blocks: DataFrame, block: int = 32) -> DataFrame:
    """Voxels whose block is in the list (bz, by, bx)."""
    grid = Grid((block, block, block))
    return voxels.select("*", *grid.cells()).join(roi_blocks.select("bz", "by", "bx").distinct(), ["bz", "by", "bx"], "left_semi").drop("bz", "by", "bx")


def empty_regions(voxels: DataFrame, box: Box, least: int) -> DataFrame:
    """Connected regions of background of at least so many voxels: (z, y, x, region)."""
    from gridloom.operators.volume_components import label_components

    free = complement(voxels.where("label <> 0"), box).withColumn("label", F.lit(1))
    parts = label_components(free).withColumnRenamed("component", "region")
    large = parts.groupBy("region").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return parts.join(large, "region", "left_semi").select(*AXES, "region")


def box_filter(voxels: DataFrame, box: Box) -> DataFrame:
    return voxels.where(within(box))


def overlap_bodies(overlaps: DataFrame, size: int, fraction: float, classes: list[int]) -> DataFrame:
    """Objects whose largest share in the given classes reaches the fraction: (label, class_id, fraction, total)."""
    totals = overlaps.groupBy("label").agg(F.sum("voxels").alias("total"), F.sum(F.when(F.col("class_id").isin(classes), F.col("voxels")).otherwise(0)).alias("inside"))
    return totals.where(F.col("total") >= size).withColumn("fraction", F.col("inside") / F.col("total")).where(F.col("fraction") >= fraction)
