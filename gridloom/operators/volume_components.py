"""Components of equal labels in a volume, in two levels: inside bricks by a kernel, across them by the graph operator.

A brick is labelled in one task; only links between parts of neighbouring bricks go to the distributed graph, so its size
follows the bricks' faces, not the voxels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.components import components_of_edges
from gridloom.operators.grid import Grid
from gridloom.operators.numbering import number_rows

_KEY = ["bz", "by", "bx"]


def steps(connectivity: int) -> list[tuple[int, int, int]]:
    """Half of the neighbours over faces (1), edges (2) or corners (3): those that follow in scan order."""
    return [s for s in ((a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)) if s > (0, 0, 0) and sum(map(abs, s)) <= connectivity]


def _inside(connectivity: int):
    near = steps(connectivity)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf[list(AXES)].to_numpy(np.int64)
        low = at.min(axis=0)
        size = at.max(axis=0) - low + 3
        place = np.ravel_multi_index(tuple((at - low + 1).T), tuple(size))
        order = np.argsort(place)
        place, label = place[order], pdf["label"].to_numpy()[order]
        ids = np.arange(len(place))
        pairs = []
        for s in near:
            other = np.searchsorted(place, place + np.ravel_multi_index(tuple(np.array(s) + 1), tuple(size)) - np.ravel_multi_index((1, 1, 1), tuple(size)))
            target = place + np.ravel_multi_index(tuple(np.array(s) + 1), tuple(size)) - np.ravel_multi_index((1, 1, 1), tuple(size))
            good = np.flatnonzero((other < len(place)) & (place[np.minimum(other, len(place) - 1)] == target))
            good = good[label[good] == label[other[good]]]
            pairs.append((good, other[good]))
        a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
        while True:
            old = ids
            ids = ids.copy()
            np.minimum.at(ids, a, old[b])
            np.minimum.at(ids, b, old[a])
            ids = ids[ids]
            if (ids == old).all():
                break
        out = pdf.iloc[order].copy()
        out["part"] = ids
        return out

    return run


def parts_in_bricks(voxels: DataFrame, grid: Grid, connectivity: int = 1) -> DataFrame:
    """(z, y, x, label, bz, by, bx, part): parts are numbered inside each brick by their first voxel."""
    rows = voxels.where("label <> 0").select(*(F.col(a).cast("int") for a in AXES), F.col("label").cast("long"), *grid.cells())
    return rows.groupBy(*_KEY).applyInPandas(_inside(connectivity), "z int, y int, x int, label long, bz long, by long, bx long, part long")


def label_components(voxels: DataFrame, grid: Grid | None = None, connectivity: int = 1) -> DataFrame:
    """(z, y, x, label, component): component is the least part of what connects voxels of one label; its numbers only tell components apart."""
    from gridloom.operators.lineage import cut

    grid = grid or Grid((64, 64, 64))
    volume = grid.shape[0] * grid.shape[1] * grid.shape[2]
    # Bricks are numbered, and a brick's parts are fewer than its voxels, so this tells the parts of all bricks apart.
    bricks = cut(number_rows(voxels.where("label <> 0").select(*grid.cells()).distinct(), _KEY, "_brick"))
    parts = parts_in_bricks(voxels, grid, connectivity).join(bricks, _KEY)
    parts = cut(parts.withColumn("part", F.col("_brick") * volume + F.col("part")).drop("_brick"))
    edge = F.lit(False)
    for k, a in enumerate(AXES):
        at = F.col(a) - grid.corner(k)
        edge |= (at == 0) | (at == grid.shape[k] - 1)
    shell = parts.where(edge)
    moved = shell.select("label", F.col("part").alias("_p"), *(F.col(k).alias(f"_{k}") for k in _KEY), F.explode(F.array(*[F.struct((F.col("z") + a).alias("z"), (F.col("y") + b).alias("y"), (F.col("x") + c).alias("x")) for a, b, c in steps(connectivity)])).alias("_n")).select("label", "_p", *(f"_{k}" for k in _KEY), "_n.*")
    links = moved.join(shell.select(*(F.col(c).alias(c) for c in (*AXES, "label", "part", *_KEY))), [*AXES, "label"])
    other = F.lit(False)
    for k in _KEY:
        other |= F.col(k) != F.col(f"_{k}")
    links = links.where(other).select(F.col("_p").alias("src"), F.col("part").alias("dst")).distinct()
    found = components_of_edges(links)
    return parts.join(found, F.col("part") == F.col("node"), "left").select(*AXES, "label", F.coalesce("component", "part").alias("component"))


def relabel_components(voxels: DataFrame, grid: Grid | None = None, connectivity: int = 1, next_label: int | None = None, subset: DataFrame | None = None) -> DataFrame:
    """Voxels in which each piece of a label that is in several pieces has a new label, consecutive from next_label (largest + 1)
    in order of label and first voxel; labels of one piece stay."""
    every = voxels.where("label <> 0")
    chosen = every if subset is None else every.join(subset.select("label").distinct(), "label", "left_semi").select(*voxels.columns)
    if next_label is None:
        next_label = (every.agg(F.max("label")).first()[0] or 0) + 1
    from gridloom.operators.lineage import cut

    found = cut(label_components(chosen, grid, connectivity))
    pieces = found.groupBy("label", "component").agg(F.min(F.struct(*AXES)).alias("first"))
    several = pieces.groupBy("label").agg(F.count("*").alias("_n")).where("_n > 1").select("label")
    names = number_rows(pieces.join(several, "label", "left_semi").select("label", "first", "component"), ["label", "first"], "new", next_label)
    names = names.select(F.col("label").alias("_l"), F.col("component").alias("_c"), "new")
    moved = found.join(names, (F.col("label") == F.col("_l")) & (F.col("component") == F.col("_c")), "left").select(*AXES, F.coalesce("new", "label").alias("label"))
    if subset is None:
        return moved
    rest = every.join(subset.select("label").distinct(), "label", "left_anti").select(*AXES, "label")
    return moved.unionByName(rest)


def largest_piece_first(pieces: DataFrame) -> DataFrame:
    """Pieces (label, component, size) with their rank by size within the label, 0 for the largest."""
    return pieces.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(F.desc("size"), "component")) - 1)
