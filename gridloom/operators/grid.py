"""Grids of bricks over voxel tables (z, y, x, label): a row that is absent is background, 0.

Boxes are half-open. A grid is plain arithmetic on coordinates, so partitioning by brick, re-tiling and halos are
column expressions; only a shuffle that needs the bricks together moves rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES, floor_div

Box = tuple[tuple[int, int, int], tuple[int, int, int]]


@dataclass(frozen=True)
class Grid:
    shape: tuple[int, int, int]
    offset: tuple[int, int, int] = (0, 0, 0)
    halo: tuple[int, int, int] = field(default=(0, 0, 0))

    def cell(self, axis: int, c: str | Column | None = None) -> Column:
        """The grid coordinate along an axis."""
        c = AXES[axis] if c is None else c
        c = F.col(c) if isinstance(c, str) else c
        return floor_div(c - self.offset[axis], self.shape[axis])

    def cells(self) -> list[Column]:
        return [self.cell(i).alias(f"b{a}") for i, a in enumerate(AXES)]

    def corner(self, axis: int) -> Column:
        return self.cell(axis) * self.shape[axis] + self.offset[axis]

    def span(self, box: Box) -> list[tuple[int, int]]:
        """The first grid cell and the one after the last that a box touches, for each axis."""
        return [((box[0][i] - self.offset[i]) // self.shape[i], -((self.offset[i] - box[1][i]) // self.shape[i])) for i in range(3)]


def within(box: Box) -> Column:
    """A predicate that reaches the scan: coordinates inside the box."""
    (z0, y0, x0), (z1, y1, x1) = box
    return (F.col("z") >= z0) & (F.col("z") < z1) & (F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1)


def intersection(a: Box, b: Box) -> Box:
    """May be empty: stop at or below start."""
    return tuple(map(max, a[0], b[0])), tuple(map(min, a[1], b[1]))


def scaled_box(box: Box, factor: tuple[int, int, int]) -> Box:
    """The box at a coarser scale, rounded out."""
    return tuple(c // f for c, f in zip(box[0], factor, strict=True)), tuple(-(-c // f) for c, f in zip(box[1], factor, strict=True))


def bounding_box(voxels: DataFrame) -> DataFrame:
    return voxels.agg(*(F.min(a).alias(f"{a}0") for a in AXES), *((F.max(a) + 1).alias(f"{a}1") for a in AXES))


def bricks(spark: SparkSession, grid: Grid, box: Box) -> DataFrame:
    """A row for each grid cell that a box touches: cell, scan-order index, logical box, and physical box (with halo, clipped)."""
    (z0, z1), (y0, y1), (x0, x1) = grid.span(box)
    ny, nx = y1 - y0, x1 - x0
    i = F.col("id")
    cell = [F.call_function("div", i, F.lit(ny * nx)) + z0, F.call_function("div", i % (ny * nx), F.lit(nx)) + y0, i % nx + x0]
    out = spark.range(max(0, (z1 - z0) * ny * nx)).select(F.col("id").alias("brick_index"), *(c.alias(f"b{a}") for c, a in zip(cell, AXES, strict=True)))
    for k, a in enumerate(AXES):
        low = F.col(f"b{a}") * grid.shape[k] + grid.offset[k]
        out = out.withColumn(f"l{a}0", low).withColumn(f"l{a}1", low + grid.shape[k])
        out = out.withColumn(f"p{a}0", F.greatest(F.col(f"l{a}0") - grid.halo[k], F.lit(box[0][k]))).withColumn(f"p{a}1", F.least(F.col(f"l{a}1") + grid.halo[k], F.lit(box[1][k])))
    return out


def brick_index(grid: Grid, box: Box) -> Column:
    """Scan-order index of a voxel's grid cell in a box that is rounded out to the grid."""
    (z0, _), (y0, y1), (x0, x1) = grid.span(box)
    return ((grid.cell(0) - z0) * (y1 - y0) + (grid.cell(1) - y0)) * (x1 - x0) + (grid.cell(2) - x0)


def split_to_grid(voxels: DataFrame, grid: Grid) -> DataFrame:
    """Each voxel once for each cell whose box with halo holds it; in_halo tells the copies from the original."""
    out = voxels
    for k, a in enumerate(AXES):
        low, high = grid.cell(k, F.col(a) - grid.halo[k]), grid.cell(k, F.col(a) + grid.halo[k])
        out = out.withColumn(f"b{a}", F.explode(F.sequence(low, high)) if grid.halo[k] else low)
    own = [F.col(f"b{a}") == grid.cell(k) for k, a in enumerate(AXES)]
    return out.withColumn("in_halo", ~(own[0] & own[1] & own[2]))


def clip_to_logical(split: DataFrame) -> DataFrame:
    """Without the halos' copies."""
    return split.where(~F.col("in_halo")).drop("in_halo")


def realign(voxels: DataFrame, grid: Grid, partitions: int | None = None) -> DataFrame:
    """Rows with their cell of a new grid, and with the rows of a cell in one partition."""
    keyed = voxels.select("*", *grid.cells())
    keys = [f"b{a}" for a in AXES]
    return keyed.repartition(partitions, *keys) if partitions else keyed.repartition(*keys)


def fill_missing(voxels: DataFrame, background: DataFrame) -> DataFrame:
    """Voxels, and where there is none, those of the background."""
    b = background.select(*(F.col(a).alias(f"_{a}") for a in AXES), F.col("label").alias("_label"))
    on = (F.col("z") == F.col("_z")) & (F.col("y") == F.col("_y")) & (F.col("x") == F.col("_x"))
    return voxels.join(b, on, "full_outer").select(*(F.coalesce(a, f"_{a}").alias(a) for a in AXES), F.coalesce("label", "_label").alias("label"))


def pad(voxels: DataFrame, grid: Grid, stored: DataFrame) -> DataFrame:
    """Voxels, with the stored ones in the rest of each cell of the padding grid that the voxels touch."""
    keys = [f"b{a}" for a in AXES]
    touched = voxels.select(*grid.cells()).distinct()
    return fill_missing(voxels, stored.select("*", *grid.cells()).join(touched, keys, "left_semi").drop(*keys))


def dense(voxels: DataFrame, box: Box) -> DataFrame:
    """Every coordinate of the box, 0 where there is no voxel."""
    spark = voxels.sparkSession
    (z0, y0, x0), (z1, y1, x1) = box
    ny, nx = y1 - y0, x1 - x0
    i = F.col("id")
    frame = spark.range(max(0, z1 - z0) * max(0, ny) * max(0, nx)).select((F.call_function("div", i, F.lit(ny * nx)) + z0).alias("_z"), (F.call_function("div", i % (ny * nx), F.lit(nx)) + y0).alias("_y"), (i % nx + x0).alias("_x"))
    on = (F.col("z") == F.col("_z")) & (F.col("y") == F.col("_y")) & (F.col("x") == F.col("_x"))
    return frame.join(voxels, on, "left").select(*(F.col(f"_{a}").cast("int").alias(a) for a in AXES), F.coalesce("label", F.lit(0)).alias("label"))


def halos(voxels: DataFrame, grid: Grid, side: str = "outer", faces: str = "all", width: int = 1) -> DataFrame:
    """Voxels of each cell's faces with the face's cell, axis and end: `outer` ones just outside it, `inner` ones just inside; `lower`, `upper` or `all` ends."""
    ends = {"lower": (-1,), "upper": (1,), "all": (-1, 1)}[faces]
    choices = []
    for k, a in enumerate(AXES):
        at = F.col(a) - grid.corner(k)
        n = grid.shape[k]
        for end in ends:
            # Outside a cell's lower face is inside the upper face of the cell below.
            near = at < width if (end < 0) == (side == "inner") else at >= n - width
            shift = 0 if side == "inner" else -end
            cell = [(grid.cell(j) + (shift if j == k else 0)).alias(f"b{b}") for j, b in enumerate(AXES)]
            choices.append(F.when(near, F.struct(*cell, F.lit(a).alias("axis"), F.lit(end).alias("end"))))
    found = voxels.withColumn("_f", F.explode(F.filter(F.array(*choices), lambda f: f.isNotNull())))
    return found.select(*voxels.columns, "_f.*")


def face_links(voxels: DataFrame, grid: Grid) -> DataFrame:
    """Distinct pairs of labels that face each other across a cell boundary, background left out."""
    outer = halos(voxels.where("label <> 0"), grid, "outer", "lower").select(*AXES, "axis", F.col("label").alias("label_a"))
    step = {a: F.when(F.col("axis") == a, F.col(a) + 1).otherwise(F.col(a)) for a in AXES}
    outer = outer.select(*(step[a].alias(a) for a in AXES), "axis", "label_a")
    inner = halos(voxels.where("label <> 0"), grid, "inner", "lower").select(*AXES, "axis", F.col("label").alias("label_b"))
    return outer.join(inner, [*AXES, "axis"]).select("label_a", "label_b").distinct()


def translate(voxels: DataFrame, by: tuple[int, int, int], scale: int = 0) -> DataFrame:
    """Moved coordinates; the shift is rounded down to the scale."""
    return voxels.withColumns({a: F.col(a) + (t >> scale) for a, t in zip(AXES, by, strict=True)})


def transpose(voxels: DataFrame, order: tuple[str, str, str], box: Box) -> DataFrame:
    """Axes in another order; `1-x` names an axis that is also turned round within the box."""
    size = {a: box[1][k] for k, a in enumerate(AXES)}
    source = {a: (o[2:] if o.startswith("1-") else o, o.startswith("1-")) for a, o in zip(AXES, order, strict=True)}
    return voxels.select(*((F.lit(size[o] - 1) - F.col(o) if turned else F.col(o)).cast("int").alias(a) for a, (o, turned) in source.items()), *(c for c in voxels.columns if c not in AXES))


def drop_empty(voxels: DataFrame, grid: Grid) -> DataFrame:
    """Rows of the cells that hold anything but background."""
    keys = [f"b{a}" for a in AXES]
    full = voxels.where("label <> 0").select(*grid.cells()).distinct()
    return voxels.select("*", *grid.cells()).join(full, keys, "left_semi").drop(*keys)


def to_bricks(voxels: DataFrame, grid: Grid, dtype: str = "uint64") -> DataFrame:
    """Brick table: a row for each non-empty cell with its corner and dense C-order bytes. A cell's size bounds what a task holds."""
    keys = [f"b{a}" for a in AXES]

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        corner = [int(pdf[f"b{a}"].iat[0]) * n + o for a, n, o in zip(AXES, grid.shape, grid.offset, strict=True)]
        block = np.zeros(grid.shape, dtype)
        block[tuple(pdf[a].to_numpy() - c for a, c in zip(AXES, corner, strict=True))] = pdf["label"].to_numpy()
        return pd.DataFrame({**{k: [pdf[k].iat[0]] for k in keys}, **{f"{a}0": [c] for a, c in zip(AXES, corner, strict=True)}, "payload": [block.tobytes()], "dtype": [dtype]})

    rows = voxels.where("label <> 0").select(*(F.col(a).cast("long") for a in AXES), "label", *grid.cells())
    return rows.groupBy(*keys).applyInPandas(pack, "bz long, by long, bx long, z0 long, y0 long, x0 long, payload binary, dtype string")


def from_bricks(table: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """The voxels of a brick table that aren't background."""

    def unpack(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                block = np.frombuffer(row.payload, row.dtype).reshape(shape)
                at = np.nonzero(block)
                yield pd.DataFrame({a: (i + c).astype(np.int32) for a, i, c in zip(AXES, at, (row.z0, row.y0, row.x0), strict=True)} | {"label": block[at].astype(np.int64)})

    return table.select("z0", "y0", "x0", "payload", "dtype").mapInPandas(unpack, "z int, y int, x int, label long")


def map_bricks(voxels: DataFrame, grid: Grid, fn) -> DataFrame:
    """Voxels of fn(block), an array of the same shape, for every non-empty cell: the seam for opaque kernels."""
    packed = to_bricks(voxels, grid)

    def run(batches):
        for pdf in batches:
            pdf = pdf.copy()
            pdf["payload"] = [np.ascontiguousarray(fn(np.frombuffer(p, d).reshape(grid.shape)), d).tobytes() for p, d in zip(pdf["payload"], pdf["dtype"], strict=True)]
            yield pdf

    return from_bricks(packed.mapInPandas(run, packed.schema), grid.shape)


def cells_of_labels(label_index: DataFrame, labels: DataFrame, grid: Grid) -> DataFrame:
    """Distinct cell corners and labels, from a label index (label, z, y, x of blocks) and the labels wanted."""
    hit = label_index.join(labels.select("label").distinct(), "label", "left_semi")
    return hit.select(*(grid.corner(k).alias(a) for k, a in enumerate(AXES)), "label").distinct()


def labels_without_index(label_index: DataFrame, labels: DataFrame) -> DataFrame:
    return labels.select("label").distinct().join(label_index.select("label"), "label", "left_anti")


def cells_of_groups(label_index: DataFrame, groups: DataFrame, grid: Grid, least: int = 2) -> DataFrame:
    """(z, y, x, group, label) of the cells that hold at least so many labels of a group."""
    cells = cells_of_labels(label_index, groups, grid).join(groups.select("label", "group").distinct(), "label")
    full = cells.groupBy(*AXES, "group").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).drop("_n")
    return cells.join(full, [*AXES, "group"]).select(*AXES, "group", "label")


def pairs_as_groups(pairs: DataFrame, a: str = "label_a", b: str = "label_b", ordinal: str = "i") -> DataFrame:
    """Pair i as the two-member group i."""
    return pairs.select(F.col(ordinal).alias("group"), F.explode(F.array(a, b)).alias("label")).select("label", "group")
