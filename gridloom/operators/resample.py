"""Changing scale: sampling, means, modes, their pyramids, and the way back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.arithmetic import AXES, floor_div
from gridloom.operators.grid import Box

Factor = tuple[int, int, int]


def _cells(factor: Factor) -> list[Column]:
    return [floor_div(a, f).cast("int").alias(a) for a, f in zip(AXES, factor, strict=True)]


def subsample(voxels: DataFrame, factor: Factor) -> DataFrame:
    """The first voxel of each block."""
    first = F.lit(True)
    for a, f in zip(AXES, factor, strict=True):
        first &= F.pmod(F.col(a), F.lit(f)) == 0
    return voxels.where(first).select(*_cells(factor), "label")


def block_mean(values: DataFrame, factor: Factor, value: str = "value", whole: bool = False, absent: bool = True) -> DataFrame:
    """Mean of each block; `absent` counts voxels without a row as 0, `whole` rounds down as integers do."""
    n = F.lit(factor[0] * factor[1] * factor[2]) if absent else F.count("*")
    mean = F.call_function("div", F.sum(F.col(value).cast("long")), n.cast("long")) if whole else F.sum(value) / n
    return values.groupBy(*_cells(factor)).agg(mean.alias(value))


def block_mode(voxels: DataFrame, factor: Factor, ignore_zero: bool = True) -> DataFrame:
    """Most frequent label of each block, the smallest at a tie. With ignore_zero background counts only if there is nothing else;
    otherwise absent voxels vote for it. Counts are summed before each shuffle and the best is one aggregate of structs."""
    counts = voxels.where("label <> 0").groupBy(*_cells(factor), "label").agg(F.count("*").alias("_n"))
    best = counts.groupBy(*AXES).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("label").alias("label"))).alias("_b"), F.sum("_n").alias("_all"))
    if not ignore_zero:
        empty = factor[0] * factor[1] * factor[2] - F.col("_all")
        best = best.where(empty < -F.col("_b.n"))
    return best.select(*AXES, F.col("_b.label").alias("label"))


def binary_mode(mask: DataFrame, factor: Factor) -> DataFrame:
    """Blocks of which more than half is set."""
    half = factor[0] * factor[1] * factor[2] / 2
    return mask.where("label <> 0").groupBy(*_cells(factor)).agg(F.count("*").alias("_n")).where(F.col("_n") > half).select(*AXES, F.lit(1).cast("long").alias("label"))


def reduce_blocks(voxels: DataFrame, factor: Factor, fn: Callable[[pd.DataFrame], int], result: T.DataType | str = "long") -> DataFrame:
    """Any scalar function of a block's rows. A block is small by construction, so a task sorts its blocks and cuts them out of batches of many;
    sending each block by itself costs far more than most functions take.

    Whole numbers and flags travel beside marks of their nulls: else one null in a batch would make floats of the other blocks' numbers."""
    cells = [floor_div(a, f).cast("int") for a, f in zip(AXES, factor, strict=True)]
    keys = [f"_b{a}" for a in AXES]
    dealt = voxels.repartition(*cells).select(*(c.alias(k) for c, k in zip(cells, keys, strict=True)), *voxels.columns)
    marks = {f.name: f"_null_{f.name}" for f in dealt.schema if f.nullable and isinstance(f.dataType, T.IntegralType | T.BooleanType)}
    flags = {f.name for f in dealt.schema if isinstance(f.dataType, T.BooleanType)}
    filled = [F.coalesce(c, F.lit(False if c in flags else 0).cast(dealt.schema[c].dataType)).alias(c) if c in marks else F.col(c) for c in dealt.columns]
    ordered = dealt.sortWithinPartitions(*keys).select(*filled, *(F.col(c).isNull().alias(m) for c, m in marks.items()))
    columns = dealt.columns
    sides = [*keys, *(marks[k] for k in keys if k in marks)]

    def reduced(rows: pd.DataFrame, starts: np.ndarray, stop: int) -> pd.DataFrame:
        """The function's values for the blocks that begin at `starts`, the last one ending at `stop`."""
        data, ends, out = rows[columns].copy(), [*starts[1:], stop], []
        nulls = {c: rows[m].to_numpy() for c, m in marks.items() if rows[m].any()}
        for i, j in zip(starts, ends, strict=True):
            block = data.iloc[i:j]
            block.index = pd.RangeIndex(j - i)
            for c, null in nulls.items():
                if null[i:j].any():
                    block = block.assign(**{c: block[c].astype(object if c in flags else "float64").where(~null[i:j], None if c in flags else np.nan)})
            out.append(fn(block))
        found = {a: data[k].iloc[starts].astype(object).where(~nulls[k][starts], None).to_numpy() if k in nulls else data[k].to_numpy()[starts] for a, k in zip(AXES, keys, strict=True)}
        return pd.DataFrame(found | {"label": pd.Series(out, dtype=object if any(x is None or x is pd.NA for x in out) else None)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the beginning of the last block
        for pdf in batches:
            if not len(pdf):
                continue
            if held and all(pdf[c].iat[-1] == held[0][c].iat[0] for c in sides):
                held.append(pdf)
                continue
            rows = pd.concat([*held, pdf], ignore_index=True)
            turns = np.zeros(len(rows), bool)
            turns[0] = True
            for c in sides:
                v = rows[c].to_numpy()
                turns[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(turns)
            if len(starts) > 1:
                yield reduced(rows, starts[:-1], starts[-1])
            held = [rows.iloc[starts[-1] :]]
        if held:
            rows = pd.concat(held, ignore_index=True)
            yield reduced(rows, np.array([0]), len(rows))

    kind = result if isinstance(result, str) else result.simpleString()
    return ordered.mapInPandas(run, f"z int, y int, x int, label {kind}")


METHODS: dict[str, Callable[[DataFrame, Factor], DataFrame]] = {
    "subsample": subsample,
    "block-mean": lambda v, f: block_mean(v, f, "label", whole=True),
    "mode": lambda v, f: block_mode(v, f, ignore_zero=False),
    "labels": block_mode,
    "binary": binary_mode,
}


def downsample(voxels: DataFrame, factor: Factor, method: str = "labels") -> DataFrame:
    return METHODS[method](voxels, factor)


def upsample(voxels: DataFrame, factor: Factor) -> DataFrame:
    """Each voxel as a block."""
    out = voxels
    for a, f in zip(AXES, factor, strict=True):
        out = out.withColumn(a, F.explode(F.sequence(F.col(a) * f, F.col(a) * f + (f - 1))))
    return out


def pyramid(voxels: DataFrame, scales: int, method: str = "labels", factor: Factor = (2, 2, 2)) -> DataFrame:
    """Scales 0 to `scales` with a column scale; each is made from the one before, which is cut so that it is made once."""
    from gridloom.operators.lineage import cut

    level = voxels.select(*AXES, "label")
    out = level.withColumn("scale", F.lit(0))
    for s in range(1, scales + 1):
        level = cut(downsample(level, factor, method))
        out = out.unionByName(level.withColumn("scale", F.lit(s)))
    return out


def depth(box: Box, largest: int = 512) -> int:
    """Halvings until no side is longer than so much."""
    side, n = max(b - a for a, b in zip(*box, strict=True)), 0
    while side > largest:
        side, n = -(-side // 2), n + 1
    return n


def at_scale(stored: DataFrame, scale: int, available: list[int], method: str = "labels") -> DataFrame:
    """The stored scale that is nearest below the wanted one, or else above, brought to it."""
    below = [s for s in available if s <= scale]
    base = max(below) if below else min(available)
    rows = stored.where(F.col("scale") == base).drop("scale")
    n = 2 ** abs(scale - base)
    return rows if n == 1 else downsample(rows, (n, n, n), method) if base < scale else upsample(rows, (n, n, n))


def destripe(slices: DataFrame, value: str = "value") -> DataFrame:
    """Each slice's rows (lines of y) scaled to the slice's mean, which takes out stripes; sums are by slice and line, no slice is gathered."""
    line = slices.groupBy(F.col("z").alias("_z"), F.col("y").alias("_y")).agg(F.avg(value).alias("_line"))
    whole = slices.groupBy(F.col("z").alias("_z2")).agg(F.avg(value).alias("_slice"))
    joined = slices.join(line, (F.col("z") == F.col("_z")) & (F.col("y") == F.col("_y"))).join(whole, F.col("z") == F.col("_z2"))
    return joined.withColumn(value, F.when(F.col("_line") != 0, F.col(value) * F.col("_slice") / F.col("_line")).otherwise(F.col(value))).select(*slices.columns)
