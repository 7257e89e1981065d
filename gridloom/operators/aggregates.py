"""Counts, sizes, statistics and label indexes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES, block_id
from gridloom.operators.grid import Grid


def contingency_table(pairs: DataFrame, left: str = "left", right: str = "right", by: tuple[str, ...] = ()) -> DataFrame:
    """Rows for each pair of labels, by brick if asked; background is a label like others here."""
    return pairs.groupBy(*by, F.col(left).alias("left"), F.col(right).alias("right")).agg(F.count("*").alias("voxel_count"))


def overlay(left: DataFrame, right: DataFrame) -> DataFrame:
    """(z, y, x, left, right) of two voxel tables, 0 where only one has a voxel."""
    a = left.select(*AXES, F.col("label").alias("left"))
    b = right.select(*AXES, F.col("label").alias("right"))
    return a.join(b, list(AXES), "full_outer").fillna(0, ["left", "right"])


def filtered_contingency(counts: DataFrame, subset: DataFrame | None = None, min_overlap: int = 0, by: tuple[str, ...] = ("brick",)) -> DataFrame:
    """Counts by brick, subset and threshold applied in each brick as `by` says (() for the whole), then summed.

    A subset keeps rows whose left label is in it, and rows whose right label occurs with such a left one in the same brick."""
    if not by:
        counts = counts.groupBy("left", "right").agg(F.sum("voxel_count").alias("voxel_count"))
    if subset is not None:
        wanted = subset.select(F.col("label").alias("left")).distinct()
        hit = counts.join(wanted, "left", "left_semi")
        counts = counts.join(hit.select(*by, "right").distinct(), [*by, "right"], "left_semi").unionByName(hit.where(F.col("right").isNull()))
    counts = counts.where(F.col("voxel_count") >= min_overlap)
    return counts.groupBy("left", "right").agg(F.sum("voxel_count").alias("voxel_count"))


def side_sizes(counts: DataFrame, side: str) -> DataFrame:
    return counts.groupBy(side).agg(F.sum("voxel_count").alias("voxel_count"))


def label_histogram(voxels: DataFrame, by: list[Column | str], label: str = "label", subset: DataFrame | None = None) -> DataFrame:
    """Count of each label but background in each brick."""
    rows = voxels.where(F.col(label) != 0)
    if subset is not None:
        rows = rows.join(subset.select(F.col("label").alias(label)).distinct(), label, "left_semi")
    return rows.groupBy(*by, label).agg(F.count("*").alias("count"))


def block_statistics(voxels: DataFrame, block: int = 64, mapping: DataFrame | None = None) -> DataFrame:
    """(body_id, segment_id, z, y, x, count): voxels of each segment in each block, named by the block's corner."""
    grid = Grid((block, block, block))
    counts = voxels.where("label <> 0").groupBy(F.col("label").alias("segment_id"), *(grid.corner(i).cast("int").alias(a) for i, a in enumerate(AXES))).agg(F.count("*").alias("count"))
    counts = counts.withColumn("body_id", F.col("segment_id"))
    if mapping is not None:
        from gridloom.operators.labelmap import map_labels

        counts = map_labels(counts, mapping, "body_id")
    return counts.select("body_id", "segment_id", *AXES, "count")


def add_totals(counts: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Each row with the sum of `value` over its key; the sum is made once for each key and joined, so a hot key spreads over tasks."""
    totals = counts.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name))
    return counts.join(totals, F.col(key) == F.col("_key")).drop("_key")


def body_stats(counts: DataFrame) -> DataFrame:
    """(sv, body, sv_size, body_size) from counts of supervoxels in bricks (sv, body, count)."""
    svs = counts.groupBy("sv", "body").agg(F.sum("count").alias("sv_size"))
    return add_totals(svs, "body", "sv_size", "body_size")


def distribute_lists(counts: DataFrame, key: str, item: str, most: int) -> DataFrame:
    """(key, chunk, items): each brick's labels in sorted lists of at most `most`; numbered by ranges, so a key with many items is in many tasks."""
    from gridloom.operators.numbering import number_rows

    ranked = number_rows(counts.select(key, item), [key, item], "_n")
    first = ranked.groupBy(F.col(key).alias("_k")).agg(F.min("_n").alias("_first"))
    ranked = ranked.join(first, F.col(key).eqNullSafe(F.col("_k")))
    return ranked.withColumn("chunk", F.call_function("div", F.col("_n") - F.col("_first"), F.lit(most)).cast("int")).groupBy(key, "chunk").agg(F.array_sort(F.collect_list(item)).alias("items"))


def segment_stats(voxels: DataFrame, block: int = 64) -> DataFrame:
    """Count, half-open box and number of blocks of each label."""
    rows = voxels.where("label <> 0")
    box = [x for a in AXES for x in (F.min(a).alias(f"{a}0"), (F.max(a) + 1).alias(f"{a}1"))]
    blocks = rows.select("label", block_id("z", "y", "x", block).alias("_b")).distinct().groupBy("label").agg(F.count("*").alias("n_blocks"))
    return rows.groupBy("label").agg(F.count("*").alias("count"), *box).join(blocks, "label")


def merge_stats(parts: DataFrame, key: str = "label") -> DataFrame:
    """Partial segment statistics (count, boxes, block lists) merged: sums, least starts, greatest stops, sorted lists."""
    box = [x for a in AXES for x in (F.min(f"{a}0").alias(f"{a}0"), F.max(f"{a}1").alias(f"{a}1"))]
    lists = [F.array_sort(F.flatten(F.collect_list("blocks"))).alias("blocks")] if "blocks" in parts.columns else []
    return parts.groupBy(key).agg(F.sum("count").alias("count"), *box, *lists)


def label_index(stats: DataFrame, block: int = 64) -> DataFrame:
    """(body_id, blocks): a map from block id to a map from segment to count. A body's index is one row, as its readers need."""
    cells = stats.groupBy("body_id", block_id("z", "y", "x", block).alias("block"), "segment_id").agg(F.sum("count").alias("count"))
    inner = cells.groupBy("body_id", "block").agg(F.array_sort(F.collect_list(F.struct("segment_id", "count"))).alias("s"))
    outer = inner.groupBy("body_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("block", "s")))).alias("_b"))
    return outer.select("body_id", F.transform_values("_b", lambda _, v: F.map_from_entries(v)).alias("blocks"))


def unnest_index(index: DataFrame) -> DataFrame:
    """(body_id, block, segment_id, count) of a label index."""
    blocks = index.select("body_id", F.explode("blocks").alias("block", "segments"))
    return blocks.select("body_id", "block", F.explode("segments").alias("segment_id", "count"))


def roi_stats(voxels: DataFrame, body: str = "body", roi: str = "roi_id", names: DataFrame | None = None) -> DataFrame:
    """(body, roi_id, voxels, roi): voxels of each body in each region; region 0 is `<none>`."""
    counts = voxels.where(F.col(body) != 0).groupBy(F.col(body).alias("body"), F.col(roi).alias("roi_id")).agg(F.count("*").alias("voxels"))
    if names is None:
        return counts
    return counts.join(names.select("roi_id", "roi"), "roi_id", "left").select("body", "roi_id", "voxels", F.coalesce("roi", F.lit("<none>")).alias("roi"))


# Moments.


def partial_moments(rows: DataFrame, keys: list[str], dims: list[str]) -> DataFrame:
    """n, means m_i and population covariances c_ij of each key. Centred aggregates, so large coordinates lose nothing."""
    means = [F.avg(d).alias(f"m_{d}") for d in dims]
    cov = [F.covar_pop(a, b).alias(f"c_{a}{b}") for i, a in enumerate(dims) for b in dims[i:]]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *means, *cov)


def merge_moments(parts: DataFrame, keys: list[str], dims: list[str]) -> DataFrame:
    """Moments of unions: covariances of the parts and of their means about the common mean, by weight."""
    total = parts.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.sum("n").alias("_n"), *((F.sum(F.col("n") * F.col(f"m_{d}")) / F.sum("n")).alias(f"_m_{d}") for d in dims))
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = parts.join(total, on)
    cov = [(F.sum(F.col("n") * (F.col(f"c_{a}{b}") + (F.col(f"m_{a}") - F.col(f"_m_{a}")) * (F.col(f"m_{b}") - F.col(f"_m_{b}")))) / F.sum("n")).alias(f"c_{a}{b}") for i, a in enumerate(dims) for b in dims[i:]]
    return joined.groupBy(*keys).agg(F.sum("n").alias("n"), *((F.sum(F.col("n") * F.col(f"m_{d}")) / F.sum("n")).alias(f"m_{d}") for d in dims), *cov)


def radii(moments: DataFrame, dims: tuple[str, ...] = AXES) -> DataFrame:
    """Moments with pca_i, the roots of the covariance's eigenvalues, largest first, and r_i, the half axes of the solid ellipsoid with that covariance."""
    names = [f"{p}_{i}" for p in ("pca", "r") for i in range(len(dims))]

    def run(batches):
        for pdf in batches:
            c = np.empty((len(pdf), len(dims), len(dims)))
            for i, a in enumerate(dims):
                for j, b in enumerate(dims):
                    c[:, i, j] = pdf[f"c_{a}{b}" if i <= j else f"c_{b}{a}"]
            root = np.sqrt(np.clip(np.linalg.eigvalsh(c), 0, None))[:, ::-1] if len(pdf) else np.empty((0, len(dims)))
            out = pdf.copy()
            for i in range(len(dims)):
                out[f"pca_{i}"], out[f"r_{i}"] = root[:, i], root[:, i] * np.sqrt(len(dims) + 2)
            yield out

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in moments.schema] + [f"{n} double" for n in names])
    return moments.mapInPandas(run, schema)


def object_stats(voxels: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """n, centroid and covariance of each label, and with a class volume its voxels in each class as a map."""
    rows = voxels.where("label <> 0")
    out = partial_moments(rows, ["label"], list(AXES))
    if classes is None:
        return out
    c = classes.select(*AXES, F.col("label").alias("_class"))
    counts = rows.join(c, list(AXES)).where("_class <> 0").groupBy("label", "_class").agg(F.count("*").alias("_n"))
    maps = counts.groupBy("label").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_class", "_n")))).alias("classes"))
    return out.join(maps, "label", "left")


def combine_overlaps(tables: list[DataFrame]) -> DataFrame:
    """Overlap tables (body1, body2, overlap) added up."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy("body1", "body2").agg(F.sum("overlap").alias("overlap"))


def remap_overlaps(table: DataFrame, map1: DataFrame | None = None, map2: DataFrame | None = None) -> DataFrame:
    from gridloom.operators.labelmap import map_labels

    for column, mapping in (("body1", map1), ("body2", map2)):
        if mapping is not None:
            table = map_labels(table, mapping, column)
    return combine_overlaps([table])


def throughput(runs: DataFrame) -> DataFrame:
    """Summary of requests (start_s, seconds, blocks): counts, means and wall time."""
    return runs.agg(F.count("*").alias("requests"), F.sum("blocks").alias("blocks"), F.avg("blocks").alias("blocks_per_request"), F.avg("seconds").alias("seconds_per_request"), (F.sum("seconds") / F.sum("blocks")).alias("seconds_per_block"), (F.max(F.col("start_s") + F.col("seconds")) - F.min("start_s")).alias("wall_s"))


def per_block_mode(pdf: pd.DataFrame) -> int | None:
    """A scalar reducer for grouped use: the most frequent label, the smallest at a tie; null if all are null."""
    labels = pdf["label"].to_numpy()
    labels, n = np.unique(labels if labels.dtype.kind in "iu" else labels[~pd.isna(labels)], return_counts=True)
    return int(labels[n.argmax()]) if len(labels) else None


def adaptive_factor(size: Column, limit: int, least: int = 1) -> Column:
    """Downsample factor of a box of so many voxels: 1 + the cube root of how often it exceeds the limit, at least the configured one."""
    return F.greatest(F.lit(least), (1 + F.floor(F.pow(size / F.lit(limit), F.lit(1 / 3)))).cast("int"))
