"""Jobs: a name, options with defaults, and a plan that makes named results. `run_job` finds one by name or dotted path."""

from __future__ import annotations

import importlib
from typing import Any, ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators import aggregates, diffs, edges, filters, geometry, labelmap, metrics, ranking, resample, volume_components
from gridloom.operators.grid import Grid, cells_of_labels
from gridloom.operators.lineage import cut
from gridloom.operators.numbering import number_rows
from gridloom.sources.volumes import open_volume

JOBS: dict[str, type[Job]] = {}


class Job:
    """A subclass names its options with their defaults (... for those that must be given) and makes its results in `plan`."""

    options: ClassVar[dict[str, Any]] = {}

    def __init_subclass__(cls) -> None:
        JOBS[cls.__name__.lower()] = cls

    def __init__(self, spark: SparkSession, config: dict):
        unknown = set(config) - set(self.options)
        missing = [k for k, v in self.options.items() if v is ... and k not in config]
        if unknown or missing:
            raise ValueError(f"unknown options {sorted(unknown)}, missing options {missing}")
        self.spark, self.config = spark, {**self.options, **config}

    def __getitem__(self, key: str) -> Any:
        return self.config[key]

    def volume(self, key: str) -> DataFrame:
        """A volume option: voxels, or a configuration to open."""
        v = self[key]
        return v if isinstance(v, DataFrame) else open_volume(self.spark, v)

    def table(self, key: str) -> DataFrame | None:
        v = self[key]
        return v if v is None or isinstance(v, DataFrame) else self.spark.createDataFrame([(x,) for x in v], "label long")

    def plan(self) -> dict[str, DataFrame]:
        raise NotImplementedError


def find_job(name: str) -> type[Job]:
    if name.lower() in JOBS:
        return JOBS[name.lower()]
    module, _, cls = name.rpartition(".")
    if not module:
        raise ValueError(f"no job {name}; there are {sorted(JOBS)}")
    return getattr(importlib.import_module(module), cls)


def run_job(spark: SparkSession, name: str, config: dict) -> dict[str, DataFrame]:
    return find_job(name)(spark, config).plan()


def _grid(shape) -> Grid:
    return Grid(tuple(shape))


class ContingencyTable(Job):
    options: ClassVar = {"left": ..., "right": ..., "block-shape": (64, 64, 64), "left-subset-labels": None, "min-overlap-size": 0, "scope": "brick"}

    def plan(self):
        pairs = aggregates.overlay(self.volume("left"), self.volume("right"))
        by = ("bz", "by", "bx") if self["scope"] == "brick" else ()
        keyed = pairs.select("left", "right", *_grid(self["block-shape"]).cells())
        table = aggregates.filtered_contingency(aggregates.contingency_table(keyed, by=by), self.table("left-subset-labels"), self["min-overlap-size"], by)
        return {"table": table, "left_sizes": aggregates.side_sizes(table, "left"), "right_sizes": aggregates.side_sizes(table, "right")}


class ContingentRelabel(Job):
    options: ClassVar = {"primary": ..., "contingency": ..., "mapping": None}

    def plan(self):
        pairs = aggregates.overlay(self.volume("primary"), self.volume("contingency"))
        mapping = self["mapping"] or labelmap.contingent_mapping(aggregates.contingency_table(pairs))
        final = labelmap.contingent_relabel(pairs, mapping).select(*AXES, F.col("final").alias("label")).where("label <> 0")
        return {"voxels": final, "mapping": mapping}


class ConnectedComponents(Job):
    options: ClassVar = {"input": ..., "block-shape": (64, 64, 64), "subset-labels": None, "next-label": None, "connectivity": 1}

    def plan(self):
        voxels = volume_components.relabel_components(self.volume("input"), _grid(self["block-shape"]), self["connectivity"], self["next-label"], self.table("subset-labels"))
        return {"voxels": voxels, "block_stats": aggregates.block_statistics(voxels)}


class FindAdjacencies(Job):
    options: ClassVar = {"input": ..., "label-groups": None, "find-closest-within": 0}

    def plan(self):
        voxels, groups = self.volume("input"), self["label-groups"]
        touching = edges.adjacency(voxels)
        if groups is None:
            every = voxels.where("label <> 0").select("label", F.lit(1).alias("group")).distinct()
        else:
            every = groups if isinstance(groups, DataFrame) else self.spark.createDataFrame(groups, "label long, group long")
        direct = edges.intra_group(touching, every)
        out = {"edges": direct}
        if self["find-closest-within"]:
            near = edges.near_pairs(voxels, self["find-closest-within"], None if groups is None else every)
            apart = near.join(direct.select(*edges.PAIR), edges.PAIR, "left_anti")
            out["nearby"] = edges.closest_approaches(voxels, apart, self["find-closest-within"])
        grouped = edges.append_groups(direct, every)
        out["grouped"] = edges.append_group_components(grouped, every)
        return out


class SamplePoints(Job):
    options: ClassVar = {"input": ..., "points": ..., "output-column": "label"}

    def plan(self):
        return {"points": edges.sample_labels(self["points"], self.volume("input"), self["output-column"])}


class SparseBlockstats(Job):
    options: ClassVar = {"input": ..., "mask": ..., "mask-labels": None, "block-shape": (64, 64, 64)}

    def plan(self):
        grid = _grid(self["block-shape"])
        mask = self.volume("mask").where("label <> 0")
        if self["mask-labels"] is not None:
            mask = mask.join(self.table("mask-labels"), "label", "left_semi")
        cells = mask.select(*grid.cells()).distinct()
        pruned = self.volume("input").select("*", *grid.cells()).join(cells, ["bz", "by", "bx"], "left_semi")
        return {"block_stats": aggregates.block_statistics(pruned, self["block-shape"][0])}


class RoiStats(Job):
    options: ClassVar = {"input": ..., "roi": ..., "roi-names": None, "n": 3}

    def plan(self):
        roi = self.volume("roi").select(*AXES, F.col("label").alias("roi_id"))
        both = self.volume("input").where("label <> 0").join(roi, list(AXES), "left").fillna(0, ["roi_id"])
        stats = aggregates.roi_stats(both, "label", "roi_id", self["roi-names"])
        out = {"stats": stats}
        if self["roi-names"] is not None:
            out["table"] = ranking.roi_table(stats, self["n"])
        return out


class MitoStats(Job):
    options: ClassVar = {"input": ..., "classes": None, "min-size": 0}

    def plan(self):
        classes = None if self["classes"] is None else self.volume("classes")
        stats = aggregates.object_stats(self.volume("input"), classes).where(F.col("n") >= self["min-size"])
        maps = stats.select("label", *(["classes"] if classes is not None else []))
        return {"stats": aggregates.radii(stats.drop("classes")).join(maps, "label")}


class MitoRepair(Job):
    """For each object the hull with the largest summed overlap."""

    options: ClassVar = {"objects": ..., "hulls": ...}

    def plan(self):
        pairs = aggregates.overlay(self.volume("objects"), self.volume("hulls")).where("left <> 0 and right <> 0")
        counts = aggregates.contingency_table(pairs)
        return {"assignments": ranking.best_overlap(counts, "left", "right", "voxel_count")}


class MitoDistances(Job):
    options: ClassVar = {"points": ..., "targets": ..., "by": "body", "radius": 1000}

    def plan(self):
        return {"distances": geometry.nearest_points(self["points"], self["targets"], self["by"], self["radius"])}


class CopySegmentation(Job):
    options: ClassVar = {"input": ..., "output": None, "block-shape": (64, 64, 64), "pyramid-depth": 0, "method": "labels", "add-offset": 0, "input-mask-labels": None, "output-mask-labels": None, "skip-identical": False}

    def plan(self):
        new, old = self.volume("input"), None if self["output"] is None else self.volume("output")
        if self["add-offset"]:
            new = new.withColumn("label", labelmap.add_offset("label", self["add-offset"]))
        if old is not None and (self["input-mask-labels"] or self["output-mask-labels"]):
            new = filters.combine_with_output(new, old, self.table("input-mask-labels"), self.table("output-mask-labels"))
        if old is not None and self["skip-identical"]:
            new = diffs.changed_blocks(new, old, _grid(self["block-shape"]))
        return {"voxels": resample.pyramid(new, self["pyramid-depth"], self["method"]), "block_stats": aggregates.block_statistics(new)}


class CopyGrayscale(Job):
    options: ClassVar = {"input": ..., "pyramid-depth": 0, "contrast": "none"}

    def plan(self):
        rows = self.volume("input")
        if self["contrast"] == "hotknife-destripe":
            rows = resample.destripe(rows, "label")
        elif self["contrast"] != "none":
            raise ValueError("contrast is none or hotknife-destripe")
        return {"voxels": resample.pyramid(rows, self["pyramid-depth"], "block-mean")}


class LabelmapCopy(Job):
    options: ClassVar = {"input": ..., "output": ..., "block-shape": (64, 64, 64)}

    def plan(self):
        new, old = self.volume("input"), self.volume("output")
        return {"voxels": diffs.changed_blocks(new, old, _grid(self["block-shape"])), "new_labels": diffs.new_labels(new, old)}


class MaskedCopy(Job):
    options: ClassVar = {"input": ..., "mask": ..., "block-shape": (64, 64, 64)}

    def plan(self):
        mask = self.volume("mask")
        return {"voxels": filters.under_mask(self.volume("input"), mask), "mask_counts": filters.mask_counts(mask, _grid(self["block-shape"]))}


class MaskSegmentation(Job):
    options: ClassVar = {"input": ..., "mask": ..., "dilate": 0, "invert": False, "bounding-box": None}

    def plan(self):
        mask = self.volume("mask").where("label <> 0")
        at = filters.dilate(mask, self["dilate"]) if self["dilate"] > 0 else filters.erode(mask, self["bounding-box"], -self["dilate"]) if self["dilate"] < 0 else mask.select(*AXES)
        if self["invert"]:
            at = filters.complement(at, self["bounding-box"])
        kept, erased = filters.erase_under(self.volume("input"), at.withColumn("label", F.lit(1)))
        return {"voxels": kept, "erased_stats": erased}


class CreatePyramid(Job):
    options: ClassVar = {"input": ..., "pyramid-depth": 1, "method": "labels"}

    def plan(self):
        return {"voxels": resample.pyramid(self.volume("input"), self["pyramid-depth"], self["method"])}


class CreateTiles(Job):
    """2-D tiles of slices at halved scales: (scale, z, ty, tx, y, x, label)."""

    options: ClassVar = {"input": ..., "tile": 512, "depth": 1}

    def plan(self):
        rows = resample.pyramid(self.volume("input"), self["depth"], "block-mean", (1, 2, 2))
        t = self["tile"]
        grid = Grid((1, t, t))
        return {"tiles": rows.select("scale", "z", grid.cell(1).alias("ty"), grid.cell(2).alias("tx"), F.pmod("y", F.lit(t)).alias("y"), F.pmod("x", F.lit(t)).alias("x"), "label")}


class CreateMeshes(Job):
    options: ClassVar = {"input": ..., "size-range": (1, 2**62), "subset-labels": None}

    def plan(self):
        voxels = self.volume("input").where("label <> 0")
        counts = voxels.groupBy(F.col("label").alias("sv")).agg(F.count("*").alias("count")).withColumn("body", F.col("sv"))
        subset = self.table("subset-labels")
        chosen = filters.size_filter(counts, self["size-range"], (1, 2**62), None if subset is None else subset.withColumnRenamed("label", "sv"))
        kept = voxels.join(chosen.select(F.col("sv").alias("label")), "label", "left_semi")
        return {"meshes": geometry.per_object(kept, geometry.mesh_bytes), "sizes": chosen}


class GridMeshes(Job):
    """Meshes of each label in each grid cell."""

    options: ClassVar = {"input": ..., "block-shape": (64, 64, 64)}

    def plan(self):
        grid = _grid(self["block-shape"])
        voxels = self.volume("input").where("label <> 0")
        keys = ["label", "bz", "by", "bx"]
        names = cut(number_rows(voxels.select("label", *grid.cells()).distinct(), keys, "part", 1))
        keyed = voxels.select(*AXES, "label", *grid.cells()).join(names, keys).select(*AXES, F.col("part").alias("label"))
        meshes = geometry.per_object(keyed, geometry.mesh_bytes).withColumnRenamed("label", "part")
        return {"meshes": names.join(meshes, "part").drop("part"), "stats": aggregates.label_histogram(voxels, grid.cells())}


class StitchedMeshes(Job):
    """Meshes of grid cells put together by label."""

    options: ClassVar = {"input": ..., "block-shape": (64, 64, 64)}

    def plan(self):
        parts = GridMeshes(self.spark, self.config).plan()["meshes"]
        return {"meshes": geometry.combine_meshes(parts.where("status = 'ok'").select("label", "result"))}


class EvaluateSeg(Job):
    options: ClassVar = {"ground-truth": ..., "segmentation": ..., "important-bodies": None, "min-gt-size": 0}

    def plan(self):
        pairs = aggregates.overlay(self.volume("ground-truth"), self.volume("segmentation")).where("left <> 0 and right <> 0")
        if self["important-bodies"] is not None:
            pairs = pairs.join(self.table("important-bodies").withColumnRenamed("label", "left"), "left", "left_semi")
        overlaps = aggregates.contingency_table(pairs).select(F.col("left").alias("gt"), F.col("right").alias("seg"), F.col("voxel_count").alias("overlap"))
        return {"vi": metrics.variation_of_information(overlaps, least_gt=self["min-gt-size"]), "rand": metrics.rand(overlaps), "edits": metrics.edits_to_reach(overlaps), "matches": metrics.best_match(overlaps), "body_vi": metrics.body_vi(overlaps)}


class ComputeGraph(Job):
    """Vertices with sizes and edges with contact areas."""

    options: ClassVar = {"input": ...}

    def plan(self):
        voxels = self.volume("input").where("label <> 0")
        vertices = voxels.groupBy(F.col("label").alias("vertex")).agg(F.count("*").alias("weight"))
        return {"vertices": vertices, "edges": edges.adjacency(voxels).groupBy(*edges.PAIR).agg(F.count("*").alias("weight"))}


class IngestLabelIndices(Job):
    options: ClassVar = {"block-stats": ..., "mapping": None}

    def plan(self):
        stats = self["block-stats"]
        if self["mapping"] is not None:
            stats = labelmap.overwrite_body(stats, self["mapping"])
        return {"index": aggregates.label_index(stats)}


class CheckSegmentation(Job):
    """(body, block) pairs of the volume against those of an index."""

    options: ClassVar = {"input": ..., "index": ..., "block-shape": (64, 64, 64)}

    def plan(self):
        stats = aggregates.block_statistics(self.volume("input"), self["block-shape"][0])
        return {"errors": diffs.consistency(stats, self["index"], ["body_id", *AXES])}


class SparseMeshes(Job):
    """Meshes of listed labels, whose voxels are found by an index first."""

    options: ClassVar = {"input": ..., "index": ..., "labels": ..., "block-shape": (64, 64, 64)}

    def plan(self):
        grid = _grid(self["block-shape"])
        cells = cells_of_labels(self["index"], self.table("labels"), grid)
        voxels = self.volume("input").select("*", *(grid.corner(i).alias(f"c{a}") for i, a in enumerate(AXES)))
        near = cells.select(F.col("label").alias("_l"), *(F.col(a).alias(f"_{a}") for a in AXES))
        on = F.col("label") == F.col("_l")
        for a in AXES:
            on &= F.col(f"c{a}") == F.col(f"_{a}")
        return {"meshes": geometry.per_object(voxels.join(near, on, "left_semi").select(*AXES, "label"), geometry.mesh_bytes)}


class ExportSlices(Job):
    options: ClassVar = {"input": ..., "folder": ..., "format": "{:05d}.pgm", "height": ..., "width": ...}

    def plan(self):
        from gridloom.sources.chunks import write_slices

        write_slices(self.volume("input"), self["folder"], self["format"], self["height"], self["width"])
        return {}
