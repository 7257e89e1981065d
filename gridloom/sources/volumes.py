"""Volumes by configuration: one format, then views in a fixed order; and Spark data sources for them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridloom.functions.arithmetic import AXES, default_entries
from gridloom.operators.edges import POINTS
from gridloom.operators.grid import Box, Grid, from_bricks, to_bricks, translate, transpose, within
from gridloom.operators.labelmap import map_labels
from gridloom.operators.resample import at_scale
from gridloom.sources import chunks
from gridloom.sources.precomputed import read_precomputed
from gridloom.sources.tables import labelmap

#: The order in which views are made; configurations list them so.
VIEWS = ("apply-labelmap", "transpose-axes", "translate", "rescale-level")


def _offline(name: str) -> Callable[[SparkSession, dict], DataFrame]:
    def read(spark: SparkSession, options: dict) -> DataFrame:
        raise NotImplementedError(f"{name} needs a client library and a network, which this build hasn't")

    return read


def _parquet(spark: SparkSession, o: dict) -> DataFrame:
    rows = spark.read.parquet(o["path"])
    return rows.where(F.col("scale") == o.get("scale", 0)).drop("scale") if "scale" in rows.columns and "scale" in o else rows


def _array(spark: SparkSession, o: dict) -> DataFrame:
    """A volume by {"spec": {"driver", "kvstore", "scale_index"}}, as TensorStore names it."""
    spec = o["spec"]
    store = spec["kvstore"]
    if isinstance(store, dict):
        before = {"file": "", "gcs": f"gs://{store.get('bucket')}/", "s3": f"s3a://{store.get('bucket')}/"}.get(store["driver"])
        if before is None:
            raise NotImplementedError(f"no reader for the store {store['driver']}")
        store = before + store["path"]
    elif store.startswith(("s3://", "file://")):
        store = store.replace("s3://", "s3a://", 1).replace("file://", "file:", 1)
    path, box, bounds = store.rstrip("/"), o.get("box"), o.get("out-of-bounds-access", "forbid")
    folder, _, dataset = path.rpartition("/")
    if spec["driver"] == "neuroglancer_precomputed":
        return read_precomputed(spark, path, o.get("scale", spec.get("scale_index", 0)), box, bounds)
    if spec["driver"] == "zarr":
        return chunks.read_zarr(spark, folder, dataset, box, bounds)
    if spec["driver"] == "n5":
        return chunks.read_n5(spark, folder, dataset, box)
    raise NotImplementedError(f"no reader for the driver {spec['driver']}")


#: Schemes of viewers' URLs and the drivers that read them.
DRIVERS = {"precomputed": "neuroglancer_precomputed", "zarr": "zarr", "zarr2": "zarr", "n5": "n5"}


def from_url(spark: SparkSession, url: str, scale: int = 0, box: Box | None = None) -> DataFrame:
    """Voxels of a viewer's source, such as precomputed://gs://bucket/folder or n5://file:///folder/dataset; Spark must be able to read what the address names."""
    scheme, _, store = url.partition("://")
    if scheme not in DRIVERS or not store:
        raise ValueError(f"a source starts with one of {sorted(DRIVERS)}")
    return _array(spark, {"spec": {"driver": DRIVERS[scheme], "kvstore": store}, "scale": scale, "box": box})


FORMATS: dict[str, Callable[[SparkSession, dict], DataFrame]] = {
    "parquet": _parquet,
    "bricks": lambda s, o: from_bricks(s.read.parquet(o["path"]), tuple(o["block-shape"])),
    "n5": lambda s, o: chunks.read_n5(s, o["path"], o["dataset"], o.get("box")),
    "zarr": lambda s, o: chunks.read_zarr(s, o["path"], o["dataset"], o.get("box"), o.get("out-of-bounds-access", "forbid"), tuple(o.get("global-offset", (0, 0, 0)))),
    "precomputed": lambda s, o: read_precomputed(s, o["path"], o.get("scale", 0), o.get("box"), o.get("out-of-bounds-access", "forbid")),
    "tensorstore": _array,
    "slice-files": lambda s, o: chunks.read_slices(s, o["slice-path-format"]),
    "npy": lambda s, o: (s.dataSource.register(NpyVolume), s.read.format("npy_volume").options(**{k: str(v) for k, v in o.items()}).load())[1],
    **{name: _offline(name) for name in ("hdf5", "dvid", "boss", "brainmaps")},
}


def open_volume(spark: SparkSession, config: dict) -> DataFrame:
    """Voxels of a volume: {format: options, "geometry": {"bounding-box": box}, "adapters": {view: options}}."""
    named = [k for k in config if k in FORMATS]
    if len(named) != 1:
        raise ValueError(f"exactly one format of {sorted(FORMATS)} must be given")
    voxels = FORMATS[named[0]](spark, config[named[0]])
    box = config.get("geometry", {}).get("bounding-box")
    if box is not None:
        voxels = clip(voxels, box)
    views = config.get("adapters", {})
    if list(views) != [v for v in VIEWS if v in views]:
        raise ValueError(f"views are made in the order {VIEWS}")
    for name, options in views.items():
        voxels = voxels.transform(_view(spark, name, options, box))
    return voxels


def clip(voxels: DataFrame, box: Box) -> DataFrame:
    """Inside a box; -1 in the box means the volume's own bound."""
    if any(c == -1 for side in box for c in side):
        own = voxels.agg(*(F.min(a) for a in AXES), *(F.max(a) + 1 for a in AXES)).first()
        box = tuple(default_entries(list(box[0]), list(own[:3]))), tuple(default_entries(list(box[1]), list(own[3:])))
    return voxels.where(within(box))


def _view(spark: SparkSession, name: str, o, box: Box | None) -> Callable[[DataFrame], DataFrame]:
    if name == "apply-labelmap":
        mapping = labelmap(spark, o["file"], o.get("file-type", "label-to-body"))
        return lambda v: map_labels(v, mapping, missing=o.get("missing-value-mode", "identity"))
    if name == "transpose-axes":
        if box is None:
            raise ValueError("turning axes needs a bounding box")
        return lambda v: transpose(v, tuple(o), box)
    if name == "translate":
        return lambda v: translate(v, tuple(o))
    level, method = (o["level"], o.get("method") or "labels") if isinstance(o, dict) else (o, "labels")
    return lambda v: at_scale(v.withColumn("scale", F.lit(0)), level, [0], method) if level else v


class _Box(InputPartition):
    def __init__(self, start: tuple[int, int, int], stop: tuple[int, int, int]):
        super().__init__((start, stop))


class NpyVolume(DataSource):
    """A volume in a .npy file on a folder that all executors mount, read in bricks by memory map."""

    @classmethod
    def name(cls) -> str:
        return "npy_volume"

    def schema(self) -> str:
        return "z int, y int, x int, label long"

    def reader(self, schema) -> DataSourceReader:
        return _NpyReader(self.options)


class _NpyReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.block = options["path"], int(options.get("block", 64))

    def partitions(self):
        shape = np.load(self.path, mmap_mode="r").shape
        starts = [range(0, n, self.block) for n in shape]
        return [_Box((z, y, x), tuple(min(c + self.block, n) for c, n in zip((z, y, x), shape, strict=True))) for z in starts[0] for y in starts[1] for x in starts[2]]

    def read(self, partition):
        start, stop = partition.value
        block = np.load(self.path, mmap_mode="r")[tuple(map(slice, start, stop))]
        for at in zip(*np.nonzero(block), strict=True):
            yield (*(int(i + s) for i, s in zip(at, start, strict=True)), int(block[at]))


def write_voxels(voxels: DataFrame, path: str, grid: Grid, scale: int = 0, mode: str = "overwrite") -> None:
    """Parquet by scale and cell; only the cells that are written are replaced."""
    keyed = voxels.select("*", F.lit(scale).alias("scale"), *grid.cells())
    keyed.repartition("scale", "bz", "by", "bx").sortWithinPartitions(*AXES).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("scale", "bz", "by", "bx").parquet(path)


def write_bricks(voxels: DataFrame, path: str, grid: Grid, dtype: str = "uint64") -> None:
    to_bricks(voxels, grid, dtype).write.mode("overwrite").option("compression", "zstd").parquet(path)


def append_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("append").parquet(path)


def write_label_index(index: DataFrame, path: str, mutation: int, user: str) -> None:
    """Indexes stamped with the mutation, in ranges of bodies."""
    stamped = index.withColumns({"last_mutid": F.lit(mutation).cast("long"), "last_mod_user": F.lit(user)})
    stamped.repartitionByRange("body_id").sortWithinPartitions("body_id").write.mode("append").parquet(path)


def write_mapping(mapping: DataFrame, path: str, mutation: int, subset: DataFrame | None = None, exclude: DataFrame | None = None) -> None:
    """(segment_id, body_id) stamped with the mutation, in ranges of bodies; `subset` and `exclude` are tables of labels of bodies."""
    rows = mapping.select("segment_id", "body_id")
    for labels, how in ((subset, "left_semi"), (exclude, "left_anti")):
        if labels is not None:
            rows = rows.join(labels.select(F.col("label").alias("body_id")).distinct(), "body_id", how)
            if rows.isEmpty():
                raise ValueError("no mapping is left")
    stamped = rows.select("segment_id", "body_id", F.lit(mutation).cast("long").alias("mutid"))
    stamped.repartitionByRange("body_id", "segment_id").sortWithinPartitions("body_id", "segment_id").write.mode("append").parquet(path)


def write_edges(edges: DataFrame, path: str, grid: Grid) -> None:
    """Edges in folders by the brick of their first point; nothing passes through the driver."""
    cells = [grid.cell(i, f"{a}a").alias(f"b{a}") for i, a in enumerate(AXES)]
    rows = edges.select(*(F.col(c).cast("int").alias(c) if c in POINTS else F.col(c) for c in edges.columns), *cells)
    rows.repartition("bz", "by", "bx").write.mode("overwrite").partitionBy("bz", "by", "bx").parquet(path)


def write_assignments(edges: DataFrame, path: str, per_file: int) -> None:
    """Edges as JSON assignments in folders by group, so many in each."""
    from gridloom.operators.aggregates import distribute_lists

    item = edges.select("group", F.struct(*(c for c in edges.columns if c != "group")).alias("task"))
    distribute_lists(item, "group", "task", per_file).select("group", "chunk", F.to_json("items").alias("value")).write.mode("overwrite").partitionBy("group", "chunk").text(path)


def export_blocks(stats: DataFrame, path: str, key: str = "segment_id", block: int = 64) -> None:
    """CSV of the block indexes of each supervoxel or body."""
    from gridloom.functions.arithmetic import floor_div

    stats.select(key, *(floor_div(a, block).alias(a) for a in AXES), "count").groupBy(key, *AXES).agg(F.sum("count").alias("count")).write.mode("overwrite").option("header", True).csv(path)
