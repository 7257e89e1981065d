"""Chunked array stores (N5, Zarr v2) and image stacks, decoded by the executors that list their files.

Reading goes through Spark's binary files, so any file system that Spark reads will do. Writing needs a folder that all
executors mount, since Spark has no writer for single files."""

from __future__ import annotations

import gzip
import json
import os
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.grid import Box, Grid, within

VOXELS = "z int, y int, x int, label long"


def _decode(data: bytes, codec: str | None) -> bytes:
    if codec in (None, "raw"):
        return data
    if codec in ("gzip", "zlib"):
        return zlib.decompress(data, 47)  # either header
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"no decoder for {codec}")


def _encode(data: bytes, codec: str | None) -> bytes:
    if codec in (None, "raw"):
        return data
    if codec == "gzip":
        return gzip.compress(data, 1, mtime=0)
    if codec == "zlib":
        return zlib.compress(data, 1)
    if codec == "zstd":
        import zstandard

        return zstandard.ZstdCompressor().compress(data)
    raise ValueError(f"no encoder for {codec}")


def _attributes(spark: SparkSession, path: str) -> dict:
    """A small JSON file, also one whose name starts with a point, which Spark's readers pass over."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _voxels(block: np.ndarray, corner: tuple[int, ...]) -> pd.DataFrame:
    at = np.nonzero(block)
    return pd.DataFrame({a: (i + c).astype(np.int32) for a, i, c in zip(AXES, at, corner, strict=True)} | {"label": block[at].astype(np.int64)})


def _files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    index = F.regexp_extract_all(F.regexp_extract("path", pattern, 1), F.lit(r"([0-9]+)"), 1)
    return found.select("content", F.transform(index, lambda i: i.cast("int")).alias("index")).where(F.size("index") == 3)


def read_n5(spark: SparkSession, path: str, dataset: str, box: Box | None = None) -> DataFrame:
    """Voxels of an N5 dataset. N5 lists axes x, y, z; a chunk has a header of mode, rank and its size, then big-endian values with x fastest."""
    root = f"{path.rstrip('/')}/{dataset}"
    a = _attributes(spark, f"{root}/attributes.json")
    codec = a["compression"]["type"] if isinstance(a.get("compression"), dict) else a.get("compressionType")
    size, kind = a["blockSize"], np.dtype(a["dataType"]).newbyteorder(">")

    def rows(batches):
        for pdf in batches:
            for content, index in zip(pdf["content"], pdf["index"], strict=True):
                _, rank = struct.unpack_from(">HH", content)
                shape = struct.unpack_from(f">{rank}I", content, 4)
                values = np.frombuffer(_decode(content[4 + 4 * rank :], codec), kind, int(np.prod(shape)))
                yield _voxels(values.reshape(shape[::-1]), tuple(i * s for i, s in zip(index, size, strict=True))[::-1])

    found = _files(spark, root, r"/([0-9]+/[0-9]+/[0-9]+)$")
    if box is not None:
        found = _touching(found, [s for s in size], [AXES.index(a) for a in "xyz"], box)
    out = found.mapInPandas(rows, VOXELS)
    return out if box is None else out.where(within(box))


def read_zarr(spark: SparkSession, path: str, dataset: str, box: Box | None = None, out_of_bounds: str = "forbid", offset: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """Voxels of a Zarr v2 array of axes z, y, x, moved by an offset. A box beyond the array raises, or (`permit`) is empty there."""
    root = f"{path.rstrip('/')}/{dataset}"
    a = _attributes(spark, f"{root}/.zarray")
    codec = (a.get("compressor") or {}).get("id")
    size, kind, order = a["chunks"], np.dtype(a["dtype"]), a.get("order", "C")
    if box is not None and out_of_bounds == "forbid":
        check_bounds(box, (offset, tuple(o + n for o, n in zip(offset, a["shape"], strict=True))))
    separator = a.get("dimension_separator", ".")
    extent = a["shape"]

    def rows(batches):
        for pdf in batches:
            for content, index in zip(pdf["content"], pdf["index"], strict=True):
                block = np.frombuffer(_decode(content, codec), kind, int(np.prod(size))).reshape(size, order=order)
                corner = tuple(i * s for i, s in zip(index, size, strict=True))
                block = block[tuple(slice(0, max(0, n - c)) for n, c in zip(extent, corner, strict=True))]
                yield _voxels(block, tuple(c + o for c, o in zip(corner, offset, strict=True)))

    pattern = r"/([0-9]+/[0-9]+/[0-9]+)$" if separator == "/" else r"/([0-9]+\.[0-9]+\.[0-9]+)$"
    found = _files(spark, root, pattern)
    if box is not None:
        found = _touching(found, size, [0, 1, 2], box, offset)
    out = found.mapInPandas(rows, VOXELS)
    return out if box is None else out.where(within(box))


def check_bounds(box: Box, whole: Box) -> None:
    if any(b < o for b, o in zip(box[0], whole[0], strict=True)) or any(b > e for b, e in zip(box[1], whole[1], strict=True)):
        raise ValueError("the box leaves the array")


def _touching(files: DataFrame, size: list[int], axes: list[int], box: Box, offset: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """The chunks that a box touches, so that the others aren't decoded."""
    keep = F.lit(True)
    for i, (n, a) in enumerate(zip(size, axes, strict=True)):
        low = F.col("index")[i] * n + offset[a]
        keep &= (low < box[1][a]) & (low + n > box[0][a])
    return files.where(keep)


def write_zarr(voxels: DataFrame, folder: str, dataset: str, shape: tuple[int, int, int], chunks: tuple[int, int, int], dtype: str = "<u8", codec: str | None = "gzip", out_of_bounds: str = "forbid", write_empty: bool = False) -> None:
    """A Zarr v2 array, a file for each chunk that isn't empty. Voxels beyond the array raise (`forbid`), raise unless they are background (`permit-empty`), or are left out (`permit`)."""
    inside = within(((0, 0, 0), shape))
    if out_of_bounds == "permit":
        voxels = voxels.where(inside)
    else:
        bad = voxels.where(~inside) if out_of_bounds == "forbid" else voxels.where(~inside & (F.col("label") != 0))
        if not bad.isEmpty():
            raise ValueError("voxels leave the array")
        voxels = voxels.where(inside)
    root = f"{folder.rstrip('/')}/{dataset}"
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/.zarray", "w") as f:
        json.dump({"zarr_format": 2, "shape": list(shape), "chunks": list(chunks), "dtype": dtype, "compressor": codec and {"id": codec, "level": 1}, "fill_value": 0, "order": "C", "filters": None}, f)
    _write(voxels, Grid(chunks), lambda cell: f"{root}/{'.'.join(map(str, cell))}", lambda block, _: _encode(np.ascontiguousarray(block).tobytes(), codec), dtype, write_empty)


def write_n5(voxels: DataFrame, folder: str, dataset: str, shape: tuple[int, int, int], chunks: tuple[int, int, int], dtype: str = "uint64", codec: str = "gzip") -> None:
    root = f"{folder.rstrip('/')}/{dataset}"
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/attributes.json", "w") as f:
        json.dump({"dimensions": list(shape)[::-1], "blockSize": list(chunks)[::-1], "dataType": dtype, "compression": {"type": codec}}, f)
    head = struct.pack(">HH3I", 0, 3, *chunks[::-1])
    kind = np.dtype(dtype).newbyteorder(">")
    _write(voxels, Grid(chunks), lambda cell: f"{root}/{'/'.join(map(str, cell[::-1]))}", lambda block, _: head + _encode(block.astype(kind).tobytes(), codec), dtype, False)


def _write(voxels: DataFrame, grid: Grid, name, encode, dtype: str, write_empty: bool) -> None:
    """Each chunk by one task; a chunk's file appears whole, so a task that runs again does no harm."""
    keys = ["bz", "by", "bx"]
    rows = (voxels if write_empty else voxels.where("label <> 0")).select(*(F.col(a).cast("long") for a in AXES), "label", *grid.cells())

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        cell = tuple(int(pdf[k].iat[0]) for k in keys)
        block = np.zeros(grid.shape, dtype)
        block[tuple(pdf[a].to_numpy() - o - c * n for a, c, n, o in zip(AXES, cell, grid.shape, grid.offset, strict=True))] = pdf["label"].to_numpy()
        path = name(cell)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{os.getpid()}.part"
        with open(part, "wb") as f:
            f.write(encode(block, cell))
        os.replace(part, path)
        return pd.DataFrame({"n": [1]})

    rows.groupBy(*keys).applyInPandas(put, "n int").agg(F.sum("n")).first()


def slice_format(path_format: str) -> tuple[str, str, str]:
    """Prefix, number format and suffix of a path such as /a/slice-{:05d}.pgm."""
    before, _, rest = path_format.partition("{")
    number, _, after = rest.partition("}")
    return before, "{" + number + "}", after


def _pgm(data: bytes) -> np.ndarray:
    fields, at = [], 0
    while len(fields) < 4:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while not data[end : end + 1].isspace():
            end += 1
        fields.append(data[at:end])
        at = end
    if fields[0] != b"P5":
        raise ValueError("slices are binary PGM images, or PNG or JPEG")
    width, height, most = map(int, fields[1:])
    return np.frombuffer(data, ">u2" if most > 255 else "u1", width * height, at + 1).reshape(height, width)


def _png(image: np.ndarray) -> bytes:
    """A grayscale PNG of 8 bits."""

    def part(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    lines = np.pad(image, [(0, 0), (1, 0)]).tobytes()  # each after its filter, 0
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 0, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def _decoded(path_format: str) -> bool:
    """Whether Spark's image source reads these slices."""
    return path_format.lower().endswith((".png", ".jpg", ".jpeg"))


def _images(spark: SparkSession, path_format: str) -> DataFrame:
    """(z, height, width, data) of decoded slices of 8 bits; a file that is no such image raises."""
    before, _, after = slice_format(path_format)
    if after.lower().endswith(".png"):
        head = spark.read.format("binaryFile").load(f"{before}*{after}").select(F.substring("content", 25, 1).alias("bits")).first()  # the stack has one kind
        if head and head["bits"] != b"\x08":
            raise ValueError("PNG slices have 8 bits; for 16 bits use PGM")
    found = spark.read.format("image").load(f"{before}*{after}").select("image.*")
    plain = F.when(F.col("nChannels") == 1, F.col("data")).otherwise(F.raise_error(F.concat(F.lit("no grayscale image: "), "origin")).cast("binary"))
    return found.select(F.regexp_extract("origin", r"([0-9]+)[^0-9]*$", 1).cast("int").alias("z"), "height", "width", plain.alias("data"))


def read_slices(spark: SparkSession, path_format: str) -> DataFrame:
    """(z, y, x, label) of a stack of grayscale slices; z is the number in the name. PGM of 8 or 16 bits, PNG and JPEG of 8."""
    if _decoded(path_format):

        def pixels(batches):
            for pdf in batches:
                for z, height, width, data in zip(pdf["z"], pdf["height"], pdf["width"], pdf["data"], strict=True):
                    yield _voxels(np.frombuffer(data, np.uint8).reshape(1, height, width), (z, 0, 0))

        return _images(spark, path_format).mapInPandas(pixels, VOXELS)
    before, _, after = slice_format(path_format)
    files = spark.read.format("binaryFile").load(f"{before}*{after}")
    number = F.regexp_extract("path", r"([0-9]+)[^0-9]*$", 1).cast("int")

    def rows(batches):
        for pdf in batches:
            for content, z in zip(pdf["content"], pdf["z"], strict=True):
                yield _voxels(_pgm(content)[None], (z, 0, 0))

    return files.select("content", number.alias("z")).mapInPandas(rows, VOXELS)


def stack_attributes(spark: SparkSession, path_format: str) -> dict:
    """Extent and value size of a stack, from its names and first slice."""
    before, _, after = slice_format(path_format)
    if _decoded(path_format):
        images = _images(spark, path_format).drop("data")
        low, high, height, width = images.agg(F.min("z"), F.max("z"), F.min_by("height", "z"), F.min_by("width", "z")).first()
        return {"box": ((low, 0, 0), (high + 1, height, width)), "dtype": "uint8"}
    files = spark.read.format("binaryFile").load(f"{before}*{after}")
    z = F.regexp_extract("path", r"([0-9]+)[^0-9]*$", 1).cast("int")
    low, high = files.agg(F.min(z), F.max(z)).first()
    first = _pgm(files.orderBy("path").select("content").first()["content"])
    return {"box": ((low, 0, 0), (high + 1, *first.shape)), "dtype": first.dtype.name}


def write_slices(voxels: DataFrame, folder: str, path_format: str, height: int, width: int) -> None:
    """Whole slices as PGM, or as PNG if the name says so, one task each."""
    png = path_format.lower().endswith(".png")

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((height, width), np.uint8)
        image[pdf["y"].to_numpy(), pdf["x"].to_numpy()] = pdf["label"].to_numpy()
        path = os.path.join(folder, path_format.format(int(pdf["z"].iat[0])))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(f"{path}.part", "wb") as f:
            f.write(_png(image) if png else b"P5\n%d %d\n255\n" % (width, height) + image.tobytes())
        os.replace(f"{path}.part", path)
        return pd.DataFrame({"n": [1]})

    voxels.groupBy("z").applyInPandas(put, "n int").agg(F.sum("n")).first()
