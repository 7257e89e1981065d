"""Precomputed volumes: an `info` file and, for each scale, a file for each chunk, raw or as compressed segmentation.

The format lists axes x, y, z; chunks at the far faces are cut at the volume's bound."""

from __future__ import annotations

import json
import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.grid import Box, Grid, within
from gridloom.sources.chunks import VOXELS, _attributes, _decode, _touching, _voxels, _write, check_bounds

#: Fixed values of the format: bits of an encoded value.
BITS = (0, 1, 2, 4, 8, 16, 32)
BLOCK = (8, 8, 8)


def _blocks(shape: tuple[int, ...], block: tuple[int, ...]) -> list[tuple[slice, ...]]:
    """The parts of a chunk, x fastest; both sizes as z, y, x."""
    return [tuple(slice(c, c + n) for c, n in zip((z, y, x), block, strict=True)) for z in range(0, shape[0], block[0]) for y in range(0, shape[1], block[1]) for x in range(0, shape[2], block[2])]


def encode_segmentation(chunk: np.ndarray, block: tuple[int, int, int] = BLOCK) -> bytes:
    """One channel: for each block a table of its labels and, packed into 32-bit words, each voxel's place in it."""
    parts = _blocks(chunk.shape, block)
    head, body, tables = np.zeros(2 * len(parts), "<u4"), [], {}
    at = len(head)

    def put(words: np.ndarray) -> int:
        nonlocal at
        body.append(words)
        at += len(words)
        return at - len(words)

    for i, part in enumerate(parts):
        inside = chunk[part]
        full = np.pad(inside, [(0, n - m) for n, m in zip(block, inside.shape, strict=True)], "edge")
        labels, place = np.unique(full, return_inverse=True)
        bits = next(b for b in BITS if 1 << b >= len(labels))
        if bits:
            rows = np.zeros((-(-place.size * bits // 32), 32 // bits), np.uint32)
            rows.reshape(-1)[: place.size] = place.reshape(-1)
            packed = np.bitwise_or.reduce(rows << (np.arange(32 // bits, dtype=np.uint32) * np.uint32(bits)), axis=1)
        else:
            packed = np.empty(0, np.uint32)
        head[2 * i + 1] = put(packed.astype("<u4"))
        table = labels.astype(chunk.dtype.newbyteorder("<")).tobytes()
        if table not in tables:
            tables[table] = put(np.frombuffer(table, "<u4"))
        if tables[table] >= 1 << 24:
            raise ValueError("the chunk is too large for compressed segmentation")
        head[2 * i] = tables[table] | bits << 24
    return np.concatenate([np.ones(1, "<u4"), head, *body]).astype("<u4").tobytes()


def decode_segmentation(data: bytes, shape: tuple[int, ...], block: tuple[int, ...], kind: np.dtype) -> np.ndarray:
    words = np.frombuffer(data, "<u4")
    words = words[words[0] :]
    out, n = np.empty(shape, kind), int(np.prod(block))
    for i, part in enumerate(_blocks(shape, block)):
        table, bits, at = int(words[2 * i]) & 0xFFFFFF, int(words[2 * i]) >> 24, int(words[2 * i + 1])
        place = np.zeros(n, np.int64)
        if bits:
            packed = words[at : at + -(-n * bits // 32)].astype(np.uint64)
            place = (packed[:, None] >> (np.arange(32 // bits, dtype=np.uint64) * np.uint64(bits)) & np.uint64((1 << bits) - 1)).reshape(-1)[:n].astype(np.int64)
        labels = words[table : table + (int(place.max()) + 1) * kind.itemsize // 4].view(kind)
        target = out[part]
        out[part] = labels[place].reshape(block)[tuple(map(slice, target.shape))]
    return out


def read_precomputed(spark: SparkSession, path: str, scale: int = 0, box: Box | None = None, out_of_bounds: str = "forbid") -> DataFrame:
    """Voxels of one scale. A box beyond the volume raises, or (`permit`) is empty there. Sharded scales aren't read."""
    root = path.rstrip("/")
    info = _attributes(spark, f"{root}/info")
    level = info["scales"][scale]
    if "sharding" in level or level["encoding"] not in ("raw", "compressed_segmentation") or info.get("num_channels", 1) != 1:
        raise NotImplementedError("only unsharded scales of one channel, raw or as compressed segmentation, are read")
    kind, packed = np.dtype(info["data_type"]).newbyteorder("<"), level["encoding"] != "raw"
    first, chunk = level.get("voxel_offset", [0, 0, 0]), level["chunk_sizes"][0]
    stop = [o + n for o, n in zip(first, level["size"], strict=True)]
    block = tuple(level.get("compressed_segmentation_block_size", BLOCK))[::-1]
    if box is not None and out_of_bounds == "forbid":
        check_bounds(box, (tuple(first[::-1]), tuple(stop[::-1])))

    def rows(batches):
        for pdf in batches:
            for content, ends in zip(pdf["content"], pdf["ends"], strict=True):
                corner, end = ends[4::-2], ends[5::-2]
                shape = tuple(int(b - a) for a, b in zip(corner, end, strict=True))
                data = _decode(content, "gzip" if content[:2] == b"\x1f\x8b" and (packed or len(content) != int(np.prod(shape)) * kind.itemsize) else None)
                values = decode_segmentation(data, shape, block, kind) if packed else np.frombuffer(data, kind).reshape(shape)
                yield _voxels(values, tuple(map(int, corner)))

    found = spark.read.format("binaryFile").load(f"{root}/{level['key']}")
    number = r"(-?[0-9]+)-(-?[0-9]+)"
    name = F.element_at(F.split("path", "/"), -1)
    ends = F.array(*[F.regexp_extract(name, rf"^{number}_{number}_{number}(\.gz)?$", i).cast("int") for i in range(1, 7)])
    files = found.where(name.rlike(rf"^{number}_{number}_{number}(\.gz)?$")).select("content", ends.alias("ends"))
    # A scale may be there in chunks of several sizes; those of the first size are the volume.
    for i in range(3):
        low = F.col("ends")[2 * i]
        files = files.where((F.pmod(low - first[i], F.lit(chunk[i])) == 0) & (F.col("ends")[2 * i + 1] == F.least(low + chunk[i], F.lit(stop[i]))))
    if box is not None:
        index = F.array(*[F.call_function("div", F.col("ends")[2 * i] - first[i], F.lit(chunk[i])).cast("int") for i in range(3)])
        files = _touching(files.withColumn("index", index), chunk, [AXES.index(a) for a in "xyz"], box, tuple(first[::-1]))
    out = files.select("content", "ends").mapInPandas(rows, VOXELS)
    return out if box is None else out.where(within(box))


def write_precomputed(voxels: DataFrame, folder: str, box: Box, chunks: tuple[int, int, int], dtype: str = "uint64", encoding: str = "compressed_segmentation", resolution: tuple[int, int, int] = (1, 1, 1)) -> None:
    """One scale of a segmentation, a file for each chunk that isn't empty. Voxels beyond the box raise."""
    if not voxels.where(~within(box)).isEmpty():
        raise ValueError("voxels leave the volume")
    first, stop = box
    size = [b - a for a, b in zip(first, stop, strict=True)]
    key = "_".join(map(str, resolution[::-1]))
    level = {"key": key, "size": size[::-1], "voxel_offset": list(first)[::-1], "chunk_sizes": [list(chunks)[::-1]], "resolution": list(resolution)[::-1], "encoding": encoding}
    if encoding == "compressed_segmentation":
        level["compressed_segmentation_block_size"] = list(BLOCK)[::-1]
        if np.dtype(dtype).name not in ("uint32", "uint64"):
            raise ValueError("compressed segmentation has labels of 32 or 64 bits")
    elif encoding != "raw":
        raise ValueError(f"no encoder for {encoding}")
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/info", "w") as f:
        json.dump({"@type": "neuroglancer_multiscale_volume", "type": "segmentation", "data_type": dtype, "num_channels": 1, "scales": [level]}, f)

    def ends(cell: tuple[int, ...]) -> list[tuple[int, int]]:
        return [(o + c * n, min(o + c * n + n, e)) for c, n, o, e in zip(cell, chunks, first, stop, strict=True)]

    def encode(block: np.ndarray, cell: tuple[int, ...]) -> bytes:
        inside = block[tuple(slice(0, b - a) for a, b in ends(cell))]
        return encode_segmentation(inside) if encoding != "raw" else inside.astype(block.dtype.newbyteorder("<")).tobytes()

    _write(voxels, Grid(chunks, first), lambda cell: f"{folder}/{key}/" + "_".join(f"{a}-{b}" for a, b in reversed(ends(cell))), encode, dtype, False)
