"""Per-object geometry: masks, centroids, distances, and the seam for meshes and skeletons."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES, floor_div


def object_boxes(voxels: DataFrame) -> DataFrame:
    return voxels.where("label <> 0").groupBy("label").agg(F.count("*").alias("count"), *(x for a in AXES for x in (F.min(a).alias(f"{a}0"), (F.max(a) + 1).alias(f"{a}1"))))


def object_masks(voxels: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(label, box, count, mask): bit-packed masks of each label's box, for labels small enough to be held by a task."""
    rows = voxels.where("label <> 0").select(*AXES, F.col("label").cast("long"))
    if labels is not None:
        rows = rows.join(labels.select("label").distinct(), "label", "left_semi")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        at = pdf[list(AXES)].to_numpy(np.int64)
        low, high = at.min(axis=0), at.max(axis=0) + 1
        m = np.zeros(high - low, bool)
        m[tuple((at - low).T)] = True
        return pd.DataFrame({"label": [pdf["label"].iat[0]], **{f"{a}0": [low[i]] for i, a in enumerate(AXES)}, **{f"{a}1": [high[i]] for i, a in enumerate(AXES)}, "count": [int(m.sum())], "mask": [np.packbits(m).tobytes()]})

    return rows.select("label", *AXES).groupBy("label").applyInPandas(pack, "label long, z0 long, y0 long, x0 long, z1 long, y1 long, x1 long, count long, mask binary")


def nearest_of_label(points: DataFrame, voxels: DataFrame, radii: tuple[int, ...] = (50, 100, 200, 400)) -> DataFrame:
    """Points (id, z, y, x, label) with the nearest voxel of their label (nz, ny, nx) within the last radius, else (0, 0, 0).

    Radii are tried in turn; a point meets only the cells of the radius's width around it, and only its label's voxels."""
    left = points.select("id", *AXES, "label")
    found = None
    for r in radii:
        around = F.explode(F.array(*[F.struct((floor_div("z", r) + i).alias("cz"), (floor_div("y", r) + j).alias("cy"), (floor_div("x", r) + k).alias("cx")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
        p = left.select("id", F.col("label"), *(F.col(a).alias(f"p{a}") for a in AXES), around.alias("_c")).select("id", "label", "pz", "py", "px", "_c.*")
        v = voxels.select("label", *(F.col(a).alias(f"n{a}") for a in AXES), *(floor_div(a, r).alias(f"c{a}") for a in AXES))
        met = p.join(v, ["label", "cz", "cy", "cx"])
        d = sum(((F.col(f"p{a}") - F.col(f"n{a}")) * (F.col(f"p{a}") - F.col(f"n{a}")) for a in AXES), F.lit(0)).cast("long")
        best = met.withColumn("_d", d).where(F.col("_d") <= r * r).groupBy("id").agg(F.min(F.struct("_d", *(f"n{a}" for a in AXES))).alias("_b")).select("id", *(F.col(f"_b.n{a}").alias(f"n{a}") for a in AXES))
        found = best if found is None else found.unionByName(best)
        left = left.join(best.select("id"), "id", "left_anti")
    return points.join(found, "id", "left").select(*points.columns, *(F.coalesce(f"n{a}", F.lit(0)).cast("int").alias(f"n{a}") for a in AXES))


def correct_centroids(objects: DataFrame, voxels: DataFrame, radii: tuple[int, ...] = (50, 100, 200, 400)) -> DataFrame:
    """Objects (label, m_z, m_y, m_x) with a point inside: the rounded centroid where its voxel has the label, else the nearest voxel that has."""
    from gridloom.operators.edges import sample_labels

    points = objects.select(F.col("label").alias("id"), *(F.round(f"m_{a}").cast("int").alias(a) for a in AXES), "label")
    seen = sample_labels(points, voxels, "_at")
    good = seen.where("_at = label").select("id", *AXES)
    moved = nearest_of_label(seen.where("_at <> label").drop("_at"), voxels, radii).select("id", *(F.col(f"n{a}").alias(a) for a in AXES))
    return good.unionByName(moved).withColumnRenamed("id", "label")


def nearest_points(points: DataFrame, targets: DataFrame, by: str, radius: int) -> DataFrame:
    """For each point (id, by, z, y, x) its nearest target of the same `by` within the radius: target and distance, null beyond."""
    around = F.explode(F.array(*[F.struct((floor_div("z", radius) + i).alias("cz"), (floor_div("y", radius) + j).alias("cy"), (floor_div("x", radius) + k).alias("cx")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    p = points.select("id", by, *(F.col(a).alias(f"p{a}") for a in AXES), around.alias("_c")).select("id", by, "pz", "py", "px", "_c.*")
    t = targets.select(F.col("id").alias("target"), by, *(F.col(a).alias(f"t{a}") for a in AXES), *(floor_div(a, radius).alias(f"c{a}") for a in AXES))
    d = F.sqrt(sum(((F.col(f"p{a}") - F.col(f"t{a}")) * (F.col(f"p{a}") - F.col(f"t{a}")) for a in AXES), F.lit(0)).cast("double"))
    best = p.join(t, [by, "cz", "cy", "cx"]).withColumn("distance", d).where(F.col("distance") <= radius).groupBy("id").agg(F.min(F.struct("distance", "target")).alias("_b")).select("id", F.col("_b.target").alias("target"), F.col("_b.distance").alias("distance"))
    return points.join(best, "id", "left")


def surface_mesh(mask: np.ndarray, corner: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Vertices (x, y, z) and quads' triangles of a mask's exposed voxel faces."""
    padded = np.pad(mask, 1)
    quads = []
    for axis in range(3):
        for end in (0, 1):
            open_ = mask & ~np.roll(padded, -1 if end else 1, axis)[1:-1, 1:-1, 1:-1]
            at = np.argwhere(open_)
            u, v = [a for a in range(3) if a != axis]
            corners = np.repeat(at[:, None, :], 4, axis=1)
            corners[:, :, axis] += end
            corners[:, [1, 2], u] += 1
            corners[:, [2, 3], v] += 1
            quads.append(corners[:, ::-1] if end == (axis != 1) else corners)
    q = np.concatenate(quads)
    vertices, index = np.unique(q.reshape(-1, 3), axis=0, return_inverse=True)
    index = index.reshape(-1, 4)
    faces = np.concatenate([index[:, [0, 1, 2]], index[:, [0, 2, 3]]])
    return (vertices + np.array(corner))[:, ::-1].astype(np.float32), faces.astype(np.int32)


def per_object(voxels: DataFrame, kernel: Callable[[np.ndarray, tuple[int, int, int]], bytes]) -> DataFrame:
    """(label, result, status) of an opaque kernel over each label's mask; a failing object has its error and no result."""
    masks = object_masks(voxels)

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                shape = (r.z1 - r.z0, r.y1 - r.y0, r.x1 - r.x0)
                mask = np.unpackbits(np.frombuffer(r.mask, np.uint8), count=int(np.prod(shape))).reshape(shape).astype(bool)
                try:
                    out.append((r.label, kernel(mask, (r.z0, r.y0, r.x0)), "ok"))
                except Exception as e:  # an object's failure is its row's status
                    out.append((r.label, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["label", "result", "status"])

    return masks.mapInPandas(run, "label long, result binary, status string")


def mesh_bytes(mask: np.ndarray, corner: tuple[int, int, int]) -> bytes:
    """A surface as an OBJ file."""
    vertices, faces = surface_mesh(mask, corner)
    return "".join([f"v {x:g} {y:g} {z:g}\n" for x, y, z in vertices] + [f"f {a} {b} {c}\n" for a, b, c in faces + 1]).encode()


def combine_meshes(parts: DataFrame) -> DataFrame:
    """Brick meshes (label, result: OBJ) put together by label; vertices that bricks share become one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seen: dict[str, int] = {}
        faces = []
        for data in pdf["result"]:
            lines = data.decode().splitlines()
            names = [line[2:] for line in lines if line.startswith("v ")]
            number = [seen.setdefault(n, len(seen) + 1) for n in names]
            faces += [[number[int(i) - 1] for i in line[2:].split()] for line in lines if line.startswith("f ")]
        text = "".join(f"v {n}\n" for n in seen) + "".join(f"f {a} {b} {c}\n" for a, b, c in faces)
        return pd.DataFrame({"label": [pdf["label"].iat[0]], "result": [text.encode()]})

    return parts.groupBy("label").applyInPandas(run, "label long, result binary")
