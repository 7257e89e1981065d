"""Edges between labels: adjacency on a grid, representative edges, groups, closest approaches and paths."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES, floor_div

PAIR = ["label_a", "label_b"]
POINTS = ["za", "ya", "xa", "zb", "yb", "xb"]


def adjacency(voxels: DataFrame, axes: tuple[str, ...] = AXES, label: str = "label") -> DataFrame:
    """Every place where two labels other than background touch along an axis: label_a < label_b, axis, the lower voxel's
    coordinates, and forward: whether the lower voxel has label_a. Neighbours are exactly one apart, so sparse rows make no false edges.

    Each axis is an equi-join on coordinates rather than a window over lines, so a long line isn't one task."""
    lit = voxels.where(F.col(label) != 0)
    out = None
    for axis in axes:
        right = lit.select(*((F.col(a) - 1 if a == axis else F.col(a)).alias(a) for a in axes), F.col(label).alias("_right"))
        found = lit.select(*axes, F.col(label).alias("_left")).join(right, list(axes)).where("_left <> _right")
        found = found.select(F.least("_left", "_right").alias("label_a"), F.greatest("_left", "_right").alias("label_b"), F.lit(axis).alias("axis"), (F.col("_left") < F.col("_right")).alias("forward"), *axes)
        out = found if out is None else out.unionByName(found)
    return out


def line_changes(rows: DataFrame, line: list[str], order: list[str], label: str) -> DataFrame:
    """Changes of label between successive rows of each line: label_a < label_b, forward, and the earlier row's columns."""
    after = F.lead(label).over(Window.partitionBy(*line).orderBy(*order))
    return rows.withColumn("_next", after).where(F.col("_next").isNotNull() & (F.col("_next") != F.col(label))).select(*line, *order, F.least(label, "_next").alias("label_a"), F.greatest(label, "_next").alias("label_b"), (F.col(label) < F.col("_next")).alias("forward"))


def central_edges(edges: DataFrame, pair: list[str] = PAIR, at: list[str] = list(AXES), weight: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """For each pair the row nearest to the pair's weighted centroid (ties: least coordinates, then the columns kept), with edge_area, the sum of weights.

    Two aggregates and a join on the pair; no rows of a pair are gathered."""
    keep = keep or []
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    area = F.sum(weight) if weight else F.count("*")
    centre = edges.groupBy(*(F.col(p).alias(f"_{p}") for p in pair)).agg(area.alias("_area"), *((F.sum(w * F.col(a)) / F.sum(w)).alias(f"_c_{a}") for a in at))
    on = F.lit(True)
    for p in pair:
        on &= F.col(p) == F.col(f"_{p}")
    joined = edges.join(centre, on)
    squared = sum(((F.col(a) - F.col(f"_c_{a}")) * (F.col(a) - F.col(f"_c_{a}")) for a in at), F.lit(0.0))
    best = F.min(F.struct(F.round(squared, 6).alias("_d"), *(F.col(a).alias(a) for a in at), *(F.col(c).alias(c) for c in keep)))
    return joined.groupBy(*pair).agg(best.alias("_b"), F.first("_area").alias("edge_area")).select(*pair, *(F.col(f"_b.{c}").alias(c) for c in [*at, *keep]), "edge_area")


def closest_edges(edges: DataFrame, pair: list[str] = PAIR, distance: str = "distance", keep: list[str] | None = None) -> DataFrame:
    """For each pair the row of least distance, then of least values of the columns kept."""
    keep = keep or [c for c in edges.columns if c not in (*pair, distance)]
    best = F.min(F.struct(F.col(distance).alias(distance), *(F.col(c).alias(c) for c in keep)))
    return edges.groupBy(*pair).agg(best.alias("_b")).select(*pair, *(F.col(f"_b.{c}").alias(c) for c in [distance, *keep]))


def append_groups(edges: DataFrame, groups: DataFrame, pair: list[str] = PAIR) -> DataFrame:
    """An edge once for each group that has both its labels."""
    g = groups.select("label", "group").distinct()
    a = g.select(F.col("label").alias("_a"), F.col("group").alias("group"))
    b = g.select(F.col("label").alias("_b"), F.col("group").alias("_group"))
    out = edges.join(a, F.col(pair[0]) == F.col("_a")).join(b, (F.col(pair[1]) == F.col("_b")) & (F.col("group") == F.col("_group")))
    return out.select(*edges.columns, "group")


def append_group_components(edges: DataFrame, groups: DataFrame, most: float | None = None) -> DataFrame:
    """Grouped edges with group_cc, the component within the group; edges longer than `most` link nothing and have -1.

    Nodes are (group, label) pairs, numbered in this order for the graph operator, so a component's least node has the group's least label in it."""
    from gridloom.operators.components import components_of_edges
    from gridloom.operators.lineage import cut
    from gridloom.operators.numbering import number_rows

    near = F.lit(True) if most is None else F.col("distance") <= most
    members = cut(number_rows(groups.select("group", "label").distinct(), ["group", "label"], "_n"))
    end = lambda c, name: members.select(F.col("group"), F.col("label").alias(c), F.col("_n").alias(name))
    links = edges.where(near).select("group", *PAIR).join(end("label_a", "src"), ["group", "label_a"]).join(end("label_b", "dst"), ["group", "label_b"]).select("src", "dst")
    found = components_of_edges(links)
    top = members.join(found, F.col("_n") == F.col("node"), "left").select(F.col("group").alias("_g"), F.col("label").alias("_l"), F.coalesce("component", "_n").alias("_c"))
    named = top.join(members.select(F.col("_n").alias("_c"), F.col("label").alias("group_cc")), "_c").select("_g", "_l", "group_cc")
    out = edges.join(named, (F.col("group") == F.col("_g")) & (F.col("label_a") == F.col("_l"))).drop("_g", "_l")
    return out.withColumn("group_cc", F.when(near, F.col("group_cc")).otherwise(F.lit(-1)))


def intra_group(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """Central edge of each pair in a common group, with the point on either side: the lower voxel and its neighbour along the axis."""
    grouped = edges.join(append_groups(edges.select(*PAIR).distinct(), groups).select(*PAIR).distinct(), PAIR, "left_semi")
    best = central_edges(grouped, keep=["axis", "forward"])
    step = {a: F.col(a) + (F.col("axis") == a).cast("int") for a in AXES}
    side = lambda first, a: F.when(F.col("forward") == first, F.col(a)).otherwise(step[a])
    return best.select(*PAIR, *(side(True, a).alias(f"{a}a") for a in AXES), *(side(False, a).alias(f"{a}b") for a in AXES), F.lit(1.0).alias("distance"), "edge_area")


def near_pairs(voxels: DataFrame, radius: int, groups: DataFrame | None = None) -> DataFrame:
    """Pairs of labels, of one group if there are groups, that may have voxels within the radius: those in the same or touching cells of its width."""
    at = voxels.where("label <> 0").select("label", *(floor_div(a, radius).alias(f"c{a}") for a in AXES)).distinct()
    around = F.explode(F.array(*[F.struct((F.col("cz") + i).alias("cz"), (F.col("cy") + j).alias("cy"), (F.col("cx") + k).alias("cx")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    a = at.select(F.col("label").alias("label_a"), around.alias("_c")).select("label_a", "_c.*")
    pairs = a.join(at.withColumnRenamed("label", "label_b"), ["cz", "cy", "cx"]).where("label_a < label_b").select(*PAIR).distinct()
    return pairs if groups is None else append_groups(pairs, groups).select(*PAIR).distinct()


def closest_approaches(voxels: DataFrame, pairs: DataFrame, radius: int) -> DataFrame:
    """For each pair of labels its two nearest voxels, if they are within the radius: exact, by cells of the radius's width.

    A voxel meets those of the 27 cells around its own; only surface voxels, those with a face to another label, are candidates."""
    lit = voxels.where("label <> 0")
    same = lit.select(*AXES, "label")
    inner = None
    for axis in AXES:
        for step in (-1, 1):
            near = same.select(*((F.col(a) + step if a == axis else F.col(a)).alias(a) for a in AXES), "label")
            inner = near if inner is None else inner.union(near)
    buried = inner.groupBy(*AXES, "label").agg(F.count("*").alias("_n")).where("_n = 6")
    shell = same.join(buried, [*AXES, "label"], "left_anti")
    cell = [floor_div(a, radius).alias(f"c{a}") for a in AXES]
    wanted = pairs.select(F.least(*PAIR).alias("label_a"), F.greatest(*PAIR).alias("label_b")).distinct()
    a = shell.select(F.col("label").alias("label_a"), *(F.col(c).alias(f"{c}a") for c in AXES), *cell).join(wanted, "label_a")
    around = F.explode(F.array(*[F.struct((F.col("cz") + i).alias("cz"), (F.col("cy") + j).alias("cy"), (F.col("cx") + k).alias("cx")) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    a = a.select(*PAIR, "za", "ya", "xa", around.alias("_c")).select(*PAIR, "za", "ya", "xa", "_c.*")
    b = shell.select(F.col("label").alias("label_b"), *(F.col(c).alias(f"{c}b") for c in AXES), *cell)
    met = a.join(b, ["label_b", "cz", "cy", "cx"])
    squared = sum(((F.col(f"{c}a") - F.col(f"{c}b")) * (F.col(f"{c}a") - F.col(f"{c}b")) for c in AXES), F.lit(0))
    met = met.withColumn("distance", F.sqrt(squared.cast("double"))).where(F.col("distance") <= radius)
    return closest_edges(met.select(*PAIR, *POINTS, "distance"))


def normalise(edges: DataFrame) -> DataFrame:
    """label_a < label_b, the points swapped along; group_cc -1 dropped if there is such a column."""
    rows = edges.where("group_cc <> -1") if "group_cc" in edges.columns else edges
    turn = F.col("label_a") > F.col("label_b")
    other = {c: (c[:-1] + ("b" if c.endswith("a") else "a")) for c in [*PAIR, *POINTS]}
    return rows.select(*(F.when(turn, F.col(other[c])).otherwise(F.col(c)).alias(c) if c in other and other[c] in rows.columns else F.col(c) for c in rows.columns))


def append_attributes(edges: DataFrame, attributes: DataFrame, key: str = "label") -> DataFrame:
    """Attributes of both ends with suffixes _a and _b."""
    out = edges
    for s in ("a", "b"):
        side = attributes.select(*(F.col(c).alias(f"{c}_{s}" if c != key else f"_k{s}") for c in attributes.columns))
        out = out.join(side, F.col(f"label_{s}") == F.col(f"_k{s}"), "left").drop(f"_k{s}")
    return out


def sample_labels(points: DataFrame, voxels: DataFrame, name: str = "label", width: int = 64) -> DataFrame:
    """Points (z, y, x and more) with the label at each, 0 for background. Both sides are keyed by coordinates; every point column stays."""
    v = voxels.select(*(F.col(a).alias(f"_{a}") for a in AXES), F.col("label").alias("_label"))
    on = (F.col("z") == F.col("_z")) & (F.col("y") == F.col("_y")) & (F.col("x") == F.col("_x"))
    return points.join(v, on, "left").select(*points.columns, F.coalesce("_label", F.lit(0)).cast("long").alias(name))


def refresh_edges(edges: DataFrame, voxels: DataFrame, group: str = "group") -> DataFrame:
    """Edges with the labels that their points have now: those within one label go, and of each group's pair the least distance stays, so a direct
    edge before a nearby one; ties by the other columns. group_cc is kept as it was.

    Edges are read once and meet the voxels by sorted joins: a compressed file of voxels may look small enough for a broadcast while its rows aren't."""
    rows = edges
    for s in ("a", "b"):
        place = [f"{a}{s}" for a in AXES]
        now = voxels.select(*(F.col(a).alias(p) for a, p in zip(AXES, place, strict=True)), F.col("label").alias("_now")).hint("merge")
        rows = rows.dropna(subset=place).join(now, place, "left").withColumn(f"label_{s}", F.coalesce("_now", F.lit(0)).cast("long")).drop("_now")
    rows = normalise(rows.where("label_a <> label_b").withColumnRenamed("group_cc", "_cc")).withColumnRenamed("_cc", "group_cc")
    return closest_edges(rows, [group, *PAIR]).select(*edges.columns)


def sample_labels_in_bricks(points: DataFrame, bricks: DataFrame, grid, name: str = "label") -> DataFrame:
    """The same from a brick table: points and bricks meet by cell, and a brick's bytes are read once for all its points."""
    keys = ["bz", "by", "bx"]
    columns = list(points.columns)
    rows = points.select("*", *grid.cells())

    def gather(key, pts: pd.DataFrame, brick: pd.DataFrame) -> pd.DataFrame:
        out = pts[columns].copy()
        if len(brick):
            b = brick.iloc[0]
            block = np.frombuffer(b["payload"], b["dtype"]).reshape(grid.shape)
            out[name] = block[tuple(pts[a].to_numpy() - b[f"{a}0"] for a in AXES)].astype("int64")
        else:
            out[name] = 0
        return out

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema] + [f"`{name}` long"])
    return rows.groupBy(*keys).cogroup(bricks.groupBy(*keys)).applyInPandas(gather, schema)


def paths_to_edges(paths: DataFrame) -> DataFrame:
    """(group_cc, cc_task, label_a, label_b) of paths (group_cc, cc_task, path)."""
    steps = F.transform(F.sequence(F.lit(1), F.size("path") - 1), lambda i: F.struct(F.element_at("path", i).alias("a"), F.element_at("path", i + 1).alias("b")))
    rows = paths.where(F.size("path") > 1).select("group_cc", "cc_task", F.posexplode(steps).alias("step", "_e"))
    return rows.select("group_cc", "cc_task", "step", F.least("_e.a", "_e.b").alias("label_a"), F.greatest("_e.a", "_e.b").alias("label_b"))


def shortest_paths(edges: list[tuple[int, int, float]], ends: set[int]) -> list[list[int]]:
    """Shortest paths between ends that pass through no other end, one for each unordered pair that has any; ties by node order."""
    near: dict[int, list[tuple[float, int]]] = {}
    for a, b, d in edges:
        near.setdefault(a, []).append((d, b))
        near.setdefault(b, []).append((d, a))
    out = []
    for start in sorted(ends & near.keys()):
        best, before, queue = {start: 0.0}, {}, [(0.0, start)]
        done = set()
        while queue:
            d, node = heapq.heappop(queue)
            if node in done:
                continue
            done.add(node)
            if node in ends and node != start:
                if node > start:
                    path = [node]
                    while path[-1] != start:
                        path.append(before[path[-1]])
                    out.append(path[::-1])
                continue
            for step, other in sorted(near[node]):
                if d + step < best.get(other, np.inf):
                    best[other], before[other] = d + step, node
                    heapq.heappush(queue, (d + step, other))
    return sorted(out)


def extract_fragments(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """(group_cc, cc_task, path): paths between bodies of interest in each component. A component's edges are searched in one task."""
    flagged = edges.select("group_cc", *PAIR, F.col("distance").cast("double").alias("distance"))
    for s in ("a", "b"):
        mark = ends.select(F.col("label").alias(f"_{s}")).distinct()
        flagged = flagged.join(mark, F.col(f"label_{s}") == F.col(f"_{s}"), "left").withColumn(f"end_{s}", F.col(f"_{s}").isNotNull()).drop(f"_{s}")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        marked = set(pdf.loc[pdf["end_a"], "label_a"]) | set(pdf.loc[pdf["end_b"], "label_b"])
        paths = shortest_paths(list(pdf[["label_a", "label_b", "distance"]].itertuples(index=False, name=None)), {int(x) for x in marked})
        return pd.DataFrame({"group_cc": pdf["group_cc"].iat[0], "cc_task": range(len(paths)), "path": pd.Series(paths, dtype=object)}, columns=["group_cc", "cc_task", "path"])

    return flagged.groupBy("group_cc").applyInPandas(search, "group_cc long, cc_task int, path array<long>")


def endpoints(paths: DataFrame, sizes: DataFrame) -> DataFrame:
    """The two ends of each task, the one with the larger size first."""
    e = paths.select("group_cc", "cc_task", F.col("path")[0].alias("_p"), F.element_at("path", -1).alias("_q"))
    s = sizes.select("label", "size")
    e = e.join(s.select(F.col("label").alias("_p"), F.col("size").alias("_ps")), "_p", "left").join(s.select(F.col("label").alias("_q"), F.col("size").alias("_qs")), "_q", "left").fillna(0, ["_ps", "_qs"])
    first = (F.col("_ps") > F.col("_qs")) | ((F.col("_ps") == F.col("_qs")) & (F.col("_p") <= F.col("_q")))
    return e.select("group_cc", "cc_task", *(F.when(first, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("_p", "_q", "label_a"), ("_q", "_p", "label_b"), ("_ps", "_qs", "size_a"), ("_qs", "_ps", "size_b"))))


def nudge_inward(edges: DataFrame, voxels: DataFrame) -> DataFrame:
    """End points of direct edges one voxel further inside their labels, where the label goes on there."""
    out = edges
    for s, o in (("a", "b"), ("b", "a")):
        v = voxels.select(*(F.col(a).alias(f"_v{a}") for a in AXES), F.col("label").alias("_l"))
        target = {a: F.col(f"{a}{s}") * 2 - F.col(f"{a}{o}") for a in AXES}
        on = F.col("_l") == F.col(f"label_{s}")
        for a in AXES:
            on &= target[a] == F.col(f"_v{a}")
        # Kept beside the old points until both ends are done: each end moves away from the other's old place.
        out = out.join(v, on, "left").withColumns({f"_{a}{s}": F.coalesce(f"_v{a}", f"{a}{s}") for a in AXES}).drop("_l", *(f"_v{a}" for a in AXES))
    return out.select(*(F.col(f"_{c}").alias(c) if c in POINTS else F.col(c) for c in edges.columns))
