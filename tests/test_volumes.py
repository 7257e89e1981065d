"""Operators on small arrays: the literal fixtures, and seeded ones against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import aggregates, diffs, edges, filters, geometry, graph, grid, labelmap, metrics, resample
from gridloom.operators import volume_components as vc
from gridloom.operators.grid import Grid
from gridloom.operators.lineage import cut
from gridloom.plans import source_registry
from gridloom.plans.workflows import find_job, run_job

AXES = ["z", "y", "x"]
ADJACENT = ["_____666", "_1122_6_", "_1122___", "_1128_77", "________", "_4444___", "_3333___", "________"]
PIECES = ["________", "_____4__", "_111__11", "_1______", "_1______", "_1_2222_", "________", "_3___3_1"]


def voxels(spark, a):
    at = np.argwhere(a)
    return spark.createDataFrame([(*map(int, i), int(a[tuple(i)])) for i in at], "z int, y int, x int, label long")


def array(df, shape):
    out = np.zeros(shape, np.int64)
    for r in df.collect():
        assert out[r["z"], r["y"], r["x"]] == 0
        out[r["z"], r["y"], r["x"]] = r["label"]
    return out


def drawn(spark, rows):
    return voxels(spark, np.array([[[0 if c == "_" else int(c) for c in r] for r in rows]]))


@pytest.fixture(scope="module")
def cube():
    """Nearest-seed labels with some background."""
    rng = np.random.default_rng(7)
    seeds = rng.integers(0, 12, (9, 3))
    at = np.indices((12, 12, 12)).reshape(3, -1).T
    a = (((at[:, None] - seeds[None]) ** 2).sum(-1).argmin(1) + 1).reshape(12, 12, 12)
    a[rng.random(a.shape) < 0.15] = 0
    return a


def flood(a, connectivity=1):
    """Component number of each voxel, by flood fill."""
    out, n = np.zeros(a.shape, int), 0
    near = [np.array(s) for s in np.ndindex(3, 3, 3) if 0 < sum(abs(c - 1) for c in s) <= connectivity]
    for start in map(tuple, np.argwhere(a)):
        if out[start]:
            continue
        n += 1
        out[start], stack = n, [start]
        while stack:
            p = stack.pop()
            for s in near:
                q = tuple(np.array(p) + s - 1)
                if all(0 <= c < m for c, m in zip(q, a.shape, strict=True)) and a[q] == a[start] and not out[q]:
                    out[q] = n
                    stack.append(q)
    return out


def partition(names):
    groups = {}
    for k, v in names.items():
        groups.setdefault(v, set()).add(k)
    return {frozenset(g) for g in groups.values()}


def test_adjacency_fixture(spark):
    v = drawn(spark, ADJACENT)
    found = edges.adjacency(v)
    pairs = {(r["label_a"], r["label_b"]) for r in found.collect()}
    assert (1, 2) in pairs and (3, 4) in pairs and all(a > 0 for a, _ in pairs)
    best = {(r["label_a"], r["label_b"]): r for r in edges.central_edges(found, keep=["axis", "forward"]).collect()}
    assert best[1, 2][AXES[0]] == 0 and best[1, 2]["y"] == 2 and best[1, 2]["x"] == 2 and best[1, 2]["forward"]
    assert best[3, 4]["y"] == 5 and not best[3, 4]["forward"]
    groups = spark.createDataFrame([(i, 1) for i in range(1, 9)], "label long, group long")
    out = edges.append_group_components(edges.append_groups(found.select("label_a", "label_b").distinct(), groups), groups)
    assert partition({r[c]: r["group_cc"] for r in out.collect() for c in ("label_a", "label_b")}) == {frozenset({1, 2, 8}), frozenset({3, 4})}


def test_components_fixture(spark):
    v = drawn(spark, PIECES)
    old, new = array(v, (1, 8, 8)), array(vc.relabel_components(v, Grid((1, 4, 4))), (1, 8, 8))
    for k in (0, 2, 4):
        assert ((old == k) == (new == k)).all()
    assert len(set(new[old == 1])) == 3 and len(set(new[old == 3])) == 2
    assert min(set(new[(old == 1) | (old == 3)])) > 4


@pytest.mark.parametrize(("connectivity", "block"), [(1, 5), (2, 4), (3, 12)])
def test_components_of_a_cube(spark, cube, connectivity, block):
    found = vc.label_components(voxels(spark, cube), Grid((block,) * 3), connectivity).collect()
    want = flood(cube, connectivity)
    assert partition({tuple(r[a] for a in AXES): r["component"] for r in found}) == partition({tuple(map(int, p)): want[tuple(p)] for p in np.argwhere(cube)})


def test_group_edges_fixture(spark):
    e = spark.createDataFrame([(1, 2, "a"), (1, 2, "b"), (1, 3, "c"), (1, 4, "d"), (2, 3, "e"), (2, 3, "f"), (3, 4, "g")], "label_a long, label_b long, info string")
    g = spark.createDataFrame([(1, 10), (2, 10), (1, 20), (2, 20), (3, 20), (1, 30), (4, 40)], "label long, group long")
    got = {(r["group"], r["label_a"], r["label_b"], r["info"]) for r in edges.append_groups(e, g).collect()}
    assert got == {(10, 1, 2, "a"), (20, 1, 2, "a"), (10, 1, 2, "b"), (20, 1, 2, "b"), (20, 1, 3, "c"), (20, 2, 3, "e"), (20, 2, 3, "f")}


def test_spheres(spark):
    a = np.zeros((40, 40, 40), int)
    at = np.indices(a.shape)
    for label, radius, c in ((1, 4, 8), (2, 9, 24)):
        a[((at - c) ** 2).sum(0) <= radius**2] = label
    classes = np.where(a > 0, np.where(at[0] < 24, 3, 4), 0)
    got = {r["label"]: r for r in run_job(spark, "MitoStats", {"input": voxels(spark, a), "classes": voxels(spark, classes)})["stats"].collect()}
    for label, radius, c in ((1, 4, 8), (2, 9, 24)):
        assert got[label]["n"] == (a == label).sum() and [got[label][f"m_{x}"] for x in AXES] == pytest.approx([c] * 3)
        assert got[label]["r_0"] == pytest.approx(radius, rel=0.05)
    assert got[2]["classes"] == {3: int(((a == 2) & (classes == 3)).sum()), 4: int(((a == 2) & (classes == 4)).sum())}
    small = run_job(spark, "mitostats", {"input": voxels(spark, a), "min-size": 1000})["stats"]
    assert [r["label"] for r in small.collect()] == [2]


def test_contingency_job(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 10, (2, 8, 8, 8))
    out = run_job(spark, "ContingencyTable", {"left": voxels(spark, a), "right": voxels(spark, b), "block-shape": (4, 4, 4)})
    pairs, n = np.unique(np.stack([a.ravel(), b.ravel()]), axis=1, return_counts=True)
    want = {(int(x), int(y)): int(k) for (x, y), k in zip(pairs.T, n, strict=True) if x or y}
    assert {(r["left"], r["right"]): r["voxel_count"] for r in out["table"].collect()} == want
    part = run_job(spark, "ContingencyTable", {"left": voxels(spark, a), "right": voxels(spark, b), "block-shape": (4, 4, 4), "min-overlap-size": 2, "scope": "global"})
    assert {(r["left"], r["right"]) for r in part["table"].collect()} == {k for k, v in want.items() if v >= 2}


def test_bricks_and_jobs_registry(spark, cube):
    v, g = voxels(spark, cube), Grid((5, 4, 3), (1, 0, 2))
    assert (array(grid.from_bricks(grid.to_bricks(v, g), g.shape), cube.shape) == cube).all()
    assert (array(grid.map_bricks(v, g, lambda b: b * 2), cube.shape) == cube * 2).all()
    with pytest.raises(ValueError, match="no job"):
        find_job("nothing")
    with pytest.raises(ValueError, match="missing options"):
        run_job(spark, "SamplePoints", {})
    assert find_job("gridloom.plans.workflows.RoiStats") is find_job("roistats")


def test_missing_label_raises(spark):
    v = spark.createDataFrame([(1,), (2,), (0,)], "label long")
    m = spark.createDataFrame([(1, 7)], "orig long, new long")
    assert sorted(r[0] for r in labelmap.map_labels(v, m).collect()) == [0, 2, 7]
    assert sorted(r[0] for r in labelmap.map_labels(v, m, missing="zero").collect()) == [0, 0, 7]
    assert sorted(r[0] for r in labelmap.map_labels(v.where("label < 2"), m, missing="error").collect()) == [0, 7]
    with pytest.raises(Exception, match="no mapping"):
        labelmap.map_labels(v, m, missing="error").collect()


def test_sampling(spark, cube):
    rng = np.random.default_rng(2)
    points = [(i, *map(int, rng.integers(0, 12, 3)), f"foo{i}") for i in range(60)]
    p = spark.createDataFrame(points, "i int, z int, y int, x int, extra string")
    v, g = voxels(spark, cube), Grid((4, 4, 4))
    want = {i: int(cube[z, y, x]) for i, z, y, x, _ in points}
    assert {r["i"]: r["label"] for r in edges.sample_labels(p, v).collect()} == want
    assert {r["i"]: r["label"] for r in edges.sample_labels_in_bricks(p, grid.to_bricks(v, g), g).collect()} == want


def test_closest_approaches(spark):
    rng = np.random.default_rng(3)
    a = np.zeros((6, 20, 20), int)
    for label in range(1, 6):
        for _ in range(5):
            a[tuple(rng.integers(0, s) for s in a.shape)] = label
    pairs = [(i, j) for i in range(1, 6) for j in range(i + 1, 6)]
    got = {(r["label_a"], r["label_b"]): r["distance"] for r in edges.closest_approaches(voxels(spark, a), spark.createDataFrame(pairs, "label_a long, label_b long"), 7).collect()}
    for i, j in pairs:
        d = min(np.linalg.norm(p - q) for p in np.argwhere(a == i) for q in np.argwhere(a == j))
        assert got.get((i, j), 99) == pytest.approx(d) if d <= 7 else (i, j) not in got


def test_morphology(spark, cube):
    mask = cube == 3
    box = ((0, 0, 0), cube.shape)
    grown = {tuple(r) for r in filters.dilate(voxels(spark, mask.astype(int))).collect()}
    want = {tuple(p + s) for p in np.argwhere(mask) for s in np.concatenate([np.zeros((1, 3), int), np.eye(3, dtype=int), -np.eye(3, dtype=int)])}
    assert grown == want
    eroded = {tuple(r) for r in filters.erode(voxels(spark, mask.astype(int)), box).collect()}
    padded = np.pad(mask, 1, constant_values=True)
    core = mask.copy()
    for axis in range(3):
        for step in (-1, 1):
            core &= np.roll(padded, step, axis)[1:-1, 1:-1, 1:-1]
    assert eroded == {tuple(map(int, p)) for p in np.argwhere(core)}
    empty = filters.empty_regions(voxels(spark, cube), box, 3).collect()
    parts = flood((cube == 0).astype(int))
    sizes = np.bincount(parts.ravel())
    assert len(empty) == sum(s for s in sizes[1:] if s >= 3)


def test_halos_and_padding(spark, cube):
    v, g = voxels(spark, cube), Grid((4, 4, 4))
    inner = grid.halos(v, g, "inner", "lower").where("axis = 'z' and bz = 1").collect()
    assert len(inner) == (cube[4] > 0).sum()
    outer = grid.halos(v, g, "outer", "lower").where("axis = 'z' and bz = 1").collect()
    assert len(outer) == (cube[3] > 0).sum() and {r["z"] for r in outer} == {3}
    part = v.where("z < 2 and y < 2 and x < 2")
    assert grid.pad(part, g, v).count() == (cube[:4, :4, :4] > 0).sum()
    assert grid.dense(v, ((0, 0, 0), (12, 12, 12))).count() == 12**3
    assert grid.clip_to_logical(grid.split_to_grid(v, Grid((4, 4, 4), halo=(1, 1, 1)))).count() == (cube > 0).sum()


def test_scales(spark, cube):
    v = voxels(spark, cube)
    blocks = cube.reshape(6, 2, 6, 2, 6, 2).transpose(0, 2, 4, 1, 3, 5).reshape(6, 6, 6, 8)
    for name, zero in (("mode", True), ("labels", False)):
        want = np.array([[[max(sorted(set(b) if zero else set(b) - {0} or {0}), key=lambda k: (list(b).count(k), -k)) for b in r] for r in s] for s in blocks])
        assert (array(resample.downsample(v, (2, 2, 2), name), (6, 6, 6)) == want).all()
    own = resample.reduce_blocks(v, (2, 2, 2), lambda pdf: int(pdf["label"].max()))
    assert (array(own, (6, 6, 6)) == blocks.max(-1)).all()
    assert resample.depth(((0, 0, 0), (100, 3000, 512))) == 3
    up = resample.at_scale(v.withColumn("scale", F.lit(1)), 0, [1])
    assert up.count() == 8 * (cube > 0).sum()


@pytest.mark.parametrize("most", [3, 10000])
def test_blocks_are_reduced_in_batches(spark, most):
    """Blocks longer and shorter than a batch, nulls beside numbers that floats can't hold, and rows without a place."""
    big = 2**60 + 1
    rows = [(0, 0, x, big if x % 8 else 5, x % 3 == 0, 0.5) for x in range(24)] + [(0, 1, x, None if x == 24 else big, None, None) for x in range(16, 30)] + [(-1, -1, -1, None, True, 1.0), (None, 0, 1, 4, False, 1.0), (None, 0, 2, big, False, 1.0), (None, 9, 2, 6, True, 1.0)]
    v = spark.createDataFrame(rows, "z int, y int, x int, label long, flag boolean, value double").repartition(3)

    def seen(pdf):
        assert list(pdf.index) == list(range(len(pdf))) and list(pdf.columns) == ["_bz", "_by", "_bx", "z", "y", "x", "label", "flag", "value"]
        labels = [int(k) for k in pdf["label"] if k == k]
        return f"{len(pdf)} {pdf['label'].dtype} {max(labels, default=None)} {pdf['flag'].dtype} {(pdf['flag'] == True).sum()} {pdf['value'].sum()}"  # noqa: E712

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    try:
        out = resample.reduce_blocks(v, (1, 4, 8), seen, "string")
        got = {(r["z"], r["y"], r["x"]): r["label"] for r in out.collect()}
        modes = {(r["z"], r["y"], r["x"]): r["label"] for r in resample.reduce_blocks(v, (1, 4, 8), aggregates.per_block_mode).collect()}
        assert modes == {(0, 0, 0): big, (0, 0, 1): big, (0, 0, 2): big, (0, 0, 3): 2**60, (-1, -1, -1): None, (None, 0, 0): 4, (None, 2, 0): 6}
        assert resample.reduce_blocks(v.where("x > 99"), (2, 2, 2), len).collect() == []
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == {
        (0, 0, 0): f"8 int64 {big} bool 3 4.0",
        (0, 0, 1): f"8 int64 {big} bool 3 4.0",
        (0, 0, 2): f"16 int64 {big} object 2 4.0",
        (0, 0, 3): f"6 float64 {2**60} object 0 0.0",
        (-1, -1, -1): "1 float64 None bool 1 1.0",
        (None, 0, 0): f"2 int64 {big} bool 0 2.0",
        (None, 2, 0): "1 int64 6 bool 1 1.0",
    }
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()  # a batch for each block


def test_paths(spark):
    rows = [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 1, 3, 5.0), (0, 3, 4, 1.0), (0, 4, 5, 1.0), (7, 10, 11, 2.0)]
    e = spark.createDataFrame(rows, "group_cc long, label_a long, label_b long, distance double")
    ends = spark.createDataFrame([(1,), (3,), (5,), (10,)], "label long")
    paths = edges.extract_fragments(e, ends)
    assert {(r["group_cc"], tuple(r["path"])) for r in paths.collect()} == {(0, (1, 2, 3)), (0, (3, 4, 5))}
    assert edges.paths_to_edges(paths).count() == 4
    sizes = spark.createDataFrame([(1, 5), (3, 9)], "label long, size long")
    assert {(r["label_a"], r["label_b"]) for r in edges.endpoints(paths, sizes).collect()} == {(3, 1), (3, 5)}


def test_graph_steps(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "src long, dst long")
    assert {tuple(r) for r in graph.edges_of_group(e, 3).collect()} == {(1, 2), (2, 3), (3, 4)}
    assert {r[0] for r in graph.leaf_nodes_of_group(e, 9).collect()} == {8, 9}
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1), (8, 1), (9, 1), (5, 5)], "segment long, body long")
    assert {r["segment"]: r["body"] for r in graph.split_disconnected(members, e, 100).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 8: 100, 9: 100, 5: 5}
    pieces = diffs.intersection_components(e, spark.createDataFrame([(1, 2), (3, 4), (4, 8)], "src long, dst long")).collect()
    assert {r["sv"]: (r["old_body"], r["new_body"], r["piece"]) for r in pieces} == {1: (1, 1, 1), 2: (1, 1, 1), 3: (1, 3, 3), 4: (1, 3, 3), 8: (8, 3, 8), 9: (8, 9, 9)}


def test_nudge_and_nearest(spark):
    a = np.zeros((1, 1, 8), int)
    a[0, 0, :4], a[0, 0, 4:] = 1, 2
    v = voxels(spark, a)
    direct = edges.intra_group(edges.adjacency(v), spark.createDataFrame([(1, 1), (2, 1)], "label long, group long"))
    r = edges.nudge_inward(direct, v).first()
    assert (direct.first()["xa"], direct.first()["xb"], r["xa"], r["xb"]) == (3, 4, 2, 5)
    points = spark.createDataFrame([(1, 0, 0, 6, 1), (2, 0, 0, 100, 1)], "id long, z int, y int, x int, label long")
    got = {p["id"]: p["nx"] for p in geometry.nearest_of_label(points, v, (2, 4)).collect()}
    assert got == {1: 3, 2: 0}
    objects = spark.createDataFrame([(1, 0.0, 0.0, 6.0), (2, 0.0, 0.0, 5.4)], "label long, m_z double, m_y double, m_x double")
    assert {r["label"]: r["x"] for r in geometry.correct_centroids(objects, v).collect()} == {1: 3, 2: 5}


def test_refreshed_edges_sort(spark):
    """Voxels whose file is small enough for a broadcast, but whose number has no bound, meet the edges by sorted joins; edges are read once."""
    a = np.zeros((1, 2, 6), int)
    a[0, 0], a[0, 1] = (7, 7, 3, 3, 9, 0), (7, 2, 2, 0, 9, 9)
    v = cut(voxels(spark, a))
    rows = [(1, 5, 6, 0, 0, 1, 0, 0, 2, 1.0, "direct"), (1, 4, 8, 0, 0, 0, 0, 0, 3, 3.0, "far"), (1, 5, 6, 0, 0, 0, 0, 1, 0, 1.0, "within"), (2, 1, 2, 0, 0, 5, 0, 1, 4, 1.0, "absent"), (2, 1, 2, 0, 0, None, 0, 1, 4, 1.0, "nowhere"), (2, 1, 2, 0, 1, 2, 0, 1, 4, 2.0, "near")]
    e = cut(spark.createDataFrame(rows, "group long, label_a long, label_b long, za int, ya int, xa int, zb int, yb int, xb int, distance double, kind string"))
    out = edges.refresh_edges(e, v)
    assert {(r["group"], r["label_a"], r["label_b"], r["xa"], r["xb"], r["kind"]) for r in out.collect()} == {(1, 3, 7, 2, 1, "direct"), (2, 0, 9, 5, 4, "absent"), (2, 2, 9, 2, 4, "near")}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("SortMergeJoin") == 2 and "Broadcast" not in plan
    query = source_registry.refresh_edges(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert query.count("SortMergeJoin") == 3 and "Broadcast" not in query


def test_meshes_close(spark, cube):
    got = run_job(spark, "CreateMeshes", {"input": voxels(spark, cube)})["meshes"].collect()
    assert len(got) == len(set(cube[cube > 0])) and all(r["status"] == "ok" for r in got)
    for r in got[:3]:
        lines = r["result"].decode().splitlines()
        faces = [tuple(map(int, x[2:].split())) for x in lines if x.startswith("f ")]
        at = np.array([list(map(float, x[2:].split())) for x in lines if x.startswith("v ")])
        sides = [s for a, b, c in faces for s in ((a, b), (b, c), (c, a))]
        assert sorted(sides) == sorted((b, a) for a, b in sides)
        p, q, s = (at[np.array(faces)[:, i] - 1] for i in range(3))
        assert abs(np.einsum("ij,ij->i", p, np.cross(q, s)).sum()) / 6 == pytest.approx((cube == r["label"]).sum())
    whole = run_job(spark, "StitchedMeshes", {"input": voxels(spark, cube), "block-shape": (6, 6, 6)})["meshes"]
    assert whole.count() == len(got)


def test_assignment():
    from itertools import permutations

    rng = np.random.default_rng(5)
    for _ in range(40):
        n, m = rng.integers(1, 5, 2)
        w = rng.integers(0, 9, (n, m))
        got = metrics.assign(w)
        n, m = int(n), int(m)
        k = min(n, m)
        best = max(sum(w[i, j] for i, j in zip(r, c, strict=True)) for r in permutations(range(n), k) for c in permutations(range(m), k))
        assert sum(w[i, j] for i, j in got) == best and len({i for i, _ in got}) == len({j for _, j in got}) == len(got)


def test_connection_tables(spark):
    points = spark.createDataFrame([(1, 2, 11, 12)] * 6 + [(1, 2, 11, 13)] * 2 + [(2, 2, 12, 12)], "gt_pre long, gt_post long, seg_pre long, seg_post long")
    m = spark.createDataFrame([(1, 11), (2, 12), (3, 0)], "gt long, seg long")
    got = {r["threshold"]: r[1:] for r in metrics.connection_tables(points, m, (1, 5, 10)).collect()}
    assert got[1] == (0.7778, 1.0, 0.6667) and got[5] == (0.7778, 1.0, 1.0) and got[10] == (0.7778, None, None)
    assert {tuple(r) for r in metrics.autapses(points).collect()} == {(2, 1)}


def test_block_copy(spark, cube):
    new = cube.copy()
    new[0, 0, :] = 77
    out = run_job(spark, "LabelmapCopy", {"input": voxels(spark, new), "output": voxels(spark, cube), "block-shape": (4, 4, 4)})
    assert {(r["z"] // 4, r["y"] // 4) for r in out["voxels"].collect()} == {(0, 0)}
    assert [r[0] for r in out["new_labels"].collect()] == [77]
    kept = run_job(spark, "MaskSegmentation", {"input": voxels(spark, cube), "mask": voxels(spark, (cube == 3).astype(int)), "dilate": 0})
    assert kept["voxels"].count() == ((cube > 0) & (cube != 3)).sum() and kept["erased_stats"].agg(F.sum("count")).first()[0] == (cube == 3).sum()
    same = run_job(spark, "EvaluateSeg", {"ground-truth": voxels(spark, cube), "segmentation": voxels(spark, cube)})
    assert same["vi"].first()[:] == (0.0, 0.0) and same["rand"].first()[:] == (1.0, 1.0) and {r["n_merges"] for r in same["edits"].collect()} == {0}


def test_index_round_trip(spark, cube):
    stats = aggregates.block_statistics(voxels(spark, cube), 4)
    nested = aggregates.unnest_index(aggregates.label_index(stats, 4))
    assert nested.agg(F.sum("count")).first()[0] == (cube > 0).sum() and nested.count() == stats.count()
    assert run_job(spark, "CheckSegmentation", {"input": voxels(spark, cube), "index": stats, "block-shape": (4, 4, 4)})["errors"].count() == 0


def test_every_job_plans(spark, cube):
    """Jobs whose parts are tested above, run end to end."""
    v = voxels(spark, cube)
    stats = aggregates.block_statistics(v, 4)
    index = stats.select(F.col("segment_id").alias("label"), *AXES)
    configs = {
        "ContingentRelabel": {"primary": v, "contingency": v}, "ConnectedComponents": {"input": v, "block-shape": (6, 6, 6)}, "FindAdjacencies": {"input": v, "label-groups": [(1, 1), (2, 1), (3, 1)], "find-closest-within": 3},
        "SparseBlockstats": {"input": v, "mask": v, "mask-labels": [1, 2], "block-shape": (4, 4, 4)}, "RoiStats": {"input": v, "roi": v, "roi-names": spark.createDataFrame([(1, "a")], "roi_id long, roi string")},
        "MitoRepair": {"objects": v, "hulls": v}, "CopySegmentation": {"input": v, "output": v, "pyramid-depth": 1, "add-offset": 5, "input-mask-labels": [6, 7]}, "CopyGrayscale": {"input": v, "pyramid-depth": 1, "contrast": "none"},
        "MaskedCopy": {"input": v, "mask": v}, "CreatePyramid": {"input": v}, "CreateTiles": {"input": v, "tile": 4}, "GridMeshes": {"input": v, "block-shape": (6, 6, 6)}, "ComputeGraph": {"input": v},
        "IngestLabelIndices": {"block-stats": stats}, "SparseMeshes": {"input": v, "index": index, "labels": [1, 2], "block-shape": (4, 4, 4)},
    }
    for name, config in configs.items():
        for key, df in run_job(spark, name, config).items():
            assert df.count() >= (0 if key in ("nearby", "mapping") else 1), (name, key)
