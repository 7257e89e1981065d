import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.operators.grid import Grid
from gridloom.sources import chunks, precomputed, tables, volumes
from gridloom.streaming import changes
from tests.test_volumes import array, voxels


@pytest.fixture(scope="module")
def cube():
    rng = np.random.default_rng(11)
    return rng.integers(0, 5, (7, 9, 10)) * rng.integers(0, 2, (7, 9, 10))


@pytest.mark.parametrize("codec", [None, "gzip", "zlib", "zstd"])
def test_zarr(spark, cube, tmp_path, codec):
    chunks.write_zarr(voxels(spark, cube), str(tmp_path), "a/s0", cube.shape, (4, 4, 4), codec=codec)
    assert (array(chunks.read_zarr(spark, str(tmp_path), "a/s0"), cube.shape) == cube).all()
    box = ((1, 2, 3), (5, 6, 10))
    part = array(chunks.read_zarr(spark, str(tmp_path), "a/s0", box), cube.shape)
    want = np.zeros_like(cube)
    want[1:5, 2:6, 3:10] = cube[1:5, 2:6, 3:10]
    assert (part == want).all()


def test_zarr_bounds(spark, cube, tmp_path):
    with pytest.raises(ValueError, match="leave the array"):
        chunks.write_zarr(voxels(spark, cube), str(tmp_path), "a", (3, 9, 10), (4, 4, 4))
    chunks.write_zarr(voxels(spark, cube), str(tmp_path), "a", (3, 9, 10), (4, 4, 4), out_of_bounds="permit")
    with pytest.raises(ValueError, match="leaves the array"):
        chunks.read_zarr(spark, str(tmp_path), "a", ((0, 0, 0), (9, 9, 10)))
    got = chunks.read_zarr(spark, str(tmp_path), "a", ((100, 0, 0), (109, 9, 10)), "permit", (100, 0, 0))
    assert got.count() == (cube[:3] > 0).sum() and got.agg(F.min("z")).first()[0] >= 100


def test_n5(spark, cube, tmp_path):
    chunks.write_n5(voxels(spark, cube), str(tmp_path), "v/s0", cube.shape, (4, 3, 5))
    v = volumes.open_volume(spark, {"n5": {"path": str(tmp_path), "dataset": "v/s0"}, "geometry": {"bounding-box": ((0, 0, 0), (-1, 4, -1))}})
    want = cube.copy()
    want[:, 4:] = 0
    assert (array(v, cube.shape) == want).all()


def test_slices(spark, cube, tmp_path):
    chunks.write_slices(voxels(spark, cube), str(tmp_path), "s-{:04d}.pgm", 9, 10)
    path = f"{tmp_path}/s-{{:04d}}.pgm"
    assert chunks.slice_format(path)[1] == "{:04d}"
    assert (array(volumes.open_volume(spark, {"slice-files": {"slice-path-format": path}}), cube.shape) == cube).all()
    assert chunks.stack_attributes(spark, path)["box"][1][1:] == (9, 10)


def test_png_slices(spark, cube, tmp_path):
    chunks.write_slices(voxels(spark, cube), str(tmp_path), "s-{:04d}.png", 9, 10)
    path = f"{tmp_path}/s-{{:04d}}.png"
    assert (array(chunks.read_slices(spark, path), cube.shape) == cube).all()
    assert chunks.stack_attributes(spark, path) == {"box": ((0, 0, 0), (7, 9, 10)), "dtype": "uint8"}
    wide = (tmp_path / "s-0000.png").read_bytes()
    for f in tmp_path.glob("*.png"):
        f.write_bytes(wide[:24] + b"\x10" + wide[25:])
    with pytest.raises(ValueError, match="8 bits"):
        chunks.read_slices(spark, path)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 300, 70_000])
@pytest.mark.parametrize("kind", ["uint32", "uint64"])
def test_segmentation_codec(n, kind):
    block = (8, 8, 8) if n < 1000 else (48, 48, 48)
    labels = np.random.default_rng(n).integers(0, 2**31, n).astype(kind) * (1 if kind == "uint32" else 2**31)
    x = labels[np.random.default_rng(n + 1).integers(0, n, (49, 50, 51))]
    got = precomputed.decode_segmentation(precomputed.encode_segmentation(x, block), x.shape, block, np.dtype(kind))
    assert got.dtype == x.dtype and (got == x).all()


def test_segmentation_by_hand():
    # One block of 2 x 1 x 2 voxels: the table after the packed bits, two labels, places 0, 1, 1, 0 from the lowest bit on.
    words = [1, (3 | 1 << 24), 2, 0b0110, 7, 9]
    data = np.array(words, "<u4").tobytes()
    got = precomputed.decode_segmentation(data, (2, 1, 2), (2, 1, 2), np.dtype("uint32"))
    assert got.tolist() == [[[7, 9]], [[9, 7]]]


@pytest.mark.parametrize("encoding", ["raw", "compressed_segmentation"])
def test_precomputed(spark, cube, tmp_path, encoding):
    folder, box = str(tmp_path / "v"), ((0, 0, 0), cube.shape)
    precomputed.write_precomputed(voxels(spark, cube), folder, box, (4, 3, 8), encoding=encoding)
    assert (array(volumes.open_volume(spark, {"precomputed": {"path": folder}}), cube.shape) == cube).all()
    name = next((tmp_path / "v" / "1_1_1").glob("*-*_*-*_*-*"))
    name.with_name(name.name + ".gz").write_bytes(__import__("gzip").compress(name.read_bytes()))
    name.unlink()
    part = ((1, 2, 3), (5, 6, 10))
    want = np.zeros_like(cube)
    want[1:5, 2:6, 3:10] = cube[1:5, 2:6, 3:10]
    for v in (volumes.from_url(spark, f"precomputed://file://{folder}", box=part), volumes.open_volume(spark, {"tensorstore": {"spec": {"driver": "neuroglancer_precomputed", "kvstore": {"driver": "file", "path": folder}}, "box": part}})):
        assert (array(v, cube.shape) == want).all()
    with pytest.raises(ValueError, match="leaves the array"):
        precomputed.read_precomputed(spark, folder, box=((0, 0, 0), (9, 9, 9)))
    with pytest.raises(ValueError, match="leave the volume"):
        precomputed.write_precomputed(voxels(spark, cube), folder, ((1, 0, 0), cube.shape), (4, 3, 8))


def test_precomputed_with_an_offset(spark, cube, tmp_path):
    moved = voxels(spark, cube).select(*(F.col(a) + o for a, o in zip("zyx", (-5, 100, 3), strict=True)), "label").toDF("z", "y", "x", "label")
    precomputed.write_precomputed(moved, str(tmp_path), ((-5, 100, 3), (2, 109, 13)), (4, 4, 4))
    got = volumes.open_volume(spark, {"precomputed": {"path": str(tmp_path)}})
    assert sorted(got.collect()) == sorted(moved.where("label <> 0").select(*(F.col(a).cast("int") for a in "zyx"), "label").collect())


def test_npy_and_views(spark, cube, tmp_path):
    path = str(tmp_path / "v.npy")
    np.save(path, cube)
    mapping = str(tmp_path / "m.csv")
    pd.DataFrame({"sv": [1, 2], "body": [50, 60]}).to_csv(mapping, index=False)
    v = volumes.open_volume(spark, {"npy": {"path": path, "block": 4}, "adapters": {"apply-labelmap": {"file": mapping}, "translate": (10, 0, 0)}})
    want = cube.copy()
    want[cube == 1], want[cube == 2] = 50, 60
    assert (array(v.withColumn("z", F.col("z") - 10), cube.shape) == want).all()
    with pytest.raises(ValueError, match="order"):
        volumes.open_volume(spark, {"npy": {"path": path}, "adapters": {"translate": (0, 0, 0), "apply-labelmap": {"file": mapping}}})
    with pytest.raises(NotImplementedError):
        volumes.open_volume(spark, {"dvid": {}})
    with pytest.raises(ValueError, match="exactly one"):
        volumes.open_volume(spark, {})


def test_parquet_overwrites_cells(spark, cube, tmp_path):
    path, g = str(tmp_path / "v"), Grid((4, 4, 4))
    volumes.write_voxels(voxels(spark, cube), path, g)
    volumes.write_voxels(voxels(spark, cube).where("z < 4 and y < 4 and x < 4").withColumn("label", F.lit(9).cast("long")), path, g)
    got = volumes.open_volume(spark, {"parquet": {"path": path, "scale": 0}}).select("z", "y", "x", "label")
    want = cube.copy()
    want[:4, :4, :4][cube[:4, :4, :4] > 0] = 9
    assert (array(got, cube.shape) == want).all()
    volumes.write_bricks(voxels(spark, cube), str(tmp_path / "b"), g)
    assert (array(volumes.open_volume(spark, {"bricks": {"path": str(tmp_path / "b"), "block-shape": (4, 4, 4)}}), cube.shape) == cube).all()


def test_tables(spark, tmp_path):
    ids = lambda df: sorted(r[0] for r in df.collect())
    assert ids(tables.label_list(spark, [3, 1, 3])) == [1, 3]
    np.save(tmp_path / "l.npy", np.array([5, 6, 5], np.uint64))
    assert ids(tables.label_list(spark, str(tmp_path / "l.npy"))) == [5, 6]
    pd.DataFrame({"x": [0], "body": [8]}).to_csv(tmp_path / "l.csv", index=False)
    assert ids(tables.label_list(spark, str(tmp_path / "l.csv"))) == [8]
    pd.DataFrame({"sv": [1, 2], "group": [7, 7]}).to_feather(tmp_path / "g.feather")
    want = {(1, 7), (2, 7)}
    assert {tuple(r) for r in tables.label_groups(spark, str(tmp_path / "g.feather")).collect()} == want
    (tmp_path / "g.json").write_text(json.dumps([[1, 2], [3]]))
    assert {tuple(r) for r in tables.label_groups(spark, str(tmp_path / "g.json")).collect()} == {(1, 1), (2, 1), (3, 2)}
    pd.DataFrame({"a": [1, 2, 9], "b": [2, 3, 8]}).to_csv(tmp_path / "e.csv", index=False)
    assert {tuple(r) for r in tables.labelmap(spark, str(tmp_path / "e.csv"), "equivalence-edges").collect()} == {(1, 1), (2, 1), (3, 1), (8, 8), (9, 8)}
    assert tables.cached_mapping(spark, str(tmp_path / "e.csv"), str(tmp_path / "map")).count() == 5
    pd.DataFrame({"id_a": [2, 1, 5], "id_b": [1, 2, 6], "s": [0, 0, 0]}).to_csv(tmp_path / "m.csv", index=False)
    assert [r[:2] for r in tables.merge_table(spark, str(tmp_path / "m.csv"), True).collect()] == [(1, 2), (5, 6)]
    (tmp_path / "made").mkdir()
    for n in ("12.ngmesh", "7.obj", "note.txt"):
        (tmp_path / "made" / n).write_text("x")
    assert ids(tables.made_objects(spark, str(tmp_path / "made"))) == [7, 12]


def test_changes_as_a_stream(spark, tmp_path):
    import datetime as dt

    rows = [(dt.datetime(2024, 1, d), a, i) for d, a, i in ((1, "merge", [1, 2]), (5, "merge", [3, 4]), (6, "error", [9]), (7, "split", [4, 5]))]
    log = str(tmp_path / "log")
    spark.createDataFrame(rows, changes.LOG).write.parquet(log)
    seen = []
    made = spark.createDataFrame([(5,)], "label long")
    changes.follow(spark, log, str(tmp_path / "check"), lambda df, n: seen.extend(r[0] for r in df.collect()), "2024-01-02", made).awaitTermination()
    assert sorted(seen) == [3, 4]
    spark.createDataFrame([(dt.datetime(2024, 1, 9), "merge", [11])], changes.LOG).write.mode("append").parquet(log)
    changes.follow(spark, log, str(tmp_path / "check"), lambda df, n: seen.extend(r[0] for r in df.collect()), "2024-01-02", made).awaitTermination()
    assert sorted(seen) == [3, 4, 11]


def test_writers(spark, tmp_path):
    e = spark.createDataFrame([(1, 10, 11), (1, 12, 13), (2, 14, 15)], "group long, label_a long, label_b long")
    volumes.write_assignments(e, str(tmp_path / "a"), 1)
    assert spark.read.text(str(tmp_path / "a")).count() == 3
    stats = spark.createDataFrame([(1, 1, 0, 0, 64, 5), (1, 1, 0, 0, 65, 2)], "body_id long, segment_id long, z int, y int, x int, count long")
    volumes.append_stats(stats, str(tmp_path / "s"))
    volumes.append_stats(stats, str(tmp_path / "s"))
    assert tables.block_stats(spark, str(tmp_path / "s")).count() == 4
    volumes.export_blocks(stats, str(tmp_path / "x"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x")).collect()[0][:] == ("1", "0", "0", "1", "7")
    from gridloom.operators.aggregates import label_index

    volumes.write_label_index(label_index(stats), str(tmp_path / "i"), 4, "me")
    assert spark.read.parquet(str(tmp_path / "i")).first()["last_mutid"] == 4
