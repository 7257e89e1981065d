import time

import pytest
from pyspark.sql import functions as F

from gridloom.functions import channels
from gridloom.operators import numbering, objects
from gridloom.plans.measures import evaluate


def test_auto_retry():
    calls = []

    @channels.auto_retry(3, 0, lambda e: "again" in str(e))
    def fails(kind):
        calls.append(kind)
        if len(calls) < 3:
            raise RuntimeError(kind)
        return "done"

    assert fails("again") == "done" and len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError):
        fails("never")
    assert len(calls) == 1
    with pytest.raises(ValueError):
        channels.auto_retry(0)


def test_in_subprocess():
    assert channels.in_subprocess(sum, 10, [1, 2]) == 3
    with pytest.raises(TimeoutError):
        channels.in_subprocess(time.sleep, 0.2, 10)
    with pytest.raises(ZeroDivisionError):
        channels.in_subprocess(divmod, 10, 1, 0)


def test_lists_and_partitions(spark):
    df = spark.createDataFrame([([1, 2], [2, 3]), (None, [5])], "a array<long>, b array<long>")
    assert [r[0] for r in df.select(channels.extend_list("a", "b")).collect()] == [[1, 2, 3], [5]]
    _, n, parts = channels.persist_and_count(spark.range(10).repartition(3))
    assert n == 10 and parts.agg(F.sum("rows")).first()[0] == 10


def test_numbers_and_totals(spark):
    rows = [(i % 7, i, i * 3 % 11) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, v long").repartition(5)
    order = sorted(rows)
    got = {r["b"]: r["n"] for r in numbering.number_rows(df, ["a", "b"], "n", 10).collect()}
    assert got == {b: i + 10 for i, (_, b, _) in enumerate(order)}
    totals = {r["b"]: r["t"] for r in numbering.running_totals(df, ["a", "b"], {"t": "v"}).collect()}
    assert totals == {b: sum(v for *_, v in order[:i]) for i, (_, b, _) in enumerate(order)}
    assert numbering.number_rows(df.limit(0), ["a"], "n").count() == 0


def test_measures(spark):
    o = spark.createDataFrame([("x", 1, 1, 5), ("x", 1, 2, 5), ("y", 2, 3, 4)], "subvolume string, gt long, seg long, overlap long")
    got = evaluate(o)
    assert {r["subvolume"]: r["total"] for r in got["vi"]["subvolumes"].collect()} == {"x": 1.0, "y": 0.0}
    assert got["vi"]["extremes"].first()["most_at"] == "x"
    assert got["count"]["whole"].first()["difference"] == 1
    assert got["rand"]["whole"].first()["rand_merge"] == 1.0


def test_work_lists(spark):
    work = spark.createDataFrame([(1,), (2,), (3,)], "label long")
    done, rest = objects.by_status(work, spark.createDataFrame([(2,)], "label long"), ["label"])
    assert [r[0] for r in done.collect()] == [2] and sorted(r[0] for r in rest.collect()) == [1, 3]
    box = spark.createDataFrame([(1, 8, 0, 2, 0, 2, 0, 2), (2, 1, 0, 100, 0, 10, 0, 10)], "label long, count long, z0 int, z1 int, y0 int, y1 int, x0 int, x1 int")
    assert [(r["label"], r["factor"]) for r in objects.mask_factors(box, 1000).collect()] == [(2, 3), (1, 1)]
    assert objects.share_of_total(box, "label", "count").where("share <> 1").isEmpty()
