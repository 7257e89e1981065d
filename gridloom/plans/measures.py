"""Measures as plug-ins: how one is computed in a subvolume, how parts are brought together, and what is reported."""

from __future__ import annotations

from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators import metrics

MEASURES: dict[str, type[Measure]] = {}


class Measure:
    """`overlaps` have subvolume, gt, seg and overlap."""

    value: ClassVar[str] = ""

    def __init_subclass__(cls) -> None:
        MEASURES[cls.__name__.lower()] = cls

    def by_subvolume(self, overlaps: DataFrame) -> DataFrame:
        raise NotImplementedError

    def whole(self, overlaps: DataFrame) -> DataFrame:
        """The same over all subvolumes' overlaps added up."""
        summed = overlaps.groupBy("gt", "seg").agg(F.sum("overlap").alias("overlap")).withColumn("subvolume", F.lit(0))
        return self.by_subvolume(summed).drop("subvolume")

    def extremes(self, overlaps: DataFrame) -> DataFrame:
        return metrics.extremes(self.by_subvolume(overlaps), "subvolume", self.value)


class VI(Measure):
    value = "total"

    def by_subvolume(self, overlaps):
        found = metrics.variation_of_information(overlaps, ["subvolume"])
        return found.withColumn("total", F.col("false_merge") + F.col("false_split"))


class Rand(Measure):
    value = "rand_merge"

    def by_subvolume(self, overlaps):
        return metrics.rand(overlaps, ["subvolume"])


class Count(Measure):
    """Bodies of both sides."""

    value = "difference"

    def by_subvolume(self, overlaps):
        found = overlaps.groupBy("subvolume").agg(F.countDistinct("gt").alias("gt_bodies"), F.countDistinct("seg").alias("seg_bodies"))
        return found.withColumn("difference", F.col("seg_bodies") - F.col("gt_bodies"))


def evaluate(overlaps: DataFrame, names: list[str] | None = None) -> dict[str, dict[str, DataFrame]]:
    out = {}
    for name in names or sorted(MEASURES):
        measure = MEASURES[name.lower()]()
        out[name] = {"subvolumes": measure.by_subvolume(overlaps), "whole": measure.whole(overlaps), "extremes": measure.extremes(overlaps)}
    return out
