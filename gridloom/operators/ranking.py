"""Ranking, pivots and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.aggregates import add_totals
from gridloom.operators.numbering import running_totals


def top_n(rows: DataFrame, key: list[str], order: list, n: int, name: str = "rank") -> DataFrame:
    """The first n rows of each key, with their rank from 1. Spark keeps n rows of a key before the shuffle."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(name) <= n)


def roi_table(stats: DataFrame, n: int) -> DataFrame:
    """For each body its n largest regions side by side (roi_k, voxels_k, fraction_k) and its total; equal sizes by name."""
    totals = add_totals(stats, "body", "voxels", "total_voxels").withColumn("fraction", F.col("voxels") / F.col("total_voxels"))
    ranked = top_n(totals, ["body"], [F.desc("voxels"), "roi"], n)
    wide = [F.max(F.when(F.col("rank") == k, F.col(c))).alias(f"{c}_{k}") for k in range(1, n + 1) for c in ("roi", "voxels", "fraction")]
    return ranked.groupBy("body").agg(F.max("total_voxels").alias("total_voxels"), *wide)


def roi_pivot(stats: DataFrame, regions: list[str], parents: dict[str, list[str]] | None = None) -> DataFrame:
    """A column of voxels for each region, 0 where a body has none, and for each parent the sum over its leaves."""
    wide = stats.groupBy("body").agg(*(F.coalesce(F.sum(F.when(F.col("roi") == r, F.col("voxels"))), F.lit(0)).alias(r) for r in regions))
    return wide.withColumns({p: sum((F.col(c) for c in leaves[1:]), F.col(leaves[0])) for p, leaves in (parents or {}).items()})


def leaves_of(children: dict[str, list[str]]) -> dict[str, list[str]]:
    """All leaves under each inner node of a hierarchy."""

    def below(node: str) -> list[str]:
        return [leaf for c in children[node] for leaf in below(c)] if children.get(node) else [node]

    return {n: sorted(below(n)) for n in children if children[n]}


def best_overlap(overlaps: DataFrame, key: str, other: str, value: str) -> DataFrame:
    """For each key the other label with the largest summed value, the least label at a tie."""
    sums = overlaps.groupBy(key, other).agg(F.sum(value).alias(value))
    best = sums.groupBy(key).agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(other).alias("o"))).alias("_b"))
    return best.select(key, F.col("_b.o").alias(other), (-F.col("_b.v")).alias(value))


def sort_stats(stats: DataFrame) -> DataFrame:
    return stats.orderBy("body_id", *AXES, "segment_id", "count")


def batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Rows with the number of a batch of whole keys, in order, of about `size` rows each: a key goes where the rows before it put it."""
    counts = rows.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
    placed = running_totals(counts, ["_k"], {"_before": "_n"}).select("_k", F.call_function("div", F.col("_before"), F.lit(size).cast("long")).alias("batch"))
    return rows.join(placed, F.col(key) == F.col("_k")).drop("_k")


def run_lengths(points: DataFrame, line: list[str], at: str) -> DataFrame:
    """Runs of consecutive values along each line: line, start, stop (both inside), from distinct points."""
    rows = points.select(*line, at).distinct()
    island = F.col(at) - F.row_number().over(Window.partitionBy(*line).orderBy(at))
    return rows.withColumn("_i", island).groupBy(*line, "_i").agg(F.min(at).alias(f"{at}_start"), F.max(at).alias(f"{at}_stop")).drop("_i")


def expand_runs(runs: DataFrame, line: list[str], at: str) -> DataFrame:
    return runs.select(*line, F.explode(F.sequence(F.col(f"{at}_start"), F.col(f"{at}_stop"))).alias(at))


def half_open(runs: DataFrame, at: str) -> DataFrame:
    return runs.withColumn(f"{at}_stop", F.col(f"{at}_stop") + 1)
