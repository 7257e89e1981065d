"""Comparing a segmentation with a ground truth, from overlaps (gt, seg, overlap)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.aggregates import add_totals
from gridloom.operators.numbering import running_totals


def with_totals(overlaps: DataFrame) -> DataFrame:
    """Overlaps with the totals of both sides."""
    return add_totals(add_totals(overlaps, "gt", "overlap", "gt_total"), "seg", "overlap", "seg_total")


def variation_of_information(overlaps: DataFrame, by: list[str] | None = None, least_gt: int = 0) -> DataFrame:
    """false_merge (entropy of gt given seg) and false_split (of seg given gt), in bits; by subvolume if asked. Small gt bodies may be left out."""
    by = by or []
    o = _totals_by(overlaps, by)
    if least_gt:
        o = o.where(F.col("gt_total") >= least_gt)
    n = F.sum("overlap")
    return o.groupBy(*by).agg((F.sum(F.col("overlap") * F.log2(F.col("seg_total") / F.col("overlap"))) / n).alias("false_merge"), (F.sum(F.col("overlap") * F.log2(F.col("gt_total") / F.col("overlap"))) / n).alias("false_split"))


def _totals_by(overlaps: DataFrame, by: list[str]) -> DataFrame:
    out = overlaps
    for side in ("gt", "seg"):
        t = overlaps.groupBy(*(F.col(b).alias(f"_{b}") for b in by), F.col(side).alias("_s")).agg(F.sum("overlap").alias(f"{side}_total"))
        on = F.col(side) == F.col("_s")
        for b in by:
            on &= F.col(b).eqNullSafe(F.col(f"_{b}"))
        out = out.join(t, on).drop("_s", *(f"_{b}" for b in by))
    return out


def body_vi(overlaps: DataFrame, side: str = "gt") -> DataFrame:
    """(body, bits): each body's share of the variation, not normalised."""
    o = with_totals(overlaps)
    return o.groupBy(F.col(side).alias("body")).agg(F.sum(F.col("overlap") * F.log2(F.col(f"{side}_total") / F.col("overlap"))).alias("bits"))


def _pairs(c: Column) -> Column:
    c = c.cast("double")
    return c * (c - 1) / 2


def rand(overlaps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """rand_merge and rand_split: pairs together in both over pairs together in seg, and in gt; 4 decimals, null without pairs."""
    by = by or []

    def sums(rows: DataFrame, value: str, name: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.sum(_pairs(F.col(value))).alias(name))

    both = sums(overlaps.groupBy(*by, "gt", "seg").agg(F.sum("overlap").alias("o")), "o", "_both")
    out = both
    for side in ("seg", "gt"):
        s = sums(overlaps.groupBy(*by, side).agg(F.sum("overlap").alias("o")), "o", f"_{side}")
        out = out.join(s, by) if by else out.crossJoin(s)  # one row each
    ratio = lambda d: F.round(F.when(F.col(d) > 0, F.col("_both") / F.col(d)), 4)
    return out.select(*by, ratio("_seg").alias("rand_merge"), ratio("_gt").alias("rand_split"))


def extremes(by_subvolume: DataFrame, key: str, value: str) -> DataFrame:
    """Worst, best and average of a metric over subvolumes."""
    return by_subvolume.agg(F.min_by(key, F.struct(value, key)).alias("least_at"), F.min(value).alias("least"), F.max_by(key, F.struct(value, key)).alias("most_at"), F.max(value).alias("most"), F.avg(value).alias("average"))


def _reaching(sizes: DataFrame, size: str, goals: list[tuple[int, float]], name: str) -> DataFrame:
    """(percent, name): how many rows, largest first, add up to each goal. Rows of one size are counted together, so what is ordered is the distinct sizes."""
    spark = sizes.sparkSession
    by_size = sizes.groupBy(F.col(size).alias("s")).agg(F.count("*").alias("n")).withColumn("v", F.col("n") * F.col("s"))
    run = running_totals(by_size, [F.desc("s")], {"n0": "n", "v0": "v"})
    wanted = F.broadcast(spark.createDataFrame(goals, "percent int, goal double"))
    reached = run.join(wanted, (F.col("v0") < F.col("goal")) & (F.col("v0") + F.col("v") >= F.col("goal")))
    found = reached.select("percent", (F.col("n0") + F.ceil((F.col("goal") - F.col("v0")) / F.col("s"))).cast("long").alias(name))
    none = spark.createDataFrame([(p, 0) for p, g in goals if g <= 0], f"percent int, {name} long")
    return found.unionByName(none)


def bodies_to_reach(sizes: DataFrame, percents: tuple[int, ...] = (50, 75, 90), size: str = "size") -> DataFrame:
    """(percent, n_bodies): how many bodies, largest first, hold so much of the whole."""
    total = sizes.agg(F.sum(size)).first()[0] or 0
    return _reaching(sizes, size, [(p, float(total) * p / 100) for p in percents], "n_bodies")


def edits_to_reach(overlaps: DataFrame, percents: tuple[int, ...] = (50, 75, 90)) -> DataFrame:
    """(percent, n_merges, n_splits): greedy edits, largest gain first, until so much of the volume is right. Before any edit each
    gt body has its best seg body's part (merges) and each seg body its best gt body's (splits)."""
    out = None
    for side, other, name in (("gt", "seg", "n_merges"), ("seg", "gt", "n_splits")):
        o = overlaps.groupBy(side, other).agg(F.sum("overlap").alias("overlap"))
        best = F.row_number().over(Window.partitionBy(side).orderBy(F.desc("overlap"), other))
        ranked = o.withColumn("_r", best)
        right, total = ranked.agg(F.sum(F.when(F.col("_r") == 1, F.col("overlap"))), F.sum("overlap")).first()
        goals = [(p, float(total or 0) * p / 100 - float(right or 0)) for p in percents]
        found = _reaching(ranked.where("_r > 1"), "overlap", goals, name)
        out = found if out is None else out.join(found, "percent")
    return out


def best_match(overlaps: DataFrame) -> DataFrame:
    """(gt, seg, overlap, matched): each gt body's best seg body; matched where that is over half of the seg body."""
    o = add_totals(overlaps, "seg", "overlap", "seg_total")
    best = o.groupBy("gt").agg(F.min(F.struct((-F.col("overlap")).alias("v"), F.col("seg").alias("seg"), F.col("seg_total").alias("t"))).alias("_b"))
    return best.select("gt", F.col("_b.seg").alias("seg"), (-F.col("_b.v")).alias("overlap"), (-F.col("_b.v") * 2 > F.col("_b.t")).alias("matched"))


def assign(weight: np.ndarray) -> list[tuple[int, int]]:
    """The assignment of rows to columns of largest total weight, by augmenting paths with potentials; zero weights are no match."""
    turned = weight.shape[0] > weight.shape[1]
    cost = -(weight.T if turned else weight).astype(float)
    n, m = cost.shape
    u, v, owner = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[at] = True
            row = owner[at]
            free = ~used[1:]
            slack = cost[row - 1] - u[row] - v[1:]
            better = free & (slack < least[1:])
            least[1:][better], way[1:][better] = slack[better], at
            step = np.where(free, least[1:], np.inf)
            nxt = int(step.argmin()) + 1
            delta = step[nxt - 1]
            u[owner[used]] += delta
            v[used] -= delta
            least[1:][free] -= delta
            at = nxt
            if owner[at] == 0:
                break
        while at:
            owner[at] = owner[way[at]]
            at = way[at]
    pairs = [(owner[j] - 1, j - 1) for j in range(1, m + 1) if owner[j]]
    return sorted((c, r) if turned else (r, c) for r, c in pairs if cost[r, c] < 0)


def body_matching(overlaps: DataFrame, least: int, top: int = 3) -> DataFrame:
    """(gt, seg, overlap): the one-to-one matching of largest total overlap between bodies of at least `least`, among each body's `top` overlaps.
    The candidate graph falls into components, which are solved apart; a gt body without a match has seg 0."""
    from gridloom.operators.components import components_of_edges

    o = with_totals(overlaps).where((F.col("gt_total") >= least) & (F.col("seg_total") >= least))
    rank = lambda k, other: F.row_number().over(Window.partitionBy(k).orderBy(F.desc("overlap"), other))
    near = o.withColumn("_g", rank("gt", "seg")).withColumn("_s", rank("seg", "gt")).where((F.col("_g") <= top) | (F.col("_s") <= top)).select("gt", "seg", "overlap")
    # gt bodies are even nodes and seg bodies odd ones; ids are below 2**62.
    links = near.select((F.col("gt").cast("long") * 2).alias("src"), (F.col("seg").cast("long") * 2 + 1).alias("dst"))
    found = components_of_edges(links)
    keyed = near.join(found, F.col("gt").cast("long") * 2 == F.col("node")).select("component", "gt", "seg", "overlap")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.pivot_table(index="gt", columns="seg", values="overlap", fill_value=0, aggfunc="sum")
        pairs = assign(table.to_numpy())
        return pd.DataFrame([(int(table.index[i]), int(table.columns[j]), int(table.iat[i, j])) for i, j in pairs], columns=["gt", "seg", "overlap"])

    matched = keyed.groupBy("component").applyInPandas(solve, "gt long, seg long, overlap long")
    bodies = o.select(F.col("gt").cast("long").alias("_gt")).distinct()
    return bodies.join(matched, F.col("_gt") == F.col("gt"), "left").select(F.col("_gt").alias("gt"), F.coalesce("seg", F.lit(0)).cast("long").alias("seg"), F.coalesce("overlap", F.lit(0)).cast("long").alias("overlap"))


def connection_tables(points: DataFrame, matching: DataFrame, thresholds: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """(threshold, conn_match, recall, precision) of connections (gt_pre, gt_post, seg_pre, seg_post), 4 decimals, null without pairs."""
    m = matching.where("seg <> 0").select("gt", "seg")
    gt = points.groupBy("gt_pre", "gt_post").agg(F.count("*").alias("n_gt"))
    seg = points.groupBy("seg_pre", "seg_post").agg(F.count("*").alias("n_seg"))
    pre = m.select(F.col("gt").alias("gt_pre"), F.col("seg").alias("m_pre"))
    post = m.select(F.col("gt").alias("gt_post"), F.col("seg").alias("m_post"))
    hit = points.join(pre, "gt_pre").join(post, "gt_post").where("m_pre = seg_pre and m_post = seg_post").groupBy("gt_pre", "gt_post").agg(F.count("*").alias("n_hit"))
    both = gt.join(hit, ["gt_pre", "gt_post"], "left").fillna(0, ["n_hit"])
    sums = both.agg(F.sum("n_gt").alias("_gt"), F.sum("n_hit").alias("_hit"), *(x for t in thresholds for x in (F.count_if(F.col("n_gt") >= t).alias(f"g{t}"), F.count_if((F.col("n_gt") >= t) & (F.col("n_hit") >= t)).alias(f"h{t}"))))
    other = seg.agg(*(F.count_if(F.col("n_seg") >= t).alias(f"s{t}") for t in thresholds))
    ratio = lambda a, b: F.round(F.when(F.col(b) > 0, F.col(a) / F.col(b)), 4)
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), ratio("_hit", "_gt").alias("conn_match"), ratio(f"h{t}", f"g{t}").alias("recall"), ratio(f"h{t}", f"s{t}").alias("precision")) for t in thresholds]))
    return sums.crossJoin(other).select(rows.alias("r")).select("r.*")  # one row each


def autapses(points: DataFrame, side: str = "gt") -> DataFrame:
    """(body, n): connections of bodies with themselves."""
    return points.where(F.col(f"{side}_pre") == F.col(f"{side}_post")).groupBy(F.col(f"{side}_pre").alias("body")).agg(F.count("*").alias("n"))


def orphans(parts: DataFrame, least: int) -> DataFrame:
    """(body, size) of bodies below the size that touch no boundary, from parts (body, size, boundary)."""
    return parts.groupBy("body").agg(F.sum("size").alias("size"), F.bool_or("boundary").alias("_b")).where((F.col("size") < least) & ~F.col("_b")).select("body", "size")


def orphan_difference(gt_parts: DataFrame, seg_parts: DataFrame, least: int) -> DataFrame:
    """seg orphans less gt orphans by subvolume (parts also have subvolume)."""

    def count(parts: DataFrame, name: str) -> DataFrame:
        each = parts.groupBy("subvolume", "body").agg(F.sum("size").alias("size"), F.bool_or("boundary").alias("_b")).where((F.col("size") < least) & ~F.col("_b"))
        return each.groupBy("subvolume").agg(F.count("*").alias(name))

    both = count(gt_parts, "gt").join(count(seg_parts, "seg"), "subvolume", "full_outer").fillna(0, ["gt", "seg"])
    return both.select("subvolume", (F.col("seg") - F.col("gt")).alias("orphans"))


def distribution(overlaps: DataFrame, side: str) -> DataFrame:
    """Body sizes, largest first."""
    return overlaps.groupBy(F.col(side).alias("body")).agg(F.sum("overlap").alias("size")).orderBy(F.desc("size"), "body")
