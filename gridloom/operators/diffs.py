"""What changed: between indexes, mappings, blocks and components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators.grid import Grid

CELL = [*AXES, "segment_id"]


def subtract_index(old: DataFrame, erased: DataFrame, keys: list[str] = CELL, count: str = "count") -> DataFrame:
    """Rows of either side: old, erased and new counts; unexpected where something is erased that wasn't there. New is null where nothing is left."""
    a = old.groupBy(*keys).agg(F.sum(count).alias("old_count"))
    b = erased.groupBy(*keys).agg(F.sum(count).alias("erased_count"))
    both = a.join(b, keys, "full_outer").withColumn("unexpected", F.col("old_count").isNull())
    left = F.coalesce("old_count", F.lit(0)) - F.coalesce("erased_count", F.lit(0))
    return both.withColumn("new_count", F.when(left > 0, left))


def tombstones(old: DataFrame, erased: DataFrame, body: str = "body_id", keys: list[str] = CELL) -> DataFrame:
    """Bodies of which nothing is left."""
    diff = subtract_index(old, erased, [body, *keys])
    return diff.where(~F.col("unexpected")).groupBy(body).agg(F.count("new_count").alias("_n")).where("_n = 0").select(body)


def compare_mappings(old: DataFrame, new: DataFrame) -> DataFrame:
    """(body, change): bodies of (segment, body) mappings that were dropped, added, or whose members changed in number or in content."""

    def sets(m: DataFrame, s: str) -> DataFrame:
        return m.groupBy(F.col("body").alias(f"body_{s}")).agg(F.count("*").alias(f"n_{s}"), F.array_sort(F.collect_list("segment")).alias(f"members_{s}"))

    both = sets(old, "o").join(sets(new, "n"), F.col("body_o") == F.col("body_n"), "full_outer")
    change = F.when(F.col("body_n").isNull(), "dropped").when(F.col("body_o").isNull(), "added").when(F.col("n_o") != F.col("n_n"), "size").when(F.col("members_o") != F.col("members_n"), "content")
    return both.select(F.coalesce("body_o", "body_n").alias("body"), change.alias("change")).where("change is not null")


def block_diff(new: DataFrame, old: DataFrame, grid: Grid) -> DataFrame:
    """(bz, by, bx, change): blocks that differ: new, changed or gone. A block's content is a sum of hashes of its voxels, so nothing is gathered."""

    def content(v: DataFrame, s: str) -> DataFrame:
        h = F.xxhash64(*AXES, "label").cast("decimal(38,0)")
        return v.where("label <> 0").groupBy(*grid.cells()).agg(F.count("*").alias(f"n_{s}"), F.sum(h).alias(f"h_{s}"))

    both = content(new, "new").join(content(old, "old"), ["bz", "by", "bx"], "full_outer")
    change = F.when(F.col("n_old").isNull(), "new").when(F.col("n_new").isNull(), "gone").when((F.col("n_old") != F.col("n_new")) | (F.col("h_old") != F.col("h_new")), "changed")
    return both.select("bz", "by", "bx", change.alias("change")).where("change is not null")


def changed_blocks(new: DataFrame, old: DataFrame, grid: Grid) -> DataFrame:
    """The new voxels of the blocks that differ from the stored ones."""
    cells = block_diff(new, old, grid).where("change <> 'gone'").select("bz", "by", "bx")
    return new.select("*", *grid.cells()).join(cells, ["bz", "by", "bx"], "left_semi").drop("bz", "by", "bx")


def new_labels(new: DataFrame, old: DataFrame) -> DataFrame:
    return new.where("label <> 0").select("label").distinct().join(old.select("label").distinct(), "label", "left_anti")


def split_merge(components: DataFrame, side: str) -> DataFrame:
    """(body, pieces, total, largest, remaining) of the old or new bodies that lie in several pieces; components have old, new and voxels."""
    pieces = components.groupBy("old", "new").agg(F.sum("voxels").alias("voxels"))
    out = pieces.groupBy(F.col(side).alias("body")).agg(F.count("*").alias("pieces"), F.sum("voxels").alias("total"), F.max("voxels").alias("largest"))
    return out.where("pieces > 1").withColumn("remaining", F.col("total") - F.col("largest"))


def intersection_components(old_edges: DataFrame, new_edges: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(sv, old_body, new_body, piece, voxels): components of the old edges, the new ones and those in both; sizes missing are 0."""
    from gridloom.operators.components import connected_components
    from gridloom.operators.lineage import cut

    def pairs(e: DataFrame) -> DataFrame:
        return e.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()

    old, new = cut(pairs(old_edges)), cut(pairs(new_edges))
    nodes = old.union(new).select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    three = [connected_components(nodes, e).toDF("sv", n) for e, n in ((old, "old_body"), (new, "new_body"), (old.intersect(new), "piece"))]
    out = three[0].join(three[1], "sv").join(three[2], "sv")
    if sizes is None:
        return out.withColumn("voxels", F.lit(0).cast("long"))
    return out.join(sizes.select("sv", F.col("size").alias("_s")), "sv", "left").select(*out.columns, F.coalesce("_s", F.lit(0)).cast("long").alias("voxels"))


def size_bands(rows: DataFrame, value: str, bounds: list[int]) -> DataFrame:
    """(band, low, n, total) for the half-open bands between the bounds and above the last, and a TOTAL row; empty bands have zeros."""
    low = [*bounds]
    band = F.lit(None)
    for i in range(len(low) - 1, -1, -1):
        below = F.col(value) < low[i + 1] if i + 1 < len(low) else F.lit(True)
        band = F.when((F.col(value) >= low[i]) & below, F.lit(i)).otherwise(band)
    found = rows.where(F.col(value) >= low[0]).groupBy(band.cast("int").alias("_i")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    spark = rows.sparkSession
    frame = spark.createDataFrame([(i, f"{low[i]}-{low[i + 1]}" if i + 1 < len(low) else f"{low[i]}+", low[i]) for i in range(len(low))], "_i int, band string, low long")
    kind = dict(found.dtypes)["total"]
    bands = frame.join(F.broadcast(found), "_i", "left").select("band", "low", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("total", F.lit(0).cast(kind)).alias("total"))
    return bands.unionByName(bands.agg(F.sum("n").alias("n"), F.sum("total").cast(kind).alias("total")).select(F.lit("TOTAL").alias("band"), F.lit(low[0]).cast("long").alias("low"), "n", "total"))


def consistency(computed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, error): pairs that only one side has."""
    a, b = computed.select(*keys).distinct(), stored.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("error", F.lit("missing from index")).unionByName(b.join(a, keys, "left_anti").withColumn("error", F.lit("not in volume")))


def assert_disjoint(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """UNION ALL of two tables that share no key; raises when a row of both is met."""
    both = a.select(*keys).distinct().join(b.select(*keys).distinct(), keys)
    if not both.isEmpty():
        raise ValueError("the tables share keys")
    return a.unionByName(b)
