"""Queries that write volumes and tables in each format and read them back, and of small operators on tables, each with the SQL that gives the same rows.

Files are written below the shared folder; formats without a Spark writer need it mounted on all executors."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators import aggregates, diffs, edges, filters, geometry, grid, labelmap, metrics, objects, ranking, resample, volume_components
from gridloom.operators.grid import Grid
from gridloom.operators.lineage import cut, shared_dir
from gridloom.plans.registry import NINE_SQL, V_SQL, cells_sql, fd, fifty, nine, query, t
from gridloom.sources import chunks, precomputed, tables, volumes

BRICK = (4, 64, 64)
LIT_SQL = f"WITH {NINE_SQL} SELECT z, y, x, label FROM n WHERE label <> 0"


def folder(spark) -> str:
    """A new folder below the shared one, as a plain path."""
    return f"{shared_dir(spark).removeprefix('file:')}/volume-{uuid.uuid4().hex}"


def extent(voxels) -> tuple[int, int, int]:
    """Where the volume ends."""
    return tuple(grid.bounding_box(voxels).select("z1", "y1", "x1").first())


# Volumes.


@query(LIT_SQL)
def source_n5(spark, d):
    path, v = folder(spark), nine(spark, d)
    chunks.write_n5(v, path, "v/s0", extent(v), BRICK)
    return volumes.open_volume(spark, {"n5": {"path": path, "dataset": "v/s0"}})


@query(LIT_SQL + " AND z BETWEEN 2 AND 5 AND y BETWEEN 3 AND 9")
def source_zarr(spark, d):
    path, v = folder(spark), nine(spark, d)
    chunks.write_zarr(v, path, "v/s0", extent(v), BRICK, codec="zstd")
    return volumes.open_volume(spark, {"zarr": {"path": path, "dataset": "v/s0"}, "geometry": {"bounding-box": ((2, 3, -1), (6, 10, -1))}})


@query(LIT_SQL)
def source_precomputed(spark, d):
    path, v = folder(spark), nine(spark, d)
    precomputed.write_precomputed(v, path, ((0, 0, 0), extent(v)), BRICK)
    return volumes.from_url(spark, f"precomputed://file://{path}")


@query(LIT_SQL)
def source_precomputed_raw(spark, d):
    path, v = folder(spark), nine(spark, d)
    precomputed.write_precomputed(v, path, ((1, 0, 0), extent(v)), BRICK, "uint16", "raw")
    return volumes.open_volume(spark, {"tensorstore": {"spec": {"driver": "neuroglancer_precomputed", "kvstore": {"driver": "file", "path": path}}}})


@query(LIT_SQL)
def source_slices_pgm(spark, d):
    path, v = folder(spark), nine(spark, d)
    chunks.write_slices(v, path, "{:03d}.pgm", *extent(v)[1:])
    return volumes.open_volume(spark, {"slice-files": {"slice-path-format": f"{path}/{{:03d}}.pgm"}})


@query(LIT_SQL)
def source_slices_png(spark, d):
    path, v = folder(spark), nine(spark, d)
    chunks.write_slices(v, path, "{:03d}.png", *extent(v)[1:])
    return volumes.open_volume(spark, {"slice-files": {"slice-path-format": f"{path}/{{:03d}}.png"}})


@query(LIT_SQL)
def source_bricks(spark, d):
    path = folder(spark)
    volumes.write_bricks(nine(spark, d), path, Grid(BRICK))
    return volumes.open_volume(spark, {"bricks": {"path": path, "block-shape": BRICK}}).where("label <> 0")


@query(f"WITH {NINE_SQL} SELECT z + 10 AS z, y - 5 AS y, x, label FROM n")
def source_voxels(spark, d):
    path = folder(spark)
    volumes.write_voxels(nine(spark, d), path, Grid((4, 500, 500)))
    return volumes.open_volume(spark, {"parquet": {"path": path, "scale": 0}, "adapters": {"translate": (10, -5, 0)}}).select(*AXES, "label")


# Tables.


def _stats(spark, d):
    return t(spark, d, "lineitem").select(F.col("l_suppkey").alias("body_id"), F.col("l_partkey").alias("segment_id"), F.col("l_linenumber").alias("z"), F.col("l_suppkey").cast("int").alias("y"), F.pmod("l_orderkey", F.lit(500)).cast("int").alias("x"), F.col("l_quantity").cast("long").alias("count"))


STATS_SQL = "st AS (SELECT l_suppkey AS body_id, l_partkey AS segment_id, l_linenumber AS z, l_suppkey::INT AS y, (l_orderkey % 500)::INT AS x, l_quantity::BIGINT AS count FROM lineitem)"


@query(f"WITH {STATS_SQL} SELECT body_id, segment_id, z, y, x, (2 * sum(count))::BIGINT AS count FROM st GROUP BY ALL")
def sink_stats_appended(spark, d):
    path = folder(spark)
    volumes.append_stats(_stats(spark, d), path)
    volumes.append_stats(_stats(spark, d), path)
    return tables.block_stats(spark, path).groupBy("body_id", "segment_id", *AXES).agg(F.sum("count").alias("count"))


@query(f"WITH {STATS_SQL} SELECT segment_id, {fd('z', 64)} AS z, {fd('y', 64)} AS y, {fd('x', 64)} AS x, sum(count)::BIGINT AS count FROM st GROUP BY ALL")
def sink_blocks_csv(spark, d):
    path = folder(spark)
    volumes.export_blocks(_stats(spark, d), path)
    return spark.read.option("header", True).schema("segment_id long, z long, y long, x long, count long").csv(path)


@query("WITH r AS (SELECT c_nationkey AS g, o_custkey AS a, o_orderkey AS b, (row_number() OVER (PARTITION BY c_nationkey ORDER BY o_custkey, o_orderkey) - 1) // 1000 AS k FROM orders JOIN customer ON o_custkey = c_custkey) SELECT g::BIGINT AS \"group\", k::INT AS chunk, count(*)::BIGINT AS n, arg_min(b, (a, b)) AS first, arg_max(b, (a, b)) AS last FROM r GROUP BY 1, 2")
def sink_assignments(spark, d):
    path = folder(spark)
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    volumes.write_assignments(rows.select(F.col("c_nationkey").cast("long").alias("group"), F.col("o_custkey").alias("label_a"), F.col("o_orderkey").alias("label_b")), path, 1000)
    tasks = spark.read.text(path).select(F.col("group").cast("long").alias("group"), F.col("chunk").cast("int").alias("chunk"), F.from_json("value", "array<struct<label_a:long,label_b:long>>").alias("t"))
    return tasks.select("group", "chunk", F.size("t").cast("long").alias("n"), F.element_at("t", 1)["label_b"].alias("first"), F.element_at("t", -1)["label_b"].alias("last"))


@query(f"WITH {STATS_SQL}, c AS (SELECT body_id, segment_id, {fd('z', 64)} AS bz, {fd('y', 64)} AS b, {fd('x', 64)} AS bx, sum(count) AS n FROM st GROUP BY ALL) SELECT body_id, segment_id, count(*)::BIGINT AS blocks, sum(n)::BIGINT AS count, 7::BIGINT AS last_mutid FROM c GROUP BY 1, 2")
def sink_label_index(spark, d):
    path = folder(spark)
    volumes.write_label_index(aggregates.label_index(_stats(spark, d)), path, 7, "user")
    stamped = spark.read.parquet(path)
    return aggregates.unnest_index(stamped).groupBy("body_id", "segment_id").agg(F.count("*").alias("blocks"), F.sum("count").alias("count")).crossJoin(stamped.agg(F.max("last_mutid").alias("last_mutid")))  # one row


@query("SELECT DISTINCT c_nationkey::BIGINT AS label FROM customer")
def source_label_list(spark, d):
    path = f"{folder(spark)}.csv"
    t(spark, d, "customer").select(F.col("c_custkey").alias("sv"), F.col("c_nationkey").alias("body")).write.option("header", True).csv(path)
    return tables.label_list(spark, path)


@query('SELECT DISTINCT c_custkey AS label, c_nationkey::BIGINT AS "group" FROM customer')
def source_label_groups(spark, d):
    path = f"{folder(spark)}.csv"
    t(spark, d, "customer").select(F.col("c_custkey").alias("sv"), F.col("c_nationkey").alias("group")).write.option("header", True).csv(path)
    return tables.label_groups(spark, path)


@query("SELECT DISTINCT least(l_partkey, l_suppkey) AS id_a, greatest(l_partkey, l_suppkey) AS id_b FROM lineitem")
def source_merge_table(spark, d):
    path = folder(spark)
    t(spark, d, "lineitem").select(F.col("l_partkey").alias("id_a"), F.col("l_suppkey").alias("id_b")).write.parquet(path)
    return tables.merge_table(spark, path)


@query("SELECT o_orderkey AS orig, min(o_orderkey) OVER (PARTITION BY o_custkey) AS new FROM orders")
def source_equivalences(spark, d):
    """Orders of a customer are one component, named by its least order; the edges lead from each order to the customer's next."""
    path = folder(spark)
    after = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    t(spark, d, "orders").select("o_orderkey", F.coalesce(after, "o_orderkey").alias("next")).write.option("header", True).csv(f"{path}/edges.csv")
    return tables.cached_mapping(spark, f"{path}/edges.csv", f"{path}/mapping.csv")


# Small operators on tables.


@query("WITH o AS (SELECT l_suppkey AS label, l_linenumber AS class_id, sum(l_quantity::BIGINT) AS voxels FROM lineitem GROUP BY 1, 2), s AS (SELECT label, sum(voxels)::BIGINT AS total, sum(CASE WHEN class_id IN (1, 2, 3) THEN voxels ELSE 0 END)::BIGINT AS inside FROM o GROUP BY 1) SELECT label, total, inside, inside::DOUBLE / total AS fraction FROM s WHERE total >= 100 AND inside::DOUBLE / total >= 0.43")
def overlap_bodies(spark, d):
    o = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("label"), F.col("l_linenumber").alias("class_id")).agg(F.sum(F.col("l_quantity").cast("long")).alias("voxels"))
    return filters.overlap_bodies(o, 100, 0.43, [1, 2, 3])


@query("WITH p AS (SELECT o_orderpriority AS subvolume, o_custkey AS body, count(*) AS size, bool_or(o_orderstatus = 'F') AS b FROM orders GROUP BY 1, 2), g AS (SELECT subvolume, count(*) AS n FROM p WHERE size < 3 AND NOT b GROUP BY 1), q AS (SELECT o_orderpriority AS subvolume, o_custkey % 100 AS body, count(*) AS size, bool_or(o_orderstatus = 'F') AS b FROM orders GROUP BY 1, 2), s AS (SELECT subvolume, count(*) AS n FROM q WHERE size < 3 AND NOT b GROUP BY 1) SELECT subvolume, (coalesce(s.n, 0) - coalesce(g.n, 0))::BIGINT AS orphans FROM g FULL JOIN s USING (subvolume)")
def orphan_difference(spark, d):
    parts = t(spark, d, "orders").select(F.col("o_orderpriority").alias("subvolume"), F.col("o_custkey").alias("body"), F.lit(1).cast("long").alias("size"), (F.col("o_orderstatus") == "F").alias("boundary"))
    return metrics.orphan_difference(parts, parts.withColumn("body", F.col("body") % 100), 3)


BOXES_SQL = f"{V_SQL}, b AS (SELECT q AS label, count(*)::BIGINT AS count, min(z) AS z0, max(z) + 1 AS z1, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1, ((max(z) + 1 - min(z))::DOUBLE * (max(y) + 1 - min(y)) * (max(x) + 1 - min(x)))::BIGINT AS box_size FROM v GROUP BY 1)"


@query(f"WITH {BOXES_SQL} SELECT *, greatest(2, 1 + floor(pow(box_size / 3000::DOUBLE, 1 / 3::DOUBLE))::INT) AS factor FROM b")
def mask_factors(spark, d):
    return objects.mask_factors(geometry.object_boxes(fifty(spark, d)), 3000, 2)


@query(f"WITH {V_SQL} SELECT min(z) AS z0, min(y) AS y0, min(x) AS x0, max(z) + 1 AS z1, max(y) + 1 AS y1, max(x) + 1 AS x1 FROM v WHERE z >= 2 AND z < 6 AND y >= 3 AND y < 10 AND x >= 0 AND x < 150")
def bounding_box(spark, d):
    return grid.bounding_box(filters.box_filter(fifty(spark, d), ((2, 3, 0), (6, 10, 150))))


@query("SELECT DISTINCT c_custkey AS label FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def labels_without_index(spark, d):
    return grid.labels_without_index(t(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("label")), t(spark, d, "customer").select(F.col("c_custkey").alias("label")))


@query('SELECT o_orderkey AS label, o_custkey AS "group" FROM (SELECT o_orderkey, o_custkey FROM orders) UNION ALL SELECT o_orderkey + 1 AS label, o_custkey AS "group" FROM orders')
def pairs_as_groups(spark, d):
    return grid.pairs_as_groups(t(spark, d, "orders").select(F.col("o_custkey").alias("i"), F.col("o_orderkey").alias("label_a"), (F.col("o_orderkey") + 1).alias("label_b")))


@query("SELECT o_orderkey AS new, coalesce(CASE WHEN c_acctbal > 0 THEN c_nationkey::BIGINT END, o_custkey) AS orig FROM orders JOIN customer ON o_custkey = c_custkey")
def compose_and_invert(spark, d):
    first = t(spark, d, "orders").select(F.col("o_orderkey").alias("orig"), F.col("o_custkey").alias("new"))
    second = t(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("orig"), F.col("c_nationkey").cast("long").alias("new"))
    return labelmap.invert(labelmap.compose(first, second))


@query("SELECT l_orderkey, l_linenumber, l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AS done FROM lineitem")
def by_status(spark, d):
    made = t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    done, left = objects.by_status(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), made, ["l_orderkey"])
    return done.withColumn("done", F.lit(True)).unionByName(left.withColumn("done", F.lit(False)))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 9) AS share FROM lineitem")
def share_of_total(spark, d):
    return objects.share_of_total(t(spark, d, "lineitem"), "l_orderkey", "l_quantity").select("l_orderkey", "l_linenumber", F.round("share", 9).alias("share"))


@query("WITH i AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), k AS (SELECT *, l_partkey - row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS g FROM i) SELECT l_suppkey, min(l_partkey) AS l_partkey_start, max(l_partkey) + 1 AS l_partkey_stop FROM k GROUP BY l_suppkey, g")
def half_open_runs(spark, d):
    return ranking.half_open(ranking.run_lengths(t(spark, d, "lineitem"), ["l_suppkey"], "l_partkey"), "l_partkey")


@query("WITH s AS (SELECT c_nationkey::BIGINT AS label, o_custkey AS component, count(*)::BIGINT AS size FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) SELECT *, (row_number() OVER (PARTITION BY label ORDER BY size DESC, component) - 1)::INT AS rank FROM s")
def largest_piece_first(spark, d):
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return volume_components.largest_piece_first(rows.groupBy(F.col("c_nationkey").cast("long").alias("label"), F.col("o_custkey").alias("component")).agg(F.count("*").alias("size")))


@query(f"WITH {NINE_SQL}, k AS (SELECT {cells_sql((2, 4, 4))}, label, count(*) AS c FROM n GROUP BY ALL) SELECT bz::INT AS z, \"by\"::INT AS y, bx::INT AS x, arg_min(label, (-c, label)) AS label FROM k GROUP BY bz, \"by\", bx")
def reduce_blocks(spark, d):
    return resample.reduce_blocks(nine(spark, d), (2, 4, 4), aggregates.per_block_mode)


@query(f"WITH {NINE_SQL}, c AS (SELECT DISTINCT {cells_sql((4, 8, 8))} FROM n WHERE label = 5 AND x < 40), w AS (SELECT z, y, x, CASE WHEN label = 5 AND x < 40 THEN 9 ELSE label END AS label, {cells_sql((4, 8, 8))} FROM n) SELECT z, y, x, label FROM w JOIN c USING (bz, \"by\", bx)")
def changed_blocks(spark, d):
    old = nine(spark, d)
    new = old.withColumn("label", F.when((F.col("label") == 5) & (F.col("x") < 40), 9).otherwise(F.col("label")))
    return diffs.changed_blocks(new, old, Grid((4, 8, 8)))


@query(f"WITH {NINE_SQL}, e AS (SELECT a.z, a.y, a.x AS ax, b.x AS bx, a.label AS la, b.label AS lb FROM n a JOIN n b ON a.z = b.z AND a.y = b.y AND b.x = a.x + 1 WHERE a.label <> b.label AND a.label <> 0 AND b.label <> 0) SELECT e.z, e.y, la AS label_a, lb AS label_b, coalesce(va.x, ax) AS xa, coalesce(vb.x, bx) AS xb, ax AS at FROM e LEFT JOIN n va ON va.z = e.z AND va.y = e.y AND va.x = ax - 1 AND va.label = la LEFT JOIN n vb ON vb.z = e.z AND vb.y = e.y AND vb.x = bx + 1 AND vb.label = lb")
def nudge_inward(spark, d):
    v = cut(nine(spark, d))
    right = v.select("z", "y", (F.col("x") - 1).alias("x"), F.col("label").alias("label_b"))
    direct = v.withColumnRenamed("label", "label_a").join(right, list(AXES)).where("label_a <> label_b and label_a <> 0 and label_b <> 0")
    rows = direct.select("label_a", "label_b", F.col("z").alias("za"), F.col("y").alias("ya"), F.col("x").alias("xa"), F.col("z").alias("zb"), F.col("y").alias("yb"), (F.col("x") + 1).alias("xb"), F.col("x").alias("at"))
    return edges.nudge_inward(rows, v).select(F.col("za").alias("z"), F.col("ya").alias("y"), "label_a", "label_b", "xa", "xb", "at")


DIRECT_SQL = f"{NINE_SQL}, e AS (SELECT a.z, a.y, a.x AS xa, b.x AS xb, a.label AS la, b.label AS lb FROM n a JOIN n b ON a.z = b.z AND a.y = b.y AND b.x > a.x AND b.x <= a.x + 3 WHERE a.label <> b.label AND a.label <> 0 AND b.label <> 0)"


def _near(spark, d):
    """Pairs of voxels on a line, up to 3 apart, in a group for each z. The cut file is far smaller than its rows, so its size mustn't choose a broadcast."""
    v = cut(nine(spark, d))
    after = v.select("z", "y", F.explode(F.array(*[F.col("x") - k for k in (1, 2, 3)])).alias("x"), F.col("x").alias("xb"), F.col("label").alias("label_b"))
    met = v.withColumnRenamed("label", "label_a").join(after.hint("merge"), list(AXES)).where("label_a <> label_b and label_a <> 0 and label_b <> 0")
    return v, met.select(F.col("z").cast("long").alias("group"), "label_a", "label_b", F.col("z").alias("za"), F.col("y").alias("ya"), F.col("x").alias("xa"), F.col("z").alias("zb"), F.col("y").alias("yb"), "xb", (F.col("xb") - F.col("x")).cast("double").alias("distance"))


@query(f"WITH {DIRECT_SQL}, m AS (SELECT z, y, xa, xb, CASE WHEN la > 4 THEN la - 4 ELSE la END AS na, CASE WHEN lb > 4 THEN lb - 4 ELSE lb END AS nb FROM e), w AS (SELECT z::BIGINT AS \"group\", least(na, nb) AS label_a, greatest(na, nb) AS label_b, z, y, CASE WHEN na < nb THEN xa ELSE xb END AS xa, CASE WHEN na < nb THEN xb ELSE xa END AS xb, (xb - xa)::DOUBLE AS distance FROM m WHERE na <> nb) SELECT \"group\", label_a, label_b, z AS za, y AS ya, xa, z AS zb, y AS yb, xb, distance FROM w QUALIFY row_number() OVER (PARTITION BY \"group\", label_a, label_b ORDER BY distance, z, y, xa, xb) = 1")
def refresh_edges(spark, d):
    """After labels 5 to 8 have become 1 to 4."""
    v, rows = _near(spark, d)
    return edges.refresh_edges(rows, v.withColumn("label", F.when(F.col("label") > 4, F.col("label") - 4).otherwise(F.col("label"))))


@query(f"WITH {DIRECT_SQL} SELECT {fd('z', 4)}::INT AS bz, {fd('y', 64)}::INT AS \"by\", {fd('xa', 64)}::INT AS bx, la AS label_a, lb AS label_b, count(*)::BIGINT AS n FROM e GROUP BY ALL")
def sink_edges(spark, d):
    path = folder(spark)
    volumes.write_edges(_near(spark, d)[1], path, Grid((4, 64, 64)))
    return spark.read.parquet(path).groupBy("bz", "by", "bx", "label_a", "label_b").agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS segment_id, c_nationkey::BIGINT AS body_id, 9::BIGINT AS mutid FROM (SELECT DISTINCT o_custkey FROM orders) JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 20 AND c_nationkey <> 7")
def sink_mapping(spark, d):
    path = folder(spark)
    nations = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("label"))
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("segment_id")).distinct().join(t(spark, d, "customer").select(F.col("c_custkey").alias("segment_id"), F.col("c_nationkey").cast("long").alias("body_id")), "segment_id")
    volumes.write_mapping(rows, path, 9, nations.where("label < 20"), nations.where("label = 7"))
    return spark.read.parquet(path)
