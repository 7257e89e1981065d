"""Queries of jobs, of operators on bricks and objects, and of graphs of chains, each with the SQL that gives the same rows.

Chains are the events of a user in order of time; where an event's number is a multiple of ten the chain is broken, and an island is
what lies between two breaks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES
from gridloom.operators import aggregates, diffs, edges, filters, geometry, graph, grid, metrics, resample
from gridloom.operators.grid import Grid
from gridloom.plans import registry as r
from gridloom.plans.registry import ADJ_SQL, CHAIN_SQL, NINE_SQL, OVERLAP_SQL, V_SQL, cells_sql, chain, fd, fifty, nine, overlaps, query, t
from gridloom.plans.workflows import run_job

BRICK = (4, 16, 50)
KEYS = '"bz", "by", "bx"'
#: A small box.
BOX_SQL = "box AS (SELECT z::INT AS z, y::INT AS y, x::INT AS x FROM range(1, 4) a(z), range(1, 31) b(y), range(0, 60) c(x))"
ISLAND_SQL = (
    "ev AS (SELECT event_id, user_id, ts, (event_id % 10 = 0)::INT AS brk FROM events), "
    "isl AS (SELECT event_id, user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM ev), "
    "comp AS (SELECT event_id, user_id, min(event_id) OVER (PARTITION BY user_id, k) AS piece, min(event_id) OVER (PARTITION BY user_id) AS whole, count(*) OVER (PARTITION BY user_id) AS n FROM isl)"
)


def broken(spark, d):
    return chain(spark, d).where("dst % 10 <> 0")


def corner(voxels):
    """Voxels of a small box."""
    return voxels.where("z < 4 and y <= 30 and x < 60")


# Jobs.


@query(f"WITH {NINE_SQL}, p AS (SELECT {cells_sql(BRICK)}, q AS l, label AS r FROM v JOIN n USING (z, y, x)), c AS (SELECT {KEYS}, l, r, count(*) AS k FROM p GROUP BY ALL), h AS (SELECT DISTINCT {KEYS}, r FROM c WHERE l IN (1, 2, 3)) SELECT l AS \"left\", r AS \"right\", sum(k)::BIGINT AS voxel_count FROM c JOIN h USING ({KEYS}, r) WHERE k >= 2 GROUP BY 1, 2")
def job_contingency_table(spark, d):
    return run_job(spark, "ContingencyTable", {"left": fifty(spark, d), "right": nine(spark, d), "block-shape": BRICK, "left-subset-labels": [1, 2, 3], "min-overlap-size": 2})["table"]


@query(r._SQL["relabel_components"])
def job_connected_components(spark, d):
    return run_job(spark, "ConnectedComponents", {"input": fifty(spark, d), "block-shape": (4, 32, 32)})["voxels"]


SIDES_SQL = ", ".join(f"CASE WHEN forward THEN {a} ELSE {a} + (axis = '{a}')::INT END AS {a}a" for a in AXES) + ", " + ", ".join(f"CASE WHEN NOT forward THEN {a} ELSE {a} + (axis = '{a}')::INT END AS {a}b" for a in AXES)


@query(f"WITH ce AS ({r._SQL['central_edge']}) SELECT label_a, label_b, {SIDES_SQL}, 1.0::DOUBLE AS distance, edge_area FROM ce")
def job_find_adjacencies(spark, d):
    return run_job(spark, "FindAdjacencies", {"input": nine(spark, d)})["edges"]


NEARBY_SQL = "d AS (SELECT a.label AS label_a, b.label AS label_b, a.z AS za, a.y AS ya, a.x AS xa, b.z AS zb, b.y AS yb, b.x AS xb, sqrt(((a.z - b.z) * (a.z - b.z) + (a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))::DOUBLE) AS distance FROM c a JOIN c b ON a.label < b.label AND abs(a.z - b.z) <= 6 AND abs(a.y - b.y) <= 6 AND abs(a.x - b.x) <= 6)"


@query(f"WITH {V_SQL}, c AS (SELECT z, y, x, q AS label FROM v WHERE q > 40 AND z < 4 AND y <= 30 AND x < 60), {NEARBY_SQL} SELECT label_a, label_b, min(distance) AS distance FROM d GROUP BY 1, 2 HAVING min(distance) > 1 AND min(distance) <= 6")
def job_find_nearby(spark, d):
    found = run_job(spark, "FindAdjacencies", {"input": corner(fifty(spark, d)).where("label > 40"), "find-closest-within": 6})["nearby"]
    return found.select("label_a", "label_b", "distance")


@query(r._SQL["sample_points"])
def job_sample_points(spark, d):
    points = t(spark, d, "orders").select("o_orderkey", F.lit(1).alias("z"), F.col("o_custkey").cast("int").alias("y"), F.pmod("o_orderkey", F.lit(200)).cast("int").alias("x"))
    return run_job(spark, "SamplePoints", {"input": fifty(spark, d), "points": points})["points"]


@query(f"WITH {NINE_SQL}, m AS (SELECT DISTINCT {cells_sql((8, 8, 8))} FROM n WHERE label = 8), w AS (SELECT q, {cells_sql((8, 8, 8))} FROM v) SELECT q AS body_id, q AS segment_id, (bz * 8)::INT AS z, (\"by\" * 8)::INT AS y, (bx * 8)::INT AS x, count(*)::BIGINT AS count FROM w JOIN m USING ({KEYS}) GROUP BY ALL")
def job_sparse_blockstats(spark, d):
    return run_job(spark, "SparseBlockstats", {"input": fifty(spark, d), "mask": nine(spark, d), "mask-labels": [8], "block-shape": (8, 8, 8)})["block_stats"]


@query(f"WITH {NINE_SQL} SELECT q AS body, label AS roi_id, count(*)::BIGINT AS voxels FROM v JOIN n USING (z, y, x) GROUP BY 1, 2")
def job_roi_stats(spark, d):
    return run_job(spark, "RoiStats", {"input": fifty(spark, d), "roi": nine(spark, d)})["stats"]


@query(f"WITH {NINE_SQL} SELECT (label + 100)::BIGINT AS body_id, (label + 100)::BIGINT AS segment_id, ({fd('z', 64)} * 64)::INT AS z, ({fd('y', 64)} * 64)::INT AS y, ({fd('x', 64)} * 64)::INT AS x, count(*)::BIGINT AS count FROM n WHERE label <> 0 GROUP BY ALL")
def job_copy_segmentation(spark, d):
    return run_job(spark, "CopySegmentation", {"input": nine(spark, d), "add-offset": 100})["block_stats"]


@query(f"WITH {V_SQL} SELECT z, y, x, round(q * avg(q) OVER (PARTITION BY z) / avg(q) OVER (PARTITION BY z, y), 6) AS label FROM v")
def job_copy_grayscale(spark, d):
    found = run_job(spark, "CopyGrayscale", {"input": fifty(spark, d), "contrast": "hotknife-destripe"})["voxels"]
    return found.select(*AXES, F.round("label", 6).alias("label"))


@query(f"WITH {NINE_SQL}, a AS (SELECT * FROM n WHERE label <> 0), o AS (SELECT z, y, x, CASE WHEN y = 5 THEN label + 1 ELSE label END AS label FROM a WHERE x < 100), df AS ((SELECT * FROM a EXCEPT SELECT * FROM o) UNION (SELECT * FROM o EXCEPT SELECT * FROM a)), k AS (SELECT DISTINCT {cells_sql((8, 8, 8))} FROM df), w AS (SELECT *, {cells_sql((8, 8, 8))} FROM a) SELECT z, y, x, label FROM w JOIN k USING ({KEYS})")
def job_labelmap_copy(spark, d):
    new = nine(spark, d).where("label <> 0")
    old = new.where("x < 100").withColumn("label", F.when(F.col("y") == 5, F.col("label") + 1).otherwise(F.col("label")))
    return run_job(spark, "LabelmapCopy", {"input": new, "output": old, "block-shape": (8, 8, 8)})["voxels"].select(*AXES, "label")


@query(f"WITH {NINE_SQL} SELECT z, y, x, q AS label FROM v JOIN n USING (z, y, x) WHERE label <> 0")
def job_masked_copy(spark, d):
    return run_job(spark, "MaskedCopy", {"input": fifty(spark, d), "mask": nine(spark, d)})["voxels"].select(*AXES, "label")


@query(f"WITH {NINE_SQL} SELECT {cells_sql(BRICK)}, count(*)::BIGINT AS mask_voxels FROM n WHERE label <> 0 GROUP BY ALL")
def job_mask_counts(spark, d):
    return run_job(spark, "MaskedCopy", {"input": fifty(spark, d), "mask": nine(spark, d), "block-shape": BRICK})["mask_counts"]


@query(f"WITH {V_SQL}, k AS (SELECT z, y, x FROM v WHERE q > 48), s AS (SELECT unnest([(0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)]) AS d), e AS (SELECT DISTINCT z + d[1] AS z, y + d[2] AS y, x + d[3] AS x FROM k, s) SELECT z, y, x, q AS label FROM v ANTI JOIN e USING (z, y, x)")
def job_mask_segmentation(spark, d):
    v = fifty(spark, d)
    return run_job(spark, "MaskSegmentation", {"input": v, "mask": v.where("label > 48"), "dilate": 1})["voxels"].select(*AXES, "label")


@query(f"WITH {V_SQL} SELECT 0::INT AS scale, z, {fd('y', 32)} AS ty, {fd('x', 32)} AS tx, (y % 32)::INT AS y, (x % 32)::INT AS x, q AS label FROM v")
def job_create_tiles(spark, d):
    return run_job(spark, "CreateTiles", {"input": fifty(spark, d), "tile": 32, "depth": 0})["tiles"]


@query(f"WITH {NINE_SQL}, p AS (SELECT q AS g, label AS s, count(*)::DOUBLE AS k FROM v JOIN n USING (z, y, x) WHERE label <> 0 GROUP BY 1, 2), m AS (SELECT k, sum(k) OVER () AS a, sum(k) OVER (PARTITION BY g) AS kg, sum(k) OVER (PARTITION BY s) AS ks FROM p) SELECT round(-sum(k / a * log2(k / ks)), 6) AS false_merge, round(abs(-sum(k / a * log2(k / kg))), 6) AS false_split FROM m")
def job_evaluate_seg(spark, d):
    vi = run_job(spark, "EvaluateSeg", {"ground-truth": fifty(spark, d), "segmentation": nine(spark, d)})["vi"]
    return vi.select(F.round("false_merge", 6).alias("false_merge"), F.abs(F.round("false_split", 6)).alias("false_split"))


@query(f"WITH {NINE_SQL} SELECT label AS vertex, count(*)::BIGINT AS weight FROM n WHERE label <> 0 GROUP BY 1")
def job_graph_vertices(spark, d):
    return run_job(spark, "ComputeGraph", {"input": nine(spark, d)})["vertices"]


@query(f"WITH {ADJ_SQL} SELECT label_a, label_b, count(*)::BIGINT AS weight FROM ad GROUP BY 1, 2")
def job_graph_edges(spark, d):
    return run_job(spark, "ComputeGraph", {"input": nine(spark, d)})["edges"]


@query(f"WITH {NINE_SQL} SELECT label AS body_id, (({fd('z', 64)} << 42) | ({fd('y', 64)} << 21) | {fd('x', 64)})::BIGINT AS block, label AS segment_id, count(*)::BIGINT AS count FROM n WHERE label <> 0 GROUP BY ALL")
def job_ingest_label_indices(spark, d):
    stats = aggregates.block_statistics(nine(spark, d))
    return aggregates.unnest_index(run_job(spark, "IngestLabelIndices", {"block-stats": stats})["index"])


@query(f"WITH {NINE_SQL} SELECT label, count(*)::BIGINT AS count, min(z)::BIGINT AS z0, min(y)::BIGINT AS y0, min(x)::BIGINT AS x0, (max(z) + 1)::BIGINT AS z1, (max(y) + 1)::BIGINT AS y1, (max(x) + 1)::BIGINT AS x1, (((max(z) + 1 - min(z)) * (max(y) + 1 - min(y)) * (max(x) + 1 - min(x)) + 7) // 8)::INT AS bytes FROM n WHERE label <> 0 GROUP BY 1")
def object_masks(spark, d):
    return geometry.object_masks(nine(spark, d)).select("*", F.length("mask").alias("bytes")).drop("mask")


@query(f"WITH {NINE_SQL} SELECT DISTINCT label, {cells_sql((4, 16, 20))}, 'ok' AS status FROM n WHERE label <> 0 AND z < 4 AND y <= 30 AND x < 60")
def job_grid_meshes(spark, d):
    voxels = corner(nine(spark, d)).where("label <> 0")
    return run_job(spark, "GridMeshes", {"input": voxels, "block-shape": (4, 16, 20)})["meshes"].select("label", "bz", "by", "bx", "status")


# Bricks.


INNER_SQL = " UNION ALL ".join(f"SELECT '{a}' AS axis, {cells_sql(BRICK)} FROM n WHERE label <> 0 AND {a} % {k} = 0" for a, k in zip(AXES, BRICK, strict=True))


@query(f"WITH {NINE_SQL}, f AS ({INNER_SQL}) SELECT axis, {KEYS}, count(*)::BIGINT AS n FROM f GROUP BY ALL")
def halo_faces(spark, d):
    return grid.halos(nine(spark, d).where("label <> 0"), Grid(BRICK), "inner", "lower").groupBy("axis", "bz", "by", "bx").agg(F.count("*").alias("n"))


@query(f"WITH {V_SQL}, a AS (SELECT z, y, x, q FROM v WHERE q > 30), k AS (SELECT DISTINCT {cells_sql((4, 8, 8))} FROM a), s AS (SELECT z, y, x, -q AS q, {cells_sql((4, 8, 8))} FROM v WHERE q < 45), b AS (SELECT z, y, x, q FROM s SEMI JOIN k USING ({KEYS})) SELECT coalesce(a.z, b.z) AS z, coalesce(a.y, b.y) AS y, coalesce(a.x, b.x) AS x, coalesce(a.q, b.q) AS label FROM a FULL JOIN b ON a.z = b.z AND a.y = b.y AND a.x = b.x")
def pad_bricks(spark, d):
    v = fifty(spark, d)
    return grid.pad(v.where("label > 30"), Grid((4, 8, 8)), v.where("label < 45").withColumn("label", -F.col("label")))


@query(f"WITH {NINE_SQL} SELECT z::INT AS z, y, x, label FROM n WHERE label <> 0")
def bricks_round_trip(spark, d):
    return grid.from_bricks(grid.to_bricks(nine(spark, d), Grid((8, 32, 32))), (8, 32, 32))


@query(f"WITH {V_SQL} SELECT z::INT AS z, y, x, q * 3 + 1 AS label FROM v")
def kernel_on_bricks(spark, d):
    return grid.map_bricks(fifty(spark, d), Grid((8, 32, 32)), lambda b: (b * 3 + 1) * (b > 0))


@query(f"WITH {NINE_SQL}, k AS (SELECT DISTINCT {cells_sql((1, 2, 2))} FROM n WHERE label <> 0), w AS (SELECT *, {cells_sql((1, 2, 2))} FROM n) SELECT z, y, x, label FROM w SEMI JOIN k USING ({KEYS})")
def drop_empty_bricks(spark, d):
    return grid.drop_empty(nine(spark, d), Grid((1, 2, 2)))


@query(r._SQL["sample_points"])
def sample_points_in_bricks(spark, d):
    points = t(spark, d, "orders").select("o_orderkey", F.lit(1).alias("z"), F.col("o_custkey").cast("int").alias("y"), F.pmod("o_orderkey", F.lit(200)).cast("int").alias("x"))
    bricks = Grid((8, 32, 32))
    return edges.sample_labels_in_bricks(points, grid.to_bricks(fifty(spark, d), bricks), bricks)


@query(f"WITH {NINE_SQL}, u AS (SELECT 2 * z + a AS z, 2 * y + b AS y, 2 * x + c AS x, label FROM n, range(2) i(a), range(2) j(b), range(2) k(c) WHERE label <> 0) SELECT label, count(*)::BIGINT AS n, sum(z)::BIGINT AS z, sum(y)::BIGINT AS y, sum(x)::BIGINT AS x FROM u GROUP BY 1")
def stored_at_scale(spark, d):
    up = resample.at_scale(nine(spark, d).where("label <> 0").withColumn("scale", F.lit(1)), 0, [1])
    return up.groupBy("label").agg(F.count("*").alias("n"), *(F.sum(a).alias(a) for a in AXES))


@query(f"WITH {V_SQL}, {BOX_SQL}, m AS (SELECT z, y, x FROM v WHERE z < 4 AND y BETWEEN 1 AND 30 AND x < 60 AND q < 40), o AS (SELECT * FROM box EXCEPT SELECT z, y, x FROM m), s AS (SELECT unnest([(0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)]) AS d), g AS (SELECT DISTINCT z + d[1] AS z, y + d[2] AS y, x + d[3] AS x FROM o, s) SELECT z, y, x FROM box EXCEPT SELECT z, y, x FROM g")
def eroded_mask(spark, d):
    return filters.erode(corner(fifty(spark, d)).where("label < 40 and y > 0"), ((1, 1, 0), (4, 31, 60)), 1).select(*(F.col(a).cast("int").alias(a) for a in AXES))


# Objects.


@query(f"WITH {V_SQL}, c AS (SELECT z, y, x, q AS label FROM v WHERE z < 4 AND y <= 30 AND x < 60 AND q > 44), {NEARBY_SQL} SELECT label_a, label_b, za, ya, xa, zb, yb, xb, distance FROM d WHERE distance <= 6 QUALIFY row_number() OVER (PARTITION BY label_a, label_b ORDER BY distance, za, ya, xa, zb, yb, xb) = 1")
def closest_approaches(spark, d):
    voxels = corner(fifty(spark, d)).where("label > 44")
    return edges.closest_approaches(voxels, edges.near_pairs(voxels, 6), 6)


POINTS_SQL = "p AS (SELECT (y * 1000 + x)::BIGINT AS id, z, y, x, 1 + (y + x) % 8 AS label FROM n WHERE z = 2 AND label = 0 AND y <= 40)"


@query(f"WITH {NINE_SQL}, {POINTS_SQL}, w AS (SELECT p.id, n.z AS nz, n.y AS ny, n.x AS nx, (p.z - n.z) * (p.z - n.z) + (p.y - n.y) * (p.y - n.y) + (p.x - n.x) * (p.x - n.x) AS dd FROM p JOIN n ON n.label = p.label AND abs(p.z - n.z) <= 8 AND abs(p.y - n.y) <= 8 AND abs(p.x - n.x) <= 8), b AS (SELECT * FROM w WHERE dd <= 64 QUALIFY row_number() OVER (PARTITION BY id ORDER BY dd, nz, ny, nx) = 1) SELECT p.id, p.z, p.y, p.x, p.label::BIGINT AS label, coalesce(nz, 0)::INT AS nz, coalesce(ny, 0)::INT AS ny, coalesce(nx, 0)::INT AS nx FROM p LEFT JOIN b USING (id)")
def nearest_of_label(spark, d):
    n = nine(spark, d)
    points = n.where("z = 2 and label = 0 and y <= 40").select((F.col("y") * 1000 + F.col("x")).cast("long").alias("id"), *AXES, (1 + (F.col("y") + F.col("x")) % 8).cast("long").alias("label"))
    return geometry.nearest_of_label(points, n, (4, 8))


@query(f"WITH {NINE_SQL}, {POINTS_SQL}, g AS (SELECT (y * 1000 + x)::BIGINT AS target, z, y, x, label FROM n WHERE z = 3 AND label <> 0), w AS (SELECT p.id, target, sqrt((1 + (p.y - g.y) * (p.y - g.y) + (p.x - g.x) * (p.x - g.x))::DOUBLE) AS distance FROM p JOIN g USING (label) WHERE abs(p.y - g.y) <= 5 AND abs(p.x - g.x) <= 5), b AS (SELECT * FROM w WHERE distance <= 5 QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, target) = 1) SELECT p.id, p.z, p.y, p.x, p.label::BIGINT AS label, target, distance FROM p LEFT JOIN b USING (id)")
def job_mito_distances(spark, d):
    n = nine(spark, d)
    points = n.where("z = 2 and label = 0 and y <= 40").select((F.col("y") * 1000 + F.col("x")).cast("long").alias("id"), *AXES, (1 + (F.col("y") + F.col("x")) % 8).cast("long").alias("label"))
    targets = n.where("z = 3 and label <> 0").select((F.col("y") * 1000 + F.col("x")).cast("long").alias("id"), *AXES, "label")
    return run_job(spark, "MitoDistances", {"points": points, "targets": targets, "by": "label", "radius": 5})["distances"]


@query(f"WITH {OVERLAP_SQL} SELECT gt AS body, sum(overlap)::BIGINT AS size FROM o GROUP BY 1")
def body_distribution(spark, d):
    return metrics.distribution(overlaps(spark, d), "gt")


@query(f"WITH {OVERLAP_SQL} SELECT max(a.overlap + b.overlap + c.overlap)::BIGINT AS total FROM o a, o b, o c WHERE a.seg < b.seg AND b.seg < c.seg AND a.gt <> b.gt AND b.gt <> c.gt AND a.gt <> c.gt")
def body_matching_total(spark, d):
    return metrics.body_matching(overlaps(spark, d), 1).agg(F.sum("overlap").alias("total"))


CONNECTED_SQL = "c AS (SELECT l_suppkey % 5 + 1 AS gt_pre, l_partkey % 7 + 1 AS gt_post, l_suppkey % 5 + 1 + 10 * (l_linenumber > 4)::INT AS seg_pre, l_partkey % 7 + 1 AS seg_post FROM lineitem), g AS (SELECT gt_pre, gt_post, count(*) AS n, sum((gt_pre = seg_pre)::INT) AS h FROM c GROUP BY 1, 2), s AS (SELECT count(*) AS n FROM c GROUP BY seg_pre, seg_post)"


@query(f"WITH {CONNECTED_SQL}, k(threshold) AS (VALUES (1), (30), (120)) SELECT threshold::INT AS threshold, round((SELECT sum(h) / sum(n) FROM g), 4) AS conn_match, round((SELECT count(*) FROM g WHERE n >= threshold AND h >= threshold) / nullif((SELECT count(*) FROM g WHERE n >= threshold), 0), 4) AS recall, round((SELECT count(*) FROM g WHERE n >= threshold AND h >= threshold) / nullif((SELECT count(*) FROM s WHERE n >= threshold), 0), 4) AS precision FROM k")
def connection_tables(spark, d):
    l = t(spark, d, "lineitem")  # noqa: E741
    points = l.select((F.col("l_suppkey") % 5 + 1).alias("gt_pre"), (F.col("l_partkey") % 7 + 1).alias("gt_post"), (F.col("l_suppkey") % 5 + 1 + 10 * (F.col("l_linenumber") > 4).cast("int")).alias("seg_pre"), (F.col("l_partkey") % 7 + 1).alias("seg_post"))
    matching = spark.range(1, 8).select(F.col("id").alias("gt"), F.col("id").alias("seg"))
    return metrics.connection_tables(points, matching, (1, 30, 120))


# Chains.


@query(f"WITH {ISLAND_SQL} SELECT event_id AS sv, whole AS old_body, piece AS new_body, piece, 0::BIGINT AS voxels FROM comp WHERE n > 1")
def intersection_components(spark, d):
    return diffs.intersection_components(chain(spark, d), broken(spark, d))


@query(f"WITH {ISLAND_SQL}, x AS (SELECT DISTINCT user_id, piece FROM comp WHERE piece <> whole), m AS (SELECT user_id, piece, 1000000 + row_number() OVER (ORDER BY user_id, piece) - 1 AS body FROM x) SELECT event_id AS segment, coalesce(m.body, comp.user_id)::BIGINT AS body FROM comp LEFT JOIN m ON m.user_id = comp.user_id AND m.piece = comp.piece")
def split_disconnected(spark, d):
    members = t(spark, d, "events").select(F.col("event_id").alias("segment"), F.col("user_id").cast("long").alias("body"))
    return graph.split_disconnected(members, broken(spark, d), 1_000_000)


@query(f"WITH {ISLAND_SQL} SELECT event_id AS part, piece AS body FROM comp")
def stitched_parts(spark, d):
    return graph.stitch(t(spark, d, "events").select(F.col("event_id").alias("part")), broken(spark, d).toDF("a", "b"))


@query("SELECT l_suppkey AS vertex, sum(l_quantity::BIGINT)::BIGINT AS weight FROM lineitem WHERE l_linenumber = 1 GROUP BY 1")
def graph_vertices(spark, d):
    return graph.weighted_graph(_elements(spark, d))[0]


@query("SELECT l_suppkey AS v1, l_partkey AS v2, sum(l_quantity::BIGINT)::BIGINT AS weight FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1, 2")
def graph_edges(spark, d):
    return graph.weighted_graph(_elements(spark, d))[1]


def _elements(spark, d):
    v2 = F.when(F.col("l_linenumber") == 1, F.lit(-1)).otherwise(F.col("l_partkey"))
    return t(spark, d, "lineitem").select(F.col("l_suppkey").alias("v1"), v2.alias("v2"), F.col("l_quantity").cast("long").alias("weight"))


@query(f"WITH {CHAIN_SQL}, u AS (SELECT user_id FROM events WHERE event_id = (SELECT min(src) FROM g)) SELECT src, dst FROM g JOIN events ON event_id = src WHERE user_id IN (SELECT user_id FROM u)")
def edges_of_group(spark, d):
    edges_ = chain(spark, d)
    return graph.edges_of_group(edges_, edges_.agg(F.min("src")).first()[0])


PATH_SQL = "p AS (SELECT event_id, user_id, row_number() OVER w - 1 AS step, lead(event_id) OVER w AS nxt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"


def _paths(spark, d):
    """The events of a user as one path."""
    listed = t(spark, d, "events").groupBy(F.col("user_id").cast("long").alias("group_cc")).agg(F.array_sort(F.collect_list(F.struct("ts", "event_id"))).alias("e"))
    return listed.select("group_cc", F.lit(0).alias("cc_task"), F.transform("e", lambda x: x["event_id"]).alias("path"))


@query(f"WITH {PATH_SQL} SELECT user_id::BIGINT AS group_cc, 0::INT AS cc_task, step::INT AS step, least(event_id, nxt) AS label_a, greatest(event_id, nxt) AS label_b FROM p WHERE nxt IS NOT NULL")
def paths_to_edges(spark, d):
    return edges.paths_to_edges(_paths(spark, d))


@query("WITH f AS (SELECT user_id, arg_min(event_id, (ts, event_id)) AS p, arg_max(event_id, (ts, event_id)) AS q FROM events GROUP BY 1), s AS (SELECT *, p % 7 AS ps, q % 7 AS qs, (p % 7 > q % 7) OR (p % 7 = q % 7 AND p <= q) AS first FROM f) SELECT user_id::BIGINT AS group_cc, 0::INT AS cc_task, CASE WHEN first THEN p ELSE q END AS label_a, CASE WHEN first THEN q ELSE p END AS label_b, CASE WHEN first THEN ps ELSE qs END AS size_a, CASE WHEN first THEN qs ELSE ps END AS size_b FROM s")
def endpoints(spark, d):
    sizes = t(spark, d, "events").select(F.col("event_id").alias("label"), (F.col("event_id") % 7).alias("size"))
    return edges.endpoints(_paths(spark, d), sizes)


@query(f"WITH {PATH_SQL}, l AS (SELECT user_id, arg_min(event_id, step) AS a, arg_max(event_id, step) AS b, count(*) AS n FROM p GROUP BY 1), e AS (SELECT p.user_id, step, event_id, nxt, row_number() OVER (PARTITION BY p.user_id ORDER BY step) AS k FROM p) SELECT user_id::BIGINT AS group_cc, 0::INT AS cc_task, n::BIGINT AS length FROM l WHERE n > 1")
def extract_fragments(spark, d):
    """The path between the ends of each chain: all of its events."""
    listed = _paths(spark, d).where(F.size("path") > 1).select("group_cc", F.element_at("path", 1).alias("a"), F.element_at("path", -1).alias("b"))
    ends = listed.select(F.explode(F.array("a", "b")).alias("label"))
    events = t(spark, d, "events").select(F.col("event_id").alias("src"), F.col("user_id").cast("long").alias("group_cc"))
    rows = chain(spark, d).join(events, "src").select("group_cc", F.least("src", "dst").alias("label_a"), F.greatest("src", "dst").alias("label_b"), F.lit(1.0).alias("distance"))
    return edges.extract_fragments(rows, ends).select("group_cc", "cc_task", F.size("path").cast("long").alias("length"))
