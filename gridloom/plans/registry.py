"""Queries of the grid and graph operators on the shared tables, each with the SQL that gives the same rows.

Voxels come from lineitem: z is the line number, y the supplier, x the part's place in rows of 200; the label of a place is
its least quantity (1 to 50), or that modulo 9, in which 0 is background."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.arithmetic import AXES, block_id, floor_div
from gridloom.functions.channels import normalise_channels, select_channels
from gridloom.functions.viewer import link_state
from gridloom.operators import aggregates as agg
from gridloom.operators import diffs, edges, filters, graph, grid, labelmap, metrics, objects, ranking, resample
from gridloom.operators import volume_components as vc
from gridloom.operators.grid import Grid
from gridloom.plans.measures import evaluate
from gridloom.sources.tables import groups_from_lists
from gridloom.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return contingency_table(spark, d)


# Inputs.

V_SQL = "v AS (SELECT l_linenumber AS z, l_suppkey::INT AS y, (l_partkey % 200)::INT AS x, min(l_quantity::BIGINT) AS q FROM lineitem GROUP BY 1, 2, 3)"
NINE_SQL = V_SQL + ", n AS (SELECT z, y, x, q % 9 AS label FROM v)"


def fifty(spark: SparkSession, d: str) -> DataFrame:
    """Labels 1 to 50."""
    rows = t(spark, d, "lineitem").groupBy(F.col("l_linenumber").alias("z"), F.col("l_suppkey").cast("int").alias("y"), F.pmod("l_partkey", F.lit(200)).cast("int").alias("x"))
    return rows.agg(F.min(F.col("l_quantity").cast("long")).alias("label"))


def nine(spark: SparkSession, d: str) -> DataFrame:
    """Labels 0 to 8."""
    return fifty(spark, d).withColumn("label", F.col("label") % 9)


def fd(c: str, n: int) -> str:
    """SQL for division that rounds down."""
    return f"(({c} - ((({c} % {n}) + {n}) % {n})) // {n})::BIGINT"


def cells_sql(n: tuple[int, int, int]) -> str:
    return ", ".join(f"{fd(a, k)} AS \"b{a}\"" for a, k in zip(AXES, n, strict=True))


CHAIN_SQL = "e AS (SELECT event_id AS src, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events), g AS (SELECT src, dst FROM e WHERE dst IS NOT NULL)"


def chain(spark: SparkSession, d: str) -> DataFrame:
    """Edges between successive events of a user."""
    from pyspark.sql import Window

    e = t(spark, d, "events").select(F.col("event_id").alias("src"), F.lead("event_id").over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("dst"))
    return e.where("dst is not null")


def overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Customers' nations against market segments, by account."""
    c = t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("gt"), F.xxhash64("c_mktsegment").alias("_s"), F.length("c_mktsegment").cast("long").alias("seg"))
    return c.groupBy("gt", "seg").agg(F.count("*").alias("overlap"))


OVERLAP_SQL = "o AS (SELECT c_nationkey::BIGINT AS gt, length(c_mktsegment)::BIGINT AS seg, count(*)::BIGINT AS overlap FROM customer GROUP BY 1, 2)"

# Contingency tables and histograms.


@query("SELECT l_suppkey AS \"left\", l_partkey AS \"right\", count(*)::BIGINT AS voxel_count FROM lineitem GROUP BY 1, 2")
def contingency_table(spark, d):
    return agg.contingency_table(t(spark, d, "lineitem"), "l_suppkey", "l_partkey")


@query("SELECT l_suppkey AS \"left\", count(*)::BIGINT AS voxel_count FROM lineitem GROUP BY 1")
def contingency_left_sizes(spark, d):
    return agg.side_sizes(contingency_table(spark, d), "left")


@query("SELECT l_partkey AS \"right\", count(*)::BIGINT AS voxel_count FROM lineitem GROUP BY 1")
def contingency_right_sizes(spark, d):
    return agg.side_sizes(contingency_table(spark, d), "right")


def _by_brick(spark, d):
    rows = t(spark, d, "lineitem").select("l_suppkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), floor_div("l_orderkey", 1000).alias("brick"))
    return agg.contingency_table(rows, "l_suppkey", "l_linenumber", ("brick",))


@query(f"SELECT l, r AS \"right\", sum(n)::BIGINT AS voxel_count FROM (SELECT {fd('l_orderkey', 1000)} AS b, l_suppkey AS l, l_linenumber::BIGINT AS r, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) >= 3) GROUP BY 1, 2".replace("SELECT l, r", 'SELECT l AS "left", r'))
def contingency_min_overlap_brick(spark, d):
    return agg.filtered_contingency(_by_brick(spark, d), min_overlap=3)


@query("SELECT l_suppkey AS \"left\", l_linenumber::BIGINT AS \"right\", count(*)::BIGINT AS voxel_count FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 30")
def contingency_min_overlap_global(spark, d):
    return agg.filtered_contingency(_by_brick(spark, d), min_overlap=30, by=())


@query(f"""WITH c AS (SELECT {fd('l_orderkey', 1000)} AS b, l_suppkey AS l, l_linenumber::BIGINT AS r, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
k AS (SELECT DISTINCT b, r FROM c WHERE l IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0))
SELECT l AS "left", r AS "right", sum(n)::BIGINT AS voxel_count FROM c JOIN k USING (b, r) GROUP BY 1, 2""")
def contingency_subset(spark, d):
    debt = t(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("label"))
    return agg.filtered_contingency(_by_brick(spark, d), debt)


@query(f"WITH {NINE_SQL}, m AS (SELECT n.z, n.y, n.x, n.label AS a, q AS b FROM n JOIN v USING (z, y, x)) SELECT a AS \"left\", b AS \"right\", count(*)::BIGINT AS voxel_count FROM m GROUP BY 1, 2")
def volume_contingency(spark, d):
    both = agg.overlay(nine(spark, d), fifty(spark, d))
    return agg.contingency_table(both)


@query(f"SELECT {fd('o_orderkey', 1000)} AS brick, o_custkey, count(*)::BIGINT AS count FROM orders WHERE o_custkey <> 0 GROUP BY 1, 2")
def label_histogram(spark, d):
    return agg.label_histogram(t(spark, d, "orders"), [floor_div("o_orderkey", 1000).alias("brick")], "o_custkey")


@query(f"WITH {NINE_SQL} SELECT label AS body_id, label AS segment_id, ({fd('z', 4)} * 4)::INT AS z, ({fd('y', 4)} * 4)::INT AS y, ({fd('x', 4)} * 4)::INT AS x, count(*)::BIGINT AS count FROM n WHERE label <> 0 GROUP BY 1, 2, 3, 4, 5")
def block_stats(spark, d):
    return agg.block_statistics(nine(spark, d), 4)


SV_SQL = "s AS (SELECT o_custkey AS sv, c_nationkey::BIGINT AS body, count(*)::BIGINT AS sv_size FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), b AS (SELECT *, (sum(sv_size) OVER (PARTITION BY body))::BIGINT AS body_size FROM s)"


def _counts(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("body"))
    return t(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_custkey").alias("sv"), "body", F.lit(1).cast("long").alias("count"))


@query(f"WITH {SV_SQL} SELECT * FROM b")
def body_stats(spark, d):
    return agg.body_stats(_counts(spark, d))


@query(f"WITH {SV_SQL} SELECT * FROM b WHERE sv_size BETWEEN 5 AND 20 AND body_size BETWEEN 100 AND 100000000 AND sv IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND sv NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def size_filter(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("sv"), "c_acctbal", "c_mktsegment")
    return filters.size_filter(_counts(spark, d), (5, 20), (100, 100000000), c.where("c_acctbal > 0"), c.where("c_mktsegment = 'BUILDING'"))


@query("WITH r AS (SELECT o_custkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 8 AS k, o_orderkey FROM orders) SELECT o_custkey, k::INT AS chunk, array_to_string(list(o_orderkey ORDER BY o_orderkey), ',') AS items FROM r GROUP BY 1, 2")
def distribute_lists(spark, d):
    return agg.distribute_lists(t(spark, d, "orders"), "o_custkey", "o_orderkey", 8).withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), ","))


@query(f"WITH {NINE_SQL} SELECT label, count(*)::BIGINT AS count, min(z) AS z0, max(z) + 1 AS z1, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1, count(DISTINCT ({fd('z', 8)}, {fd('y', 8)}, {fd('x', 8)}))::BIGINT AS n_blocks FROM n WHERE label <> 0 GROUP BY 1")
def segment_stats(spark, d):
    return agg.segment_stats(nine(spark, d), 8)


@query(f"WITH {NINE_SQL} SELECT label, count(*)::BIGINT AS count, min(z) AS z0, max(z) + 1 AS z1, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1 FROM n WHERE label <> 0 GROUP BY 1")
def merge_segment_stats(spark, d):
    rows = nine(spark, d).where("label <> 0")
    box = [x for a in AXES for x in (F.min(a).alias(f"{a}0"), (F.max(a) + 1).alias(f"{a}1"))]
    return agg.merge_stats(rows.groupBy("label", Grid((4, 16, 16)).cell(1).alias("_b")).agg(F.count("*").alias("count"), *box))


@query(f"WITH {NINE_SQL} SELECT label AS body_id, (({fd('z', 4)} << 42) | ({fd('y', 4)} << 21) | {fd('x', 4)})::BIGINT AS block, label AS segment_id, count(*)::BIGINT AS count FROM n WHERE label <> 0 GROUP BY 1, 2, 3")
def label_index(spark, d):
    """The nested index, unnested again."""
    return agg.unnest_index(agg.label_index(agg.block_statistics(nine(spark, d), 4), 4))


@query(f"SELECT DISTINCT (({fd('l_linenumber', 64)} << 42) | ({fd('l_suppkey', 64)} << 21) | {fd('l_partkey', 64)})::BIGINT AS block FROM lineitem")
def encode_block_id(spark, d):
    return t(spark, d, "lineitem").select(block_id("l_linenumber", "l_suppkey", "l_partkey").alias("block")).distinct()


# Grids.


@query(f"WITH {NINE_SQL} SELECT {cells_sql((2, 16, 16))}, count(*)::BIGINT AS voxels FROM n GROUP BY 1, 2, 3")
def realign_to_grid(spark, d):
    return grid.realign(nine(spark, d), Grid((2, 16, 16))).groupBy("bz", "by", "bx").agg(F.count("*").alias("voxels"))


@query(f"WITH {NINE_SQL}, h AS (SELECT *, unnest([-1, 0, 1]) AS i FROM n), k AS (SELECT *, unnest([-1, 0, 1]) AS j FROM h), c AS (SELECT DISTINCT z, y, x, {fd('z', 2)} AS bz, {fd('(y + i)', 16)} AS \"by\", {fd('(x + j)', 16)} AS bx, label FROM k) SELECT bz, \"by\", bx, count(*)::BIGINT AS voxels, sum(({fd('y', 16)} <> \"by\" OR {fd('x', 16)} <> bx)::INT)::BIGINT AS halo FROM c GROUP BY 1, 2, 3")
def split_with_halo(spark, d):
    split = grid.split_to_grid(nine(spark, d), Grid((2, 16, 16), halo=(0, 1, 1)))
    return split.groupBy("bz", "by", "bx").agg(F.count("*").alias("voxels"), F.count_if("in_halo").alias("halo"))


@query(f"WITH {V_SQL}, a AS (SELECT z, y, x, q FROM v WHERE y % 16 = 15 UNION ALL SELECT z, y, x, q FROM v WHERE y % 16 = 0) SELECT DISTINCT p.q AS label_a, r.q AS label_b FROM v p JOIN v r ON (r.z = p.z AND r.x = p.x AND r.y = p.y + 1 AND p.y % 16 = 15) OR (r.z = p.z AND r.y = p.y AND r.x = p.x + 1 AND p.x % 16 = 15) OR (r.y = p.y AND r.x = p.x AND r.z = p.z + 1 AND p.z % 4 = 3)".replace(", a AS (SELECT z, y, x, q FROM v WHERE y % 16 = 15 UNION ALL SELECT z, y, x, q FROM v WHERE y % 16 = 0)", ""))
def face_links(spark, d):
    return grid.face_links(fifty(spark, d), Grid((4, 16, 16)))


@query("SELECT (z * 13 * 7 + y * 7 + x)::BIGINT AS brick_index, z::BIGINT AS bz, y::BIGINT AS \"by\", x::BIGINT AS bx, greatest(x * 32 - 4, 0)::BIGINT AS px0, least(x * 32 + 36, 200)::BIGINT AS px1 FROM range(4) a(z), range(13) b(y), range(7) c(x)")
def brick_boxes(spark, d):
    return grid.bricks(spark, Grid((2, 8, 32), halo=(0, 0, 4)), ((0, 0, 0), (8, 101, 200))).select("brick_index", "bz", "by", "bx", "px0", F.col("px1"))


@query(f"WITH {NINE_SQL} SELECT ({fd('z', 2)} * 91 + {fd('y', 8)} * 7 + {fd('x', 32)})::BIGINT AS brick_index, count(*)::BIGINT AS n FROM n GROUP BY 1")
def brick_index(spark, d):
    return nine(spark, d).groupBy(grid.brick_index(Grid((2, 8, 32)), ((0, 0, 0), (8, 101, 200))).alias("brick_index")).agg(F.count("*").alias("n"))


@query(f"WITH {NINE_SQL} SELECT label, sum(z + 3)::BIGINT AS z, sum(199 - y)::BIGINT AS y, sum(x)::BIGINT AS x FROM n GROUP BY 1")
def translate_transpose(spark, d):
    moved = grid.translate(nine(spark, d), (3, 0, 0))
    turned = grid.transpose(moved, ("z", "1-y", "x"), ((0, 0, 0), (20, 200, 200)))
    return turned.groupBy("label").agg(*(F.sum(a).alias(a) for a in AXES))


@query(f"WITH {V_SQL}, p AS (SELECT z, y, x, 99::BIGINT AS label FROM v WHERE q > 25), s AS (SELECT z, y, x, q AS label FROM v) SELECT label, count(*)::BIGINT AS n FROM (SELECT coalesce(p.label, s.label) AS label FROM p FULL JOIN s USING (z, y, x)) GROUP BY 1")
def fill_missing(spark, d):
    v = fifty(spark, d)
    new = v.where("label > 25").withColumn("label", F.lit(99).cast("long"))
    return grid.fill_missing(new, v).groupBy("label").agg(F.count("*").alias("n"))


# Relabelling.


@query("SELECT l_orderkey, l_linenumber, coalesce(p_size::BIGINT, l_partkey) AS label FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey")
def labelmap_identity(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("label"))
    return labelmap.map_labels(rows, _sizes(spark, d))


@query("SELECT l_orderkey, l_linenumber, coalesce(p_size::BIGINT, 0) AS label FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey")
def labelmap_zero(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("label"))
    return labelmap.map_labels(rows, _sizes(spark, d), missing="zero")


def _sizes(spark, d):
    return t(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("orig"), F.col("p_size").cast("long").alias("new"))


CM_SQL = "u AS (SELECT DISTINCT l_suppkey AS p, l_linenumber::BIGINT AS c FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey <> 0), s AS (SELECT p FROM u GROUP BY p HAVING count(*) > 1), m AS (SELECT p AS \"primary\", c AS contingency, (row_number() OVER (ORDER BY p, c) + (SELECT max(p) FROM u))::BIGINT AS final FROM u WHERE p IN (SELECT p FROM s))"


def _returned(spark, d):
    return t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("left"), F.col("l_linenumber").cast("long").alias("right"))


@query(f"WITH {CM_SQL} SELECT * FROM m")
def contingent_mapping(spark, d):
    return labelmap.contingent_mapping(agg.contingency_table(_returned(spark, d)))


@query(f"WITH {CM_SQL} SELECT coalesce(final, l_suppkey) AS final, count(*)::BIGINT AS n FROM lineitem LEFT JOIN m ON l_suppkey = \"primary\" AND l_linenumber = contingency WHERE l_returnflag = 'R' GROUP BY 1")
def contingent_relabel(spark, d):
    rows = _returned(spark, d)
    return labelmap.contingent_relabel(rows, labelmap.contingent_mapping(agg.contingency_table(rows))).groupBy("final").agg(F.count("*").alias("n"))


@query("SELECT doc_id AS label, source AS tab, lang AS \"group\", (dense_rank() OVER (ORDER BY source, lang) - 1)::BIGINT AS new_group FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def renumber_groups(spark, d):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("label"), F.col("source").alias("tab"), F.col("lang").alias("group"))
    toxic = t(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("label"))
    return labelmap.renumber_groups([docs], toxic)


@query(f"WITH {NINE_SQL} SELECT CASE WHEN label <> 0 THEN label + 1000 ELSE 0 END AS label, count(*)::BIGINT AS n FROM n GROUP BY 1")
def add_offset(spark, d):
    return nine(spark, d).groupBy(labelmap.add_offset("label", 1000).alias("label")).agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS segment_id, c_nationkey::BIGINT AS body_id, (o_custkey NOT IN (SELECT DISTINCT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey)) AS segment_needs_tombstone, count(*)::BIGINT AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3")
def overwrite_body(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("orig"), F.col("c_nationkey").cast("long").alias("new"))
    stats = t(spark, d, "orders").select(F.col("o_custkey").alias("segment_id"))
    return labelmap.overwrite_body(stats, c).groupBy("segment_id", "body_id", "segment_needs_tombstone").agg(F.count("*").alias("n"))


# Regions.

ROI_SQL = "i AS (SELECT l_suppkey AS body, n_regionkey::BIGINT AS roi_id, count(*)::BIGINT AS voxels FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_suppkey <> 0 GROUP BY 1, 2), st AS (SELECT body, roi_id, voxels, coalesce(r_name, '<none>') AS roi FROM i LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 0) ON roi_id = r_regionkey)"


@query(f"WITH {ROI_SQL} SELECT * FROM st")
def roi_stats(spark, d):
    rows = t(spark, d, "lineitem").join(t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    names = t(spark, d, "region").where("r_regionkey <> 0").select(F.col("r_regionkey").cast("long").alias("roi_id"), F.col("r_name").alias("roi"))
    return agg.roi_stats(rows.select(F.col("l_suppkey").alias("body"), F.col("n_regionkey").cast("long").alias("roi_id")), names=names)


@query(f"WITH {ROI_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY voxels DESC, roi) AS r, sum(voxels) OVER (PARTITION BY body) AS tt FROM st) SELECT body, max(tt)::BIGINT AS total_voxels, " + ", ".join(f"max(CASE WHEN r = {k} THEN roi END) AS roi_{k}, max(CASE WHEN r = {k} THEN voxels END) AS voxels_{k}, max(CASE WHEN r = {k} THEN voxels / tt END) AS fraction_{k}" for k in (1, 2, 3)) + " FROM k GROUP BY 1")
def roi_table_topn(spark, d):
    return ranking.roi_table(roi_stats(spark, d), 3)


@query(f"WITH {ROI_SQL} SELECT body, " + ", ".join(f"coalesce(sum(CASE WHEN roi = '{r}' THEN voxels END), 0)::BIGINT AS \"{r}\"" for r in ("<none>", "AMERICA", "ASIA", "EUROPE")) + ", coalesce(sum(CASE WHEN roi IN ('ASIA', 'EUROPE') THEN voxels END), 0)::BIGINT AS eurasia FROM st GROUP BY 1")
def roi_pivot(spark, d):
    return ranking.roi_pivot(roi_stats(spark, d), ["<none>", "AMERICA", "ASIA", "EUROPE"], {"eurasia": ["ASIA", "EUROPE"]})


@query("WITH s AS (SELECT o_custkey, o_orderpriority, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, o_orderpriority, n FROM s QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) = 1")
def best_overlap(spark, d):
    return ranking.best_overlap(t(spark, d, "orders").select("o_custkey", "o_orderpriority", F.lit(1).cast("long").alias("n")), "o_custkey", "o_orderpriority", "n")


# Masks and filters.


@query(f"WITH {V_SQL}, m AS (SELECT z, y, x FROM v WHERE q > 25) SELECT q AS label, count(*)::BIGINT AS n FROM v JOIN m USING (z, y, x) GROUP BY 1")
def masked_copy(spark, d):
    v = fifty(spark, d)
    return filters.under_mask(v, v.where("label > 25")).groupBy("label").agg(F.count("*").alias("n"))


@query(f"WITH {NINE_SQL}, b AS (SELECT z, y, x, q AS o FROM v WHERE q > 20) SELECT label, count(*)::BIGINT AS n FROM (SELECT CASE WHEN coalesce(label, 0) IN (1, 2, 3) AND coalesce(o, 0) IN (30, 31) THEN label ELSE coalesce(o, 0) END AS label FROM n FULL JOIN b USING (z, y, x)) WHERE label <> 0 GROUP BY 1")
def combine_with_output(spark, d):
    lists = [spark.createDataFrame([(i,) for i in x], "label long") for x in ((1, 2, 3), (30, 31))]
    return filters.combine_with_output(nine(spark, d), fifty(spark, d).where("label > 20"), *lists).groupBy("label").agg(F.count("*").alias("n"))


@query(f"WITH {NINE_SQL} SELECT label AS body_id, label AS segment_id, ({fd('z', 8)} * 8)::INT AS z, ({fd('y', 8)} * 8)::INT AS y, ({fd('x', 8)} * 8)::INT AS x, count(*)::BIGINT AS count FROM n JOIN v USING (z, y, x) WHERE q > 25 AND label <> 0 GROUP BY 1, 2, 3, 4, 5")
def erased_stats(spark, d):
    return filters.erase_under(nine(spark, d), fifty(spark, d).where("label > 25"), 8)[1]


@query(f"WITH {V_SQL}, k AS (SELECT z, y, x FROM v WHERE q > 48), s AS (SELECT unnest([(0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)]) AS d) SELECT DISTINCT z + d[1] AS z, y + d[2] AS y, x + d[3] AS x FROM k, s")
def dilate(spark, d):
    return filters.dilate(fifty(spark, d).where("label > 48"))


@query(f"WITH {NINE_SQL}, s AS (SELECT q AS label, count(*) AS c, bool_or(x = 0 OR x = 199) AS e FROM v GROUP BY 1) SELECT label, c::BIGINT AS n FROM s WHERE c >= 5000 OR e OR label IN (SELECT q FROM v WHERE z = 1 OR z = 7 OR y = 0)")
def drop_tiny_interior(spark, d):
    return filters.drop_tiny_interior(fifty(spark, d), ((1, 0, 0), (8, 1 << 30, 200)), 5000).groupBy("label").agg(F.count("*").alias("n"))


@query("WITH c AS (SELECT o_custkey, o_orderpriority, count(*)::BIGINT AS size FROM orders GROUP BY 1, 2) SELECT * FROM c WHERE size >= 4 OR o_custkey IN (SELECT o_custkey FROM c GROUP BY 1 HAVING count(*) > 1)")
def spread_or_large(spark, d):
    parts = t(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("size"))
    return filters.spread_or_large(parts, "o_custkey", "size", 4)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING sum((o_orderpriority = '1-URGENT')::INT) >= 3)")
def group_min_boi(spark, d):
    return filters.groups_with_flags(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_custkey", F.col("o_orderpriority") == "1-URGENT", 3).select("o_orderkey", "o_custkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING bool_and(l_quantity > 10 AND l_discount > 0.01))")
def fragments_in_roi(spark, d):
    return filters.groups_where_all(t(spark, d, "lineitem"), ["l_orderkey"], (F.col("l_quantity") > 10) & (F.col("l_discount") > 0.01)).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, (count(*) OVER (PARTITION BY l_orderkey))::BIGINT AS n_rows FROM lineitem")
def fragment_split(spark, d):
    return filters.split_by_count(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"])


@query(f"WITH {NINE_SQL}, r AS (SELECT DISTINCT {fd('z', 4)} AS bz, {fd('y', 4)} AS \"by\", {fd('x', 4)} AS bx FROM v WHERE q = 50) SELECT label, count(*)::BIGINT AS n FROM n JOIN r ON {fd('z', 4)} = bz AND {fd('y', 4)} = \"by\" AND {fd('x', 4)} = bx GROUP BY 1")
def roi_mask(spark, d):
    blocks = fifty(spark, d).where("label = 50").select(*Grid((4, 4, 4)).cells()).distinct()
    return filters.in_roi(nine(spark, d), blocks, 4).groupBy("label").agg(F.count("*").alias("n"))


# Edges.


@query("WITH e AS (SELECT user_id, ts, event_id, event_type AS a, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events) SELECT user_id, ts, event_id, least(a, b) AS label_a, greatest(a, b) AS label_b, a < b AS forward FROM e WHERE a <> b")
def adjacency_1d(spark, d):
    return edges.line_changes(t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")


ADJ_SQL = NINE_SQL + ", b AS (SELECT * FROM n WHERE label <> 0), ad AS (" + " UNION ALL ".join(f"SELECT least(p.label, r.label) AS label_a, greatest(p.label, r.label) AS label_b, '{a}' AS axis, p.label < r.label AS forward, p.z, p.y, p.x FROM b p JOIN b r ON " + " AND ".join(f"r.{c} = p.{c}" + (" + 1" if c == a else "") for c in AXES) + " AND p.label <> r.label" for a in AXES) + ")"


@query(f"WITH {ADJ_SQL} SELECT * FROM ad")
def adjacency_3d(spark, d):
    return edges.adjacency(nine(spark, d))


@query(f"WITH {ADJ_SQL}, c AS (SELECT label_a, label_b, count(*)::BIGINT AS edge_area, sum(z::DOUBLE) / count(*) AS cz, sum(y::DOUBLE) / count(*) AS cy, sum(x::DOUBLE) / count(*) AS cx FROM ad GROUP BY 1, 2), j AS (SELECT ad.*, edge_area, round((z - cz) * (z - cz) + (y - cy) * (y - cy) + (x - cx) * (x - cx), 6) AS d FROM ad JOIN c USING (label_a, label_b)) SELECT label_a, label_b, z, y, x, axis, forward, edge_area FROM j QUALIFY row_number() OVER (PARTITION BY label_a, label_b ORDER BY d, z, y, x, axis, forward) = 1")
def central_edge(spark, d):
    return edges.central_edges(edges.adjacency(nine(spark, d)), keep=["axis", "forward"])


@query("WITH e AS (SELECT l_suppkey, l_linenumber, date_diff('day', TIMESTAMP '1992-01-01', l_shipdate)::BIGINT AS dd, l_quantity::BIGINT AS q FROM lineitem), c AS (SELECT l_suppkey, l_linenumber, sum(q)::BIGINT AS edge_area, sum(q::DOUBLE * dd) / sum(q::DOUBLE) AS cd FROM e GROUP BY 1, 2) SELECT l_suppkey, l_linenumber, dd AS day, q AS quantity, edge_area FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY round((dd - cd) * (dd - cd), 6), dd, q) AS r FROM e JOIN c USING (l_suppkey, l_linenumber)) WHERE r = 1")
def central_edge_weighted(spark, d):
    rows = t(spark, d, "lineitem").select("l_suppkey", "l_linenumber", F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("long").alias("day"), F.col("l_quantity").cast("long").alias("quantity"))
    return edges.central_edges(rows, ["l_suppkey", "l_linenumber"], ["day"], "quantity", ["quantity"])


@query("SELECT o_custkey, o_orderpriority, o_totalprice, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice, o_orderkey) = 1")
def closest_edge(spark, d):
    return edges.closest_edges(t(spark, d, "orders"), ["o_custkey", "o_orderpriority"], "o_totalprice", ["o_orderkey"])


GROUPS_SQL = "e AS (SELECT a.c_custkey AS label_a, b.c_custkey AS label_b, abs(a.c_acctbal - b.c_acctbal) AS distance FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1), g AS (SELECT c_custkey AS label, c_nationkey::BIGINT // 5 AS \"group\" FROM customer UNION SELECT c_custkey, 100 + length(c_mktsegment) FROM customer), eg AS (SELECT e.*, p.\"group\" FROM e JOIN g p ON p.label = label_a JOIN g r ON r.label = label_b AND r.\"group\" = p.\"group\")"


def _grouped(spark, d):
    c = t(spark, d, "customer")
    b = c.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_acctbal").alias("_b"))
    e = c.join(b, "c_custkey").select(F.col("c_custkey").alias("label_a"), (F.col("c_custkey") + 1).alias("label_b"), F.abs(F.col("c_acctbal") - F.col("_b")).alias("distance"))
    g = c.select(F.col("c_custkey").alias("label"), floor_div("c_nationkey", 5).alias("group")).union(c.select("c_custkey", (F.length("c_mktsegment") + 100).cast("long"))).distinct()
    return e, g


@query(f"WITH {GROUPS_SQL} SELECT * FROM eg")
def append_group_col(spark, d):
    return edges.append_groups(*_grouped(spark, d))


@query(f"WITH RECURSIVE {GROUPS_SQL}, l AS (SELECT \"group\" AS k, label_a AS a, label_b AS b FROM eg WHERE distance <= 4000 UNION ALL SELECT \"group\", label_b, label_a FROM eg WHERE distance <= 4000), r AS (SELECT \"group\" AS k, label AS a, label AS c FROM g UNION SELECT r.k, l.b, r.c FROM r JOIN l ON l.k = r.k AND l.a = r.a), m AS (SELECT k, a, min(c) AS c FROM r GROUP BY 1, 2) SELECT eg.*, CASE WHEN distance <= 4000 THEN c ELSE -1 END AS group_cc FROM eg JOIN m ON k = \"group\" AND a = label_a")
def append_group_ccs(spark, d):
    e, g = _grouped(spark, d)
    return edges.append_group_components(edges.append_groups(e, g), g, 4000.0)


@query(f"WITH {ADJ_SQL}, g(label, k) AS (VALUES (1, 1), (2, 1), (3, 1), (3, 2), (4, 2), (5, 2)), p AS (SELECT DISTINCT least(a.label, b.label) AS label_a, greatest(a.label, b.label) AS label_b FROM g a JOIN g b ON a.k = b.k AND a.label <> b.label) SELECT label_a, label_b, count(*)::BIGINT AS edge_area FROM ad JOIN p USING (label_a, label_b) GROUP BY 1, 2")
def intra_group_edges(spark, d):
    return edges.intra_group(edges.adjacency(nine(spark, d)), groups_from_lists([[1, 2, 3], [3, 4, 5]], spark)).select("label_a", "label_b", "edge_area")


@query("SELECT least(l_suppkey, l_linenumber) AS label_a, greatest(l_suppkey, l_linenumber) AS label_b, CASE WHEN l_suppkey > l_linenumber THEN l_quantity ELSE l_tax END AS za, CASE WHEN l_suppkey > l_linenumber THEN l_tax ELSE l_quantity END AS zb FROM lineitem")
def normalise_edges(spark, d):
    return edges.normalise(t(spark, d, "lineitem").select(F.col("l_suppkey").alias("label_a"), F.col("l_linenumber").cast("long").alias("label_b"), F.col("l_tax").alias("za"), F.col("l_quantity").alias("zb")))


@query("SELECT l_orderkey, l_linenumber, l_suppkey AS label_a, l_partkey AS label_b, a.s_acctbal AS bal_a, b.s_acctbal AS bal_b FROM lineitem LEFT JOIN supplier a ON a.s_suppkey = l_suppkey LEFT JOIN supplier b ON b.s_suppkey = l_partkey")
def append_attributes(spark, d):
    e = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("label_a"), F.col("l_partkey").alias("label_b"))
    return edges.append_attributes(e, t(spark, d, "supplier").select(F.col("s_suppkey").alias("label"), F.col("s_acctbal").alias("bal")))


@query(f"WITH {V_SQL} SELECT o_orderkey, 1 AS z, o_custkey::INT AS y, (o_orderkey % 200)::INT AS x, coalesce(q, 0) AS label FROM orders LEFT JOIN v ON z = 1 AND y = o_custkey AND x = o_orderkey % 200".replace("SELECT o_orderkey, 1 AS z,", "SELECT o_orderkey, 1::INT AS z,").replace("ON z = 1 AND y = o_custkey AND x =", "ON v.z = 1 AND v.y = o_custkey AND v.x ="))
def sample_points(spark, d):
    points = t(spark, d, "orders").select("o_orderkey", F.lit(1).alias("z"), F.col("o_custkey").cast("int").alias("y"), F.pmod("o_orderkey", F.lit(200)).cast("int").alias("x"))
    return edges.sample_labels(points, fifty(spark, d))


# Graphs.

REACH_SQL = CHAIN_SQL + ", l AS (SELECT src AS a, dst AS b FROM g UNION ALL SELECT dst, src FROM g), r AS (SELECT a AS n, a AS c FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.n), m AS (SELECT n AS segment, min(c) AS body FROM r GROUP BY 1)"


@query(f"WITH RECURSIVE {REACH_SQL} SELECT * FROM m")
def connected_components(spark, d):
    return graph.mapping_from_edges(chain(spark, d))


@query("WITH e AS (SELECT o_custkey AS c, min(o_orderkey) AS m, count(*)::BIGINT AS n FROM orders GROUP BY 1) SELECT m AS body, n + 1 AS size FROM e")
def component_sizes(spark, d):
    """Stars of customers (numbered after all orders) and their orders."""
    o = t(spark, d, "orders")
    return graph.component_sizes(graph.mapping_from_edges(o.select(F.col("o_orderkey").alias("src"), (F.col("o_custkey") + (1 << 40)).alias("dst"))))


@query(f"WITH RECURSIVE {REACH_SQL} SELECT body, array_to_string(list(segment ORDER BY segment), ',') AS members FROM m GROUP BY 1")
def groups_from_edges(spark, d):
    found = graph.groups_from_mapping(graph.mapping_from_edges(chain(spark, d)))
    return found.select("body", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


@query(f"WITH {CHAIN_SQL}, b AS (SELECT src AS n, dst AS m FROM g UNION SELECT dst, src FROM g) SELECT n AS node FROM b GROUP BY 1 HAVING count(*) = 1")
def leaf_nodes(spark, d):
    return graph.leaf_nodes(chain(spark, d))


@query(f"WITH {CHAIN_SQL}, k AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT src, dst FROM g JOIN k ON src = event_id WHERE i >= 3 AND i < n - 2")
def erode_leaves(spark, d):
    return graph.erode_leaves(chain(spark, d), 2)


VC_SQL = V_SQL + ", k AS (SELECT z, y, x, q, (z::BIGINT * 1000000 + y) * 1000 + x AS i FROM v), l AS (SELECT p.i AS a, r.i AS b FROM k p JOIN k r ON p.q = r.q AND abs(p.z - r.z) + abs(p.y - r.y) + abs(p.x - r.x) = 1 AND r.y BETWEEN p.y - 1 AND p.y + 1 AND r.z BETWEEN p.z - 1 AND p.z + 1), rr AS (SELECT i AS n, i AS c FROM k UNION SELECT l.b, rr.c FROM rr JOIN l ON l.a = rr.n), cc AS (SELECT n, min(c) AS c FROM rr GROUP BY 1)".replace("FROM k p JOIN k r ON p.q = r.q AND abs(p.z - r.z) + abs(p.y - r.y) + abs(p.x - r.x) = 1 AND r.y BETWEEN p.y - 1 AND p.y + 1 AND r.z BETWEEN p.z - 1 AND p.z + 1", "FROM k p, (VALUES (1000000000), (-1000000000), (1000), (-1000), (1), (-1)) s(d) JOIN k r ON r.i = p.i + s.d AND r.q = p.q WHERE abs(p.x - r.x) <= 1")


@query(f"WITH RECURSIVE {VC_SQL} SELECT q AS label, size, count(*)::BIGINT AS pieces FROM (SELECT q, c, count(*)::BIGINT AS size FROM cc JOIN k ON n = i GROUP BY 1, 2) GROUP BY 1, 2")
def volume_components(spark, d):
    found = vc.label_components(fifty(spark, d), Grid((4, 32, 32)))
    return found.groupBy("label", "component").agg(F.count("*").alias("size")).groupBy("label", "size").agg(F.count("*").alias("pieces"))


@query(f"WITH RECURSIVE {VC_SQL}, f AS (SELECT q, c FROM cc JOIN k ON c = i GROUP BY 1, 2), s AS (SELECT q FROM f GROUP BY 1 HAVING count(*) > 1), w AS (SELECT q, c, 50 + row_number() OVER (ORDER BY q, c) AS new FROM f WHERE q IN (SELECT q FROM s)) SELECT z, y, x, coalesce(new, k.q)::BIGINT AS label FROM k JOIN cc ON n = i LEFT JOIN w ON w.c = cc.c")
def relabel_components(spark, d):
    return vc.relabel_components(fifty(spark, d), Grid((4, 32, 32)))


# Resampling.

DS = (2, 4, 4)
DS_SQL = f"{fd('z', 2)}::INT AS z, {fd('y', 4)}::INT AS y, {fd('x', 4)}::INT AS x"


@query(f"WITH {NINE_SQL}, c AS (SELECT {DS_SQL}, label, count(*) AS k FROM n WHERE label <> 0 GROUP BY 1, 2, 3, 4) SELECT z, y, x, label FROM c QUALIFY row_number() OVER (PARTITION BY z, y, x ORDER BY k DESC, label) = 1")
def downsample_labels(spark, d):
    return resample.downsample(nine(spark, d), DS, "labels")


@query(f"WITH {NINE_SQL}, c AS (SELECT {DS_SQL}, label, count(*) AS k FROM n WHERE label <> 0 GROUP BY 1, 2, 3, 4), s AS (SELECT z, y, x, 32 - sum(k) AS e FROM c GROUP BY 1, 2, 3) SELECT z, y, x, label FROM c JOIN s USING (z, y, x) WHERE e < k QUALIFY row_number() OVER (PARTITION BY z, y, x ORDER BY k DESC, label) = 1")
def downsample_mode(spark, d):
    return resample.downsample(nine(spark, d), DS, "mode")


@query(f"WITH {V_SQL} SELECT {DS_SQL}, (sum(q) // 32)::BIGINT AS label FROM v GROUP BY 1, 2, 3")
def downsample_mean(spark, d):
    return resample.downsample(fifty(spark, d), DS, "block-mean")


@query(f"WITH {V_SQL} SELECT {DS_SQL}, q AS label FROM v WHERE z % 2 = 0 AND y % 4 = 0 AND x % 4 = 0")
def downsample_subsample(spark, d):
    return resample.downsample(fifty(spark, d), DS, "subsample")


@query(f"WITH {V_SQL} SELECT {DS_SQL}, 1::BIGINT AS label FROM v WHERE q <> 0 GROUP BY 1, 2, 3 HAVING count(*) > 16")
def downsample_binary(spark, d):
    return resample.downsample(fifty(spark, d), DS, "binary")


@query(f"WITH {NINE_SQL} SELECT label, count(*)::BIGINT AS n, sum(z)::BIGINT AS sz, sum(y)::BIGINT AS sy FROM (SELECT label, z * 2 + i AS z, y * 2 + j AS y FROM n, range(2) a(i), range(2) b(j)) GROUP BY 1")
def upsample(spark, d):
    return resample.upsample(nine(spark, d), (2, 2, 1)).groupBy("label").agg(F.count("*").alias("n"), F.sum("z").alias("sz"), F.sum("y").alias("sy"))


@query(f"WITH {V_SQL}, s AS (SELECT 0 AS scale, z, y, x, q AS label FROM v), a AS (SELECT 1 AS scale, {fd('z', 2)} AS z, {fd('y', 2)} AS y, {fd('x', 2)} AS x, (sum(label) // 8)::BIGINT AS label FROM s GROUP BY 1, 2, 3, 4), b AS (SELECT 2 AS scale, {fd('z', 2)} AS z, {fd('y', 2)} AS y, {fd('x', 2)} AS x, (sum(label) // 8)::BIGINT AS label FROM a GROUP BY 1, 2, 3, 4) SELECT scale, count(*)::BIGINT AS n, sum(label)::BIGINT AS total FROM (FROM s UNION ALL FROM a UNION ALL FROM b) GROUP BY 1")
def pyramid(spark, d):
    return resample.pyramid(fifty(spark, d), 2, "block-mean").groupBy("scale").agg(F.count("*").alias("n"), F.sum("label").alias("total"))


# Diffs.


@query("WITH a AS (SELECT o_custkey, o_orderstatus, count(*)::BIGINT AS old_count FROM orders WHERE o_totalprice > 50000 GROUP BY 1, 2), b AS (SELECT o_custkey, o_orderstatus, count(*)::BIGINT AS erased_count FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1, 2) SELECT o_custkey, o_orderstatus, old_count, erased_count, old_count IS NULL AS unexpected, CASE WHEN coalesce(old_count, 0) - coalesce(erased_count, 0) > 0 THEN coalesce(old_count, 0) - coalesce(erased_count, 0) END AS new_count FROM a FULL JOIN b USING (o_custkey, o_orderstatus)")
def index_subtract(spark, d):
    old, erased = _old_erased(spark, d)
    return diffs.subtract_index(old, erased, ["o_custkey", "o_orderstatus"])


def _old_erased(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", F.lit(1).cast("long").alias("count"))
    return o.where("o_totalprice > 50000"), o.where(F.col("o_orderdate") < F.to_timestamp_ntz(F.lit("1996-01-01")))


@query("WITH a AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 50000 GROUP BY 1, 2), b AS (SELECT o_custkey, o_orderstatus, count(*) AS m FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1, 2) SELECT o_custkey FROM a LEFT JOIN b USING (o_custkey, o_orderstatus) GROUP BY 1 HAVING sum((n - coalesce(m, 0) > 0)::INT) = 0")
def index_tombstones(spark, d):
    old, erased = _old_erased(spark, d)
    return diffs.tombstones(old, erased, "o_custkey", ["o_orderstatus"])


@query("WITH a AS (SELECT p_brand AS body, count(*) AS n, list(p_partkey ORDER BY p_partkey) AS m FROM part GROUP BY 1), b AS (SELECT CASE WHEN p_size > 49 THEN p_type ELSE p_brand END AS body, count(*) AS n, list(p_partkey ORDER BY p_partkey) AS m FROM part GROUP BY 1) SELECT coalesce(a.body, b.body) AS body, CASE WHEN b.body IS NULL THEN 'dropped' WHEN a.body IS NULL THEN 'added' WHEN a.n <> b.n THEN 'size' ELSE 'content' END AS change FROM a FULL JOIN b ON a.body = b.body WHERE a.m IS DISTINCT FROM b.m")
def compare_mappings(spark, d):
    p = t(spark, d, "part")
    old = p.select(F.col("p_partkey").alias("segment"), F.col("p_brand").alias("body"))
    new = p.select(F.col("p_partkey").alias("segment"), F.when(F.col("p_size") > 49, F.col("p_type")).otherwise(F.col("p_brand")).alias("body"))
    return diffs.compare_mappings(old, new)


@query(f"WITH {NINE_SQL}, b AS (SELECT {cells_sql((2, 8, 8))}, bool_or(q > 30) AS old, bool_or(label <> 0) AS new, bool_or(label <> (CASE WHEN q > 30 THEN q ELSE 0 END)) AS differ FROM n JOIN v USING (z, y, x) GROUP BY 1, 2, 3) SELECT bz, \"by\", bx, CASE WHEN NOT old THEN 'new' WHEN NOT new THEN 'gone' ELSE 'changed' END AS change FROM b WHERE (old OR new) AND differ")
def block_diff(spark, d):
    return diffs.block_diff(nine(spark, d), fifty(spark, d).where("label > 30"), Grid((2, 8, 8)))


@query(f"WITH {V_SQL} SELECT DISTINCT q AS label FROM v WHERE q <= 30 AND q <> 0")
def new_labels(spark, d):
    v = fifty(spark, d)
    return diffs.new_labels(v, v.where("label > 30"))


def _pieces(spark, d):
    return t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("old"), F.length("c_mktsegment").cast("long").alias("new"), F.lit(1).cast("long").alias("voxels"))


@query("WITH p AS (SELECT c_nationkey::BIGINT AS old, length(c_mktsegment)::BIGINT AS new, count(*)::BIGINT AS v FROM customer GROUP BY 1, 2) SELECT old AS body, count(*)::BIGINT AS pieces, sum(v)::BIGINT AS total, max(v) AS largest, (sum(v) - max(v))::BIGINT AS remaining FROM p GROUP BY 1 HAVING count(*) > 1")
def split_stats(spark, d):
    return diffs.split_merge(_pieces(spark, d), "old")


@query("WITH p AS (SELECT c_nationkey::BIGINT AS old, length(c_mktsegment)::BIGINT AS new, count(*)::BIGINT AS v FROM customer GROUP BY 1, 2) SELECT new AS body, count(*)::BIGINT AS pieces, sum(v)::BIGINT AS total, max(v) AS largest, (sum(v) - max(v))::BIGINT AS remaining FROM p GROUP BY 1 HAVING count(*) > 1")
def merge_stats(spark, d):
    return diffs.split_merge(_pieces(spark, d), "new")


BANDS = [0, 1000, 10000, 100000, 200000, 400000, 10**9]


@query("WITH b(low, high, band) AS (VALUES " + ", ".join(f"({a}, {b}, '{a}-{b}')" for a, b in zip(BANDS, BANDS[1:], strict=False)) + f", ({BANDS[-1]}, 9223372036854775807, '{BANDS[-1]}+')), r AS (SELECT band, low, count(o_orderkey)::BIGINT AS n, coalesce(sum(o_totalprice::BIGINT), 0)::BIGINT AS total FROM b LEFT JOIN orders ON floor(o_totalprice)::BIGINT >= low AND floor(o_totalprice)::BIGINT < high GROUP BY 1, 2) SELECT band, low::BIGINT AS low, n, total FROM r UNION ALL SELECT 'TOTAL', 0, sum(n)::BIGINT, sum(total)::BIGINT FROM r".replace("sum(o_totalprice::BIGINT)", "sum(floor(o_totalprice)::BIGINT)"))
def size_bands(spark, d):
    return diffs.size_bands(t(spark, d, "orders").select(F.floor("o_totalprice").alias("v")), "v", BANDS)


@query("SELECT o_custkey, c_nationkey AS k, 'missing from index' AS error FROM (SELECT DISTINCT o_custkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000) WHERE (o_custkey, c_nationkey) NOT IN (SELECT (c_custkey, c_nationkey) FROM customer WHERE c_acctbal > 0) UNION ALL SELECT c_custkey, c_nationkey, 'not in volume' FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def index_consistency(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("k"), "c_acctbal")
    seen = t(spark, d, "orders").where("o_totalprice > 300000").join(c, "o_custkey").select("o_custkey", "k")
    return diffs.consistency(seen, c.where("c_acctbal > 0"), ["o_custkey", "k"])


# Moments.

M_SQL = "count(*)::BIGINT AS n, round(avg(a), 6) AS m_a, round(avg(b), 6) AS m_b, round(covar_pop(a, a), 4) AS c_aa, round(covar_pop(a, b), 4) AS c_ab, round(covar_pop(b, b), 4) AS c_bb"


def _rounded(df):
    return df.select(*(c for c in df.columns if c[:2] not in ("m_", "c_")), *(F.round(c, 6 if c.startswith("m_") else 4).alias(c) for c in df.columns if c[:2] in ("m_", "c_")))


def _ab(spark, d):
    return t(spark, d, "events").select("event_type", "user_id", F.col("value").alias("a"), (F.col("event_id") / 100).alias("b"))


@query(f"SELECT event_type, {M_SQL} FROM (SELECT event_type, value AS a, event_id / 100 AS b FROM events) GROUP BY 1")
def moments(spark, d):
    return _rounded(agg.partial_moments(_ab(spark, d), ["event_type"], ["a", "b"]))


@query(f"SELECT event_type, {M_SQL} FROM (SELECT event_type, value AS a, event_id / 100 AS b FROM events) GROUP BY 1")
def moments_merge(spark, d):
    return _rounded(agg.merge_moments(agg.partial_moments(_ab(spark, d), ["event_type", "user_id"], ["a", "b"]), ["event_type"], ["a", "b"]))


@query(f"WITH {NINE_SQL} SELECT label, count(*)::BIGINT AS n, round(avg(z), 6) AS m_z, round(avg(y), 6) AS m_y, round(avg(x), 6) AS m_x, round(covar_pop(z, z), 4) AS c_zz, round(covar_pop(z, y), 4) AS c_zy, round(covar_pop(z, x), 4) AS c_zx, round(covar_pop(y, y), 4) AS c_yy, round(covar_pop(y, x), 4) AS c_yx, round(covar_pop(x, x), 4) AS c_xx FROM n WHERE label <> 0 GROUP BY 1")
def object_moments(spark, d):
    return _rounded(agg.object_stats(nine(spark, d)))


@query(f"WITH {NINE_SQL}, k AS (SELECT label, (CASE WHEN z < 4 THEN 3 ELSE 4 END) AS class FROM n WHERE label <> 0) SELECT label, sum((class = 3)::INT)::BIGINT AS class_3, sum((class = 4)::INT)::BIGINT AS class_4 FROM k GROUP BY 1")
def object_classes(spark, d):
    v = nine(spark, d)
    classes = v.withColumn("label", F.when(F.col("z") < 4, 3).otherwise(4))
    return agg.object_stats(v, classes).select("label", *(F.col("classes")[k].alias(f"class_{k}") for k in (3, 4)))


# Evaluation.

VI = "w AS (SELECT *, sum(overlap) OVER (PARTITION BY gt) AS g, sum(overlap) OVER (PARTITION BY seg) AS s FROM o)"


@query(f"WITH {OVERLAP_SQL}, {VI} SELECT round(sum(overlap * log2(s / overlap)) / sum(overlap), 9) AS false_merge, round(sum(overlap * log2(g / overlap)) / sum(overlap), 9) AS false_split FROM w")
def variation_of_information(spark, d):
    return metrics.variation_of_information(overlaps(spark, d)).select(F.round("false_merge", 9).alias("false_merge"), F.round("false_split", 9).alias("false_split"))


@query("WITH o AS (SELECT source, lang AS gt, n_chars // 500 AS seg, count(*) AS overlap FROM documents GROUP BY 1, 2, 3), w AS (SELECT *, sum(overlap) OVER (PARTITION BY source, gt) AS g, sum(overlap) OVER (PARTITION BY source, seg) AS s FROM o) SELECT source, round(sum(overlap * log2(s / overlap)) / sum(overlap), 9) AS false_merge, round(sum(overlap * log2(g / overlap)) / sum(overlap), 9) AS false_split FROM w GROUP BY 1")
def vi_by_subvolume(spark, d):
    o = t(spark, d, "documents").groupBy("source", F.col("lang").alias("gt"), floor_div("n_chars", 500).alias("seg")).agg(F.count("*").alias("overlap"))
    return metrics.variation_of_information(o, ["source"]).select("source", F.round("false_merge", 9).alias("false_merge"), F.round("false_split", 9).alias("false_split"))


@query(f"WITH {OVERLAP_SQL}, {VI} SELECT gt AS body, round(sum(overlap * log2(g / overlap)), 6) AS bits FROM w GROUP BY 1")
def body_vi(spark, d):
    return metrics.body_vi(overlaps(spark, d)).select("body", F.round("bits", 6).alias("bits"))


@query(f"WITH {OVERLAP_SQL}, p AS (SELECT sum(overlap * (overlap - 1) / 2) AS k FROM o), s AS (SELECT sum(n * (n - 1) / 2) AS k FROM (SELECT sum(overlap) AS n FROM o GROUP BY seg)), g AS (SELECT sum(n * (n - 1) / 2) AS k FROM (SELECT sum(overlap) AS n FROM o GROUP BY gt)) SELECT round(p.k / s.k, 4)::DOUBLE AS rand_merge, round(p.k / g.k, 4)::DOUBLE AS rand_split FROM p, s, g")
def rand_index(spark, d):
    return metrics.rand(overlaps(spark, d))


@query("WITH s AS (SELECT l_suppkey, sum(l_quantity::BIGINT) AS v FROM lineitem GROUP BY 1), c AS (SELECT sum(v) OVER (ORDER BY v DESC, l_suppkey) AS c, row_number() OVER (ORDER BY v DESC, l_suppkey) AS r, (SELECT sum(v) FROM s) AS t FROM s) SELECT p::INT AS percent, min(r)::BIGINT AS n_bodies FROM c, (VALUES (50), (75), (90)) q(p) WHERE c >= t * p / 100.0 GROUP BY 1")
def cumulative_threshold(spark, d):
    return metrics.bodies_to_reach(t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("body")).agg(F.sum(F.col("l_quantity").cast("long")).alias("size")))


@query(f"WITH {OVERLAP_SQL}, s AS (SELECT seg, sum(overlap) AS n FROM o GROUP BY 1) SELECT gt, seg, overlap, overlap * 2 > n AS matched FROM o JOIN s USING (seg) QUALIFY row_number() OVER (PARTITION BY gt ORDER BY overlap DESC, seg) = 1")
def best_match(spark, d):
    return metrics.best_match(overlaps(spark, d))


def _edit_sql(side: str, other: str, name: str) -> str:
    return f"SELECT p AS percent, (SELECT count(*) FROM (SELECT coalesce(sum(overlap) OVER (ORDER BY overlap DESC, gt, seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM k_{side} WHERE r > 1) WHERE b < t * p / 100.0 - (SELECT sum(overlap) FROM k_{side} WHERE r = 1)) AS {name} FROM (VALUES (50), (75), (90)) q(p), (SELECT sum(overlap) AS t FROM o)"


@query(f"WITH {OVERLAP_SQL}, k_gt AS (SELECT *, row_number() OVER (PARTITION BY gt ORDER BY overlap DESC, seg) AS r FROM o), k_seg AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY overlap DESC, gt) AS r FROM o), a AS ({_edit_sql('gt', 'seg', 'n_merges')}), b AS ({_edit_sql('seg', 'gt', 'n_splits')}) SELECT a.percent::INT AS percent, n_merges::BIGINT AS n_merges, n_splits::BIGINT AS n_splits FROM a JOIN b USING (percent)")
def edit_distance(spark, d):
    return metrics.edits_to_reach(overlaps(spark, d))


@query()
def body_matching(spark, d):
    return metrics.body_matching(overlaps(spark, d), 1)


@query("WITH c AS (SELECT c_nationkey AS a, (c_custkey % 25)::INT AS b FROM customer) SELECT a AS body, count(*)::BIGINT AS n FROM c WHERE a = b GROUP BY 1")
def autapses(spark, d):
    return metrics.autapses(t(spark, d, "customer").select(F.col("c_nationkey").alias("gt_pre"), F.pmod("c_custkey", F.lit(25)).cast("int").alias("gt_post")))


@query("SELECT o_custkey AS body, count(*)::BIGINT AS size FROM orders GROUP BY 1 HAVING count(*) < 12 AND NOT bool_or(o_orderstatus = 'P')")
def orphans(spark, d):
    return metrics.orphans(t(spark, d, "orders").select(F.col("o_custkey").alias("body"), F.lit(1).cast("long").alias("size"), (F.col("o_orderstatus") == "P").alias("boundary")), 12)


# Runs, batches, ranks.

RUN_SQL = "p AS (SELECT DISTINCT user_id, date_diff('day', TIMESTAMP '2024-01-01', ts)::INT AS day FROM events), i AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS g FROM p)"


def _days(spark, d):
    return t(spark, d, "events").select("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("day"))


@query(f"WITH {RUN_SQL} SELECT user_id, min(day) AS day_start, max(day) AS day_stop FROM i GROUP BY user_id, g")
def rle_encode(spark, d):
    return ranking.run_lengths(_days(spark, d), ["user_id"], "day")


@query(f"WITH {RUN_SQL} SELECT user_id, day FROM p")
def rle_decode(spark, d):
    return ranking.expand_runs(rle_encode(spark, d), ["user_id"], "day")


@query("WITH c AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT k, (sum(n) OVER (ORDER BY k) - n)::BIGINT // 500 AS batch FROM c) SELECT o_orderkey, o_custkey, batch FROM orders JOIN b ON k = o_custkey")
def batches(spark, d):
    return ranking.batches(t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 500)


@query("SELECT c_custkey, c_nationkey, c_acctbal, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 5")
def top_n(spark, d):
    return ranking.top_n(t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 5)


# Lookups, changes, text.


@query(f"WITH {NINE_SQL}, i AS (SELECT DISTINCT label, z, y, x FROM n WHERE label IN (1, 2)) SELECT DISTINCT ({fd('z', 4)} * 4)::BIGINT AS z, ({fd('y', 16)} * 16)::BIGINT AS y, ({fd('x', 16)} * 16)::BIGINT AS x, label FROM i")
def sparse_bricks(spark, d):
    return grid.cells_of_labels(nine(spark, d), spark.createDataFrame([(1,), (2,)], "label long"), Grid((4, 16, 16)))


@query(f"WITH {V_SQL}, g(label, k) AS (VALUES (48, 1), (49, 1), (50, 2), (1, 2)), i AS (SELECT DISTINCT ({fd('z', 4)} * 4)::BIGINT AS z, ({fd('y', 8)} * 8)::BIGINT AS y, ({fd('x', 8)} * 8)::BIGINT AS x, k, label FROM v JOIN g ON q = label) SELECT z, y, x, k::BIGINT AS \"group\", label::BIGINT AS label FROM i QUALIFY count(*) OVER (PARTITION BY z, y, x, k) >= 2")
def sparse_bricks_of_groups(spark, d):
    return grid.cells_of_groups(fifty(spark, d), groups_from_lists([[48, 49], [50, 1]], spark), Grid((4, 8, 8)))


@query("SELECT DISTINCT user_id AS label FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 150)")
def changed_ids(spark, d):
    e = t(spark, d, "events")
    log = e.select("ts", F.col("event_type").alias("action"), F.array("user_id").alias("ids"))
    return changes.changed_labels(log, "2024-01-15", e.where("event_type = 'error' and value > 150").select(F.col("user_id").alias("label")))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS action, count(*)::BIGINT AS n FROM events GROUP BY 1, 2")
def mutation_activity(spark, d):
    log = t(spark, d, "events").select("ts", F.col("event_type").alias("action"))
    return changes.activity(log, "1 hour").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("WITH e AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), g AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS stop, count(*)::BIGINT AS n FROM g GROUP BY user_id, k")
def mutation_sessions(spark, d):
    found = changes.sessions(t(spark, d, "events"), "user_id", "6 hours")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")})


@query("SELECT DISTINCT user_id AS label, (props->>'k')::BIGINT AS \"group\" FROM events")
def label_groups_json(spark, d):
    return t(spark, d, "events").select(F.col("user_id").alias("label"), F.from_json("props", "k long")["k"].alias("group")).distinct()


@query("SELECT event_id, event_id % 7 AS zoom, event_type AS layer FROM events")
def viewer_links(spark, d):
    link = F.concat(F.lit("https://viewer/#!%7B'zoom':"), (F.col("event_id") % 7).cast("string"), F.lit("_'layer':'"), F.col("event_type"), F.lit("'%7D"))
    return t(spark, d, "events").select("event_id", link.alias("link")).select("event_id", F.from_json(link_state("link"), "zoom long, layer string").alias("s")).select("event_id", "s.zoom", "s.layer")


@query("SELECT count(*)::BIGINT AS requests, sum(l_linenumber)::BIGINT AS blocks, round(avg(l_linenumber), 9) AS blocks_per_request, round(avg(l_quantity), 9) AS seconds_per_request, round(sum(l_quantity) / sum(l_linenumber), 9) AS seconds_per_block, max(l_orderkey + l_quantity) - min(l_orderkey::DOUBLE) AS wall_s FROM lineitem")
def throughput(spark, d):
    rows = t(spark, d, "lineitem").select(F.col("l_orderkey").cast("double").alias("start_s"), F.col("l_quantity").alias("seconds"), F.col("l_linenumber").alias("blocks"))
    out = agg.throughput(rows)
    return out.select("requests", "blocks", *(F.round(c, 9).alias(c) for c in ("blocks_per_request", "seconds_per_request", "seconds_per_block")), "wall_s")


@query("WITH a AS (SELECT c_nationkey::BIGINT AS body1, length(c_mktsegment)::BIGINT AS body2, count(*) AS n FROM customer GROUP BY 1, 2) SELECT n_regionkey::BIGINT AS body1, body2, (2 * sum(n))::BIGINT AS overlap FROM a JOIN nation ON body1 = n_nationkey GROUP BY 1, 2".replace("SELECT n_regionkey::BIGINT AS body1, body2", "SELECT n_regionkey::BIGINT AS body1, body2"))
def remap_overlaps(spark, d):
    o = overlaps(spark, d).toDF("body1", "body2", "overlap")
    regions = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("orig"), F.col("n_regionkey").cast("long").alias("new"))
    return agg.remap_overlaps(agg.combine_overlaps([o, o]), regions)


# Objects, channels and measures.


@query("WITH s AS (SELECT o_custkey AS segment, c_nationkey AS body, count(*)::BIGINT AS size FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2), b AS (SELECT body, sum(size)::BIGINT AS body_size, count(*)::BIGINT AS segments FROM s GROUP BY 1) SELECT s.*, body_size, segments, size BETWEEN 5 AND 30 AS keep_segment, body_size BETWEEN 10 AND 100000000 AND segments BETWEEN 2 AND 100000000 AND body IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3) AND body NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < -900) AS keep_body FROM s JOIN b USING (body)")
def body_flags(spark, d):
    s = _counts(spark, d).groupBy(F.col("sv").alias("segment"), F.col("body").cast("int").alias("body")).agg(F.sum("count").alias("size"))
    subset = t(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("body"))
    existing = t(spark, d, "supplier").where("s_acctbal < -900").select(F.col("s_nationkey").alias("body"))
    return objects.body_flags(s, (5, 30), (10, 100000000), (2, 100000000), subset, existing)


@query("SELECT (p_partkey - p_partkey % 100) AS key, array_to_string(list(p_partkey ORDER BY p_partkey), ',') AS members FROM part WHERE p_partkey // 100 <> 3 GROUP BY 1")
def mesh_groups(spark, d):
    found = objects.grouped_objects(t(spark, d, "part"), objects.group_key("hundreds", "p_partkey"), "p_partkey", spark.createDataFrame([(300,)], "key long"))
    return found.select("key", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


@query("SELECT doc_id AS label, octet_length(text::BLOB)::BIGINT AS bytes FROM documents WHERE octet_length(text::BLOB) > 5000".replace("octet_length(text::BLOB)", "strlen(text)"))
def oversized_objects(spark, d):
    return objects.oversized(t(spark, d, "documents").select(F.col("doc_id").alias("label"), "text"), "text", 5000)


@query("SELECT ((z // 4) * 128)::BIGINT AS z, ((y // 4) * 128)::BIGINT AS y, ((x // 4) * 128)::BIGINT AS x, count(*)::BIGINT AS blocks FROM (SELECT DISTINCT l_linenumber AS z, l_suppkey AS y, l_partkey % 50 AS x FROM lineitem) GROUP BY 1, 2, 3")
def roi_partition(spark, d):
    blocks = t(spark, d, "lineitem").select(F.col("l_linenumber").alias("z"), F.col("l_suppkey").alias("y"), F.pmod("l_partkey", F.lit(50)).alias("x")).distinct()
    return objects.roi_partition(blocks, 32, 128)


@query(f"WITH {V_SQL}, g(label, k) AS (VALUES (48, 1), (49, 1), (50, 1), (1, 2), (2, 2)), p AS (SELECT DISTINCT {fd('y', 8)} AS brick, q AS label, k FROM v JOIN g ON g.label = q), f AS (SELECT brick, label, count(*) OVER (PARTITION BY brick, k) AS n FROM p) SELECT brick, label, (row_number() OVER (PARTITION BY brick ORDER BY label))::INT AS number FROM f WHERE n >= 2")
def groups_in_bricks(spark, d):
    rows = fifty(spark, d).select(floor_div("y", 8).alias("brick"), "label")
    return objects.groups_in_bricks(rows, groups_from_lists([[48, 49, 50], [1, 2]], spark), ["brick"])


@query("SELECT vec_id, round(embedding[3]::DOUBLE, 6) AS a, round(embedding[1]::DOUBLE, 6) AS b, round(sum(v), 6) AS total FROM (SELECT vec_id, embedding, unnest(embedding)::DOUBLE / list_sum(embedding::DOUBLE[]) AS v FROM embeddings) GROUP BY 1, 2, 3")
def channels(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    two = e.select("vec_id", select_channels("e", [2, 0]).alias("s"), normalise_channels("e").alias("n"))
    return two.select("vec_id", F.round(F.col("s")[0], 6).alias("a"), F.round(F.col("s")[1], 6).alias("b"), F.round(F.aggregate("n", F.lit(0.0), lambda x, y: x + y), 6).alias("total"))


@query("WITH o AS (SELECT source, lang AS gt, n_chars // 500 AS seg FROM documents GROUP BY 1, 2, 3), c AS (SELECT source, count(DISTINCT seg) - count(DISTINCT gt) AS k FROM o GROUP BY 1) SELECT arg_min(source, (k, source)) AS least_at, min(k)::BIGINT AS least, arg_max(source, (k, source)) AS most_at, max(k)::BIGINT AS most, avg(k) AS average FROM c")
def measure_extremes(spark, d):
    o = t(spark, d, "documents").groupBy(F.col("source").alias("subvolume"), F.col("lang").alias("gt"), floor_div("n_chars", 500).alias("seg")).agg(F.count("*").alias("overlap"))
    return evaluate(o, ["count"])["count"]["extremes"]


from gridloom.plans import job_registry, source_registry  # noqa: E402, F401  their queries are registered with these
