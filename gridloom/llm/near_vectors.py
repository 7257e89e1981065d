"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length 1 in double precision and cut into halves, each with a codebook of its own, fitted by k-means on a
bounded, seeded sample. The pairs of nearest centroids form a product grid of cells, in which every vector is indexed.
A multi-sequence traversal visits the cells by rising bound of their distance: the sum of the halves' bounds, each
the distance to the plane between the nearest centroid and the cell's. Two vectors with cosine c are sqrt(2 - 2c) apart; with RECALL 1, the
default, the traversal ends where the bound reaches that, so no neighbour can be left. With less it ends where the bound says that what is
left holds less than 1 - RECALL of a vector's neighbours, if differences have no preferred direction: then they
have the distance over the root of the dimensions along any plane's normal, and the sum of two such squares is
beyond z squared with a chance of exp(-z^2 / 2).

What a visit finds is verified by the cosine. A pair counts for both sides if either one's traversal meets it.
Rows of the grid are the unit of work; a row with many vectors is cut into blocks on both sides, and a task sees one
block of each. It gives each vector's number of links and, of the links, only the edges of a forest over the block.

Copies (equal label and components) are one class in the index; their links are counted, not listed.

Defined results: a null label, id or vector, an empty or zero vector, and one with null or non-finite components link
with nothing; vectors of other lengths than each other aren't compared; of rows that share an id but not the vector only the least vector is
compared; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.common import bounded, cut, seeded_sample
from gridloom.operators.components import components_of_edges

COSINE = 0.98
RECALL = 1.0
#: Vectors that the codebooks are fitted on, at most.
SAMPLE = 16384
#: Vectors for each cell of the grid, about, and centroids of a codebook, at most.
PER_CELL, MOST = 128, 1024
#: Vectors of one block of a grid row: indexed, asking.
BLOCK, CHUNK = 2048, 4096


def unit(raw: list[bytes]) -> np.ndarray:
    """Rows of equal length as vectors of length 1."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        nearest = squares(x, centres).argmin(axis=1)
        n = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, each summed alike wherever it is computed."""
    out = np.empty((len(x), len(centres)))
    for k, c in enumerate(centres):
        d = x - c
        out[:, k] = (d * d).sum(axis=1)
    return out


class Grid:
    """Codebooks for vectors of one length; without a sample, one cell."""

    def __init__(self, sample: np.ndarray | None, dim: int, k: int, radius: float, seed: int):
        half = (dim + 1) // 2
        self.cuts, self.radius = (slice(0, half), slice(half, dim)), radius
        if sample is None:
            self.books = [np.zeros((1, half)), np.zeros((1, dim - half))]
        else:
            self.books = [k_means(sample[:, c], min(k, len(sample)), seed + i) for i, c in enumerate(self.cuts)]
        self.apart = [np.sqrt(squares(b, b)) for b in self.books]

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest centroid, and each centroid's squared bound."""
        out = []
        for c, book, apart in zip(self.cuts, self.books, self.apart, strict=True):
            d = squares(x[:, c], book)
            nearest = d.argmin(axis=1)
            over = d - d[np.arange(len(x)), nearest][:, None]
            width = 2 * apart[nearest]
            bound = np.where(width > 0, over / np.where(width > 0, width, 1), 0)
            out.append((nearest, bound * bound))
        return out

    def visits(self, first: np.ndarray, second: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Multi-sequence traversal for one vector: the grid rows by rising bound, each with the columns in reach."""
        limit = self.radius**2
        rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        sorted_second = second[columns]
        out = []
        for i in rows:
            n = int(np.searchsorted(sorted_second, limit - first[i], "right"))
            if not n:
                break
            out.append((int(i), columns[:n]))
        return out


def radius(dim: int, cosine: float, recall: float) -> float:
    apart = (2 - 2 * cosine) ** 0.5
    if recall >= 1:
        return apart * (1 + 1e-9)
    return min(apart * (1 + 1e-9), apart / max(1, dim) ** 0.5 * (-2 * np.log(1 - recall)) ** 0.5)


def usable(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, dim, h, raw) of the vectors that can link; h names the components, raw has them as doubles."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()).where(finite).select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), v.alias("v"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.StringType()), T.StructField("dim", T.IntegerType()), T.StructField("h", T.BinaryType()), T.StructField("raw", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2)
            flat = (v.flatten().to_numpy(zero_copy_only=False) + 0.0).tobytes()
            at = np.concatenate([[0], np.cumsum(np.diff(v.offsets.to_numpy()))]) * 8
            raw = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((np.diff(at) // 8).astype(np.int32)), pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in raw], pa.binary()), pa.array(raw, pa.binary())], schema=arrow)

    return rows.mapInArrow(run, schema)


def fit(reps: DataFrame, cosine: float, recall: float, seed: int) -> dict[int, Grid]:
    n = reps.count()
    sample = seeded_sample(reps.select("id", "dim", "raw"), SAMPLE, seed, "id").collect()  # SAMPLE rows at most
    k = int(min(MOST, max(8, round((n / PER_CELL) ** 0.5))))
    grids = {}
    for dim in {r["dim"] for r in sample}:
        x = unit([r["raw"] for r in sample if r["dim"] == dim])
        grids[dim] = Grid(x if len(x) >= k else None, dim, k, radius(dim, cosine, recall), seed)
    return grids


def block_links(ids: np.ndarray, others: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest with the components of the links ids[x] - others[y]."""
    label_x, label_y = ids.copy(), others.copy()
    while True:
        old = label_x.copy(), label_y.copy()
        np.minimum.at(label_x, x, label_y[y])
        np.minimum.at(label_y, y, label_x[x])
        if (label_x == old[0]).all() and (label_y == old[1]).all():
            break
    a, b = np.concatenate([ids[x], others[y]]), np.concatenate([label_x[x], label_y[y]])
    return [(int(p), int(q)) for p, q in set(zip(a.tolist(), b.tolist(), strict=True)) if p != q]


def group_near(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, recall: float = RECALL, seed: int = 11) -> DataFrame:
    """(key, n_links, component_id, kept) for each row."""
    found = cut(usable(df, key, vector, label))
    each = found.groupBy("id").agg(F.min(F.struct("label", "h")).alias("s"), F.count("*").alias("n")).select("id", "s.label", "s.h", "n")
    names = cut(each.groupBy("label", "h").agg(F.min("id").alias("rep"), F.sum("n").alias("mult")))
    each = cut(each.join(names, ["label", "h"]).select("id", "label", "h", "rep", "mult"))
    first = names.select(F.col("label").alias("_l"), F.col("h").alias("_h"), F.col("rep").alias("_r"), "mult")
    reps = cut(found.join(first, (F.col("id") == F.col("_r")) & (F.col("label") == F.col("_l")) & (F.col("h") == F.col("_h"))).dropDuplicates(["id"]).select("id", "label", "dim", "raw", "mult"))
    grids = df.sparkSession.sparkContext.broadcast(fit(reps, cosine, recall, seed))  # two codebooks of MOST centroids for each length in the sample
    default_radius = lambda dim: radius(dim, cosine, recall)

    def grid_of(dim: int) -> Grid:
        return grids.value.get(dim) or Grid(None, dim, 1, default_radius(dim), seed)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for all_rows in batches:
            for dim, pdf in all_rows.groupby("dim"):
                for at in range(0, len(pdf), 1000):
                    part = pdf.iloc[at : at + 1000]
                    grid = grid_of(int(dim))
                    (n1, b1), (n2, b2) = grid.bounds(unit(list(part["raw"])))
                    visits = [grid.visits(x, y) for x, y in zip(b1, b2, strict=True)]
                    yield pd.DataFrame({"id": part["id"], "label": part["label"], "dim": part["dim"], "raw": part["raw"], "mult": part["mult"], "i": n1.astype(np.int32), "j": n2.astype(np.int32), "visits": [[{"i": i, "js": js.tolist()} for i, js in v] for v in visits]})

    placed = cut(reps.mapInPandas(place, "id long, label string, dim int, raw binary, mult long, i int, j int, visits array<struct<i:int,js:array<int>>>"))
    index = placed.select(*(F.col(c).alias(c) for c in ("id", "label", "dim", "raw", "mult", "i", "j")))
    asks = placed.select("id", "label", "dim", "raw", "mult", F.col("i").alias("at_i"), F.col("j").alias("at_j"), F.explode("visits").alias("v")).select("*", F.col("v.i").alias("i"), F.col("v.js").alias("js")).drop("v")
    row = ["label", "dim", "i"]
    sizes = index.groupBy(*row).agg(F.count("*").alias("n")).join(asks.groupBy(*row).agg(F.count("*").alias("m")), row)
    sizes = bounded(cut(sizes.select(*row, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks"))))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    index = index.join(sizes, row).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int")).withColumn("chunk", spread("chunks")).drop("blocks", "chunks")
    asks = asks.join(sizes, row).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), "chunks").cast("int")).withColumn("block", spread("blocks")).drop("blocks", "chunks")

    def meet(asking: pd.DataFrame, indexed: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(indexed):
            return pd.DataFrame({"id": [], "other": [], "n": []})
        grid = grid_of(int(asking["dim"].iat[0]))
        x, y = unit(list(asking["raw"])), unit(list(indexed["raw"]))
        ids, others = asking["id"].to_numpy(), indexed["id"].to_numpy()
        columns = indexed["j"].to_numpy()
        asked = np.repeat(np.arange(len(ids)), [len(js) for js in asking["js"]])
        wanted = np.concatenate([np.asarray(js) for js in asking["js"]])
        px, py = [], []
        for j in np.unique(columns):
            a, b = asked[wanted == j], np.flatnonzero(columns == j)
            for at in range(0, len(a), 1024):
                p, q = np.nonzero(x[a[at : at + 1024]] @ y[b].T >= cosine)
                px.append(a[at : at + 1024][p])
                py.append(b[q])
        px, py = np.concatenate(px), np.concatenate(py)
        apart = ids[px] != others[py]
        px, py = px[apart], py[apart]
        counts = np.bincount(px, indexed["mult"].to_numpy()[py], len(ids)).astype(np.int64)
        out = [(int(i), None, int(n)) for i, n in zip(ids, counts, strict=True) if n]
        # The other side counts the pair itself if its own traversal comes here; else it is counted for it.
        met = np.unique(py)
        if len(met):
            (_, b1), (_, b2) = grid.bounds(y[met])
            k = np.searchsorted(met, py)
            at_i, at_j = asking["at_i"].to_numpy()[px], asking["at_j"].to_numpy()[px]
            back = b2[k, at_j] <= grid.radius**2 - b1[k, at_i]
            extra = np.bincount(py[~back], asking["mult"].to_numpy()[px[~back]], len(others)).astype(np.int64)
            out += [(int(i), None, int(n)) for i, n in zip(others, extra, strict=True) if n]
            out += [(a, b, 0) for a, b in block_links(ids, others, px, py)]
        return pd.DataFrame(out, columns=["id", "other", "n"]).astype({"id": "Int64", "other": "Int64", "n": "Int64"})

    group = [*row, "block", "chunk"]
    met = cut(asks.groupBy(*group).cogroup(index.groupBy(*group)).applyInPandas(meet, "id long, other long, n long"))
    links = met.groupBy("id").agg(F.sum("n").alias("_links")).withColumnRenamed("id", "_i")
    linked = components_of_edges(met.where("other is not null"), "id", "other")
    classes = each.join(links, F.col("rep") == F.col("_i"), "left").join(linked, F.col("rep") == F.col("node"), "left")
    classes = classes.select("id", "label", "h", (F.coalesce("_links", F.lit(0)) + F.col("mult") - 1).alias("_n"), F.coalesce("component", "rep").alias("_c"))
    rows = df.select(df[key].alias("_key")).join(classes, F.col("_key").cast("long") == F.col("id"), "left")
    own = F.col("_key").cast("long")
    return rows.select(F.col("_key").alias(key), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_c", own).alias("component_id"), F.coalesce("_c", own).eqNullSafe(own).alias("kept"))
