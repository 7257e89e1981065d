"""Label lists, groups, mappings and statistics from files."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.operators.graph import mapping_from_edges


def _npy(spark: SparkSession, path: str, schema: str, columns: list[str]) -> DataFrame:
    """Rows of .npy files, read where the files are."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def rows(batches):
        for pdf in batches:
            for content in pdf["content"]:
                a = np.load(io.BytesIO(content), allow_pickle=False)
                if a.dtype.names:
                    yield pd.DataFrame({c: a[n].astype(np.int64) for c, n in zip(columns, a.dtype.names, strict=False)})
                else:
                    yield pd.DataFrame(a.reshape(len(a), -1)[:, : len(columns)].astype(np.int64), columns=columns)

    return files.mapInPandas(rows, schema)


def _arrow(spark: SparkSession, path: str) -> DataFrame:
    """Feather (Arrow IPC) files: the schema is read from the first, rows by the executors."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    files = spark.read.format("binaryFile").load(path).select("content")
    schema = pa.ipc.open_file(pa.BufferReader(files.first()["content"])).schema.remove_metadata()
    fields = from_arrow_schema(schema)

    def rows(batches):
        for pdf in batches:
            for content in pdf["content"]:
                yield pa.ipc.open_file(pa.BufferReader(content)).read_pandas().reset_index(drop=True)

    return files.mapInPandas(rows, fields)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A table by the ending of its path."""
    if path.endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    if path.endswith(".json"):
        return (spark.read.schema(schema) if schema else spark.read).json(path)
    if path.endswith((".feather", ".arrow")):
        return _arrow(spark, path)
    return spark.read.parquet(path)


def label_list(spark: SparkSession, source: list[int] | str, as_supervoxels: bool = False) -> DataFrame:
    """(label) from a list or a file; of a table the column `sv` or `body`, else the first. Distinct."""
    if not isinstance(source, str):
        return spark.createDataFrame([(int(x),) for x in source], "label long").distinct()
    if source.endswith(".npy"):
        return _npy(spark, source, "label long", ["label"]).distinct()
    rows = read_table(spark, source)
    name = "sv" if as_supervoxels else "body"
    return rows.select(F.col(name if name in rows.columns else rows.columns[0]).cast("long").alias("label")).distinct()


def groups_from_lists(lists: list[list[int]], spark: SparkSession) -> DataFrame:
    """(label, group): list i is group i + 1."""
    return spark.createDataFrame([(lists,)], "g array<array<long>>").select(F.posexplode("g").alias("i", "g")).select(F.explode("g").alias("label"), (F.col("i") + 1).cast("long").alias("group"))


def groups_from_json(text: DataFrame, column: str = "value") -> DataFrame:
    """The same from JSON texts, each a list of lists."""
    parsed = F.from_json(F.col(column), T.ArrayType(T.ArrayType(T.LongType())))
    return text.select(F.posexplode(parsed).alias("i", "g")).select(F.explode("g").alias("label"), (F.col("i") + 1).cast("long").alias("group"))


def label_groups(spark: SparkSession, source: list[list[int]] | str) -> DataFrame:
    """(label, group), distinct, from lists, JSON or a table whose label column may be called sv or body."""
    if not isinstance(source, str):
        return groups_from_lists(source, spark).distinct()
    if source.endswith(".json"):
        return groups_from_json(spark.read.text(source, wholetext=True)).distinct()
    rows = read_table(spark, source)
    name = next(c for c in ("label", "sv", "body") if c in rows.columns)
    return rows.select(F.col(name).cast("long").alias("label"), F.col("group").cast("long").alias("group")).distinct()


KINDS = ("label-to-body", "equivalence-edges", "body-rag")


def labelmap(spark: SparkSession, path: str, kind: str = "label-to-body") -> DataFrame:
    """(orig, new): pairs as they are, or the components of edges."""
    if kind not in KINDS:
        raise ValueError(f"kind is one of {KINDS}")
    rows = read_table(spark, path)
    a, b = rows.columns[:2]
    if kind == "label-to-body":
        return rows.select(F.col(a).cast("long").alias("orig"), F.col(b).cast("long").alias("new"))
    edges = rows.select(F.col(a).cast("long").alias("src"), F.col(b).cast("long").alias("dst"))
    return mapping_from_edges(edges).select(F.col("segment").alias("orig"), F.col("body").alias("new"))


def cached_mapping(spark: SparkSession, edges_path: str, mapping_path: str) -> DataFrame:
    """The components of an edge CSV, written as CSV once and read from there afterwards."""
    labelmap(spark, edges_path, "equivalence-edges").write.mode("ignore").option("header", True).csv(mapping_path)
    return spark.read.option("header", True).schema("orig long, new long").csv(mapping_path)


def merge_table(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """Edges with id_a <= id_b, one row for each pair."""
    rows = read_table(spark, path)
    out = rows.withColumns({"id_a": F.least("id_a", "id_b"), "id_b": F.greatest("id_a", "id_b")}).dropDuplicates(["id_a", "id_b"])
    return out.orderBy("id_a", "id_b") if ordered else out


def block_stats(spark: SparkSession, path: str, presorted: bool = False) -> DataFrame:
    rows = read_table(spark, path)
    return rows if presorted else rows.sortWithinPartitions("body_id", "z", "y", "x")


def made_objects(spark: SparkSession, folder: str) -> DataFrame:
    """(label): ids in the names of files that are there, to leave out what is made already."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.*").load(folder).select("path")
    number = F.regexp_extract("path", r"([0-9]+)\.[A-Za-z0-9]+$", 1)
    return names.where(number != "").select(number.cast("long").alias("label")).distinct()
