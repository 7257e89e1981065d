"""Relabelling: mappings, contingent mappings, offsets and renumbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.numbering import number_rows

MODES = ("identity", "zero", "error")


def map_labels(df: DataFrame, mapping: DataFrame, column: str = "label", orig: str = "orig", new: str = "new", missing: str = "identity") -> DataFrame:
    """`column` by the mapping; a label without an entry stays, becomes 0, or raises when it is met. Background stays 0."""
    if missing not in MODES:
        raise ValueError(f"missing is one of {MODES}")
    m = mapping.select(F.col(orig).alias("_orig"), F.col(new).alias("_new"))
    found = F.coalesce("_new", {"identity": F.col(column), "zero": F.lit(0), "error": F.when(F.col(column) == 0, F.lit(0)).otherwise(F.raise_error(F.concat(F.lit("no mapping for label "), F.col(column).cast("string"))))}[missing])
    return df.join(m, F.col(column) == F.col("_orig"), "left").withColumn(column, found.cast(df.schema[column].dataType)).select(*df.columns)


def add_offset(column: str | Column, offset: int) -> Column:
    """A constant more, but for background."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != 0, c + offset).otherwise(F.lit(0))


def contingent_mapping(contingency: DataFrame, primary: str = "left", contingent: str = "right", start: int | None = None) -> DataFrame:
    """(primary, contingency, final) for each primary label with several non-zero contingent ones, final consecutive from the
    largest primary label + 1 in order of both."""
    pairs = contingency.where((F.col(primary) != 0) & (F.col(contingent) != 0)).select(F.col(primary).alias("primary"), F.col(contingent).alias("contingency")).distinct()
    if start is None:
        start = (contingency.agg(F.max(primary)).first()[0] or 0) + 1
    several = pairs.groupBy("primary").agg(F.count("*").alias("_n")).where("_n > 1")
    return number_rows(pairs.join(several.select("primary"), "primary", "left_semi"), ["primary", "contingency"], "final", start)


def contingent_relabel(pairs: DataFrame, mapping: DataFrame, primary: str = "left", contingent: str = "right", name: str = "final") -> DataFrame:
    """`pairs` with the final label of (primary, contingency), the primary one where there is no entry."""
    m = mapping.select(F.col("primary").alias("_p"), F.col("contingency").alias("_c"), F.col("final").alias("_f"))
    return pairs.join(m, (F.col(primary) == F.col("_p")) & (F.col(contingent) == F.col("_c")), "left").select(*pairs.columns, F.coalesce("_f", primary).alias(name))


def renumber_groups(tables: list[DataFrame], exclude: DataFrame | None = None, keys: tuple[str, str] = ("tab", "group"), name: str = "new_group") -> DataFrame:
    """Rows of all tables but those of excluded labels, with a dense number from 0 for each distinct pair of keys in their order."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    if exclude is not None:
        rows = rows.join(exclude.select("label").distinct(), "label", "left_anti")
    return _dense(rows, list(keys), name)


def _dense(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """A dense rank over the distinct keys only, joined back."""
    ranks = rows.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    ranks = number_rows(ranks, [f"_{k}" for k in keys], name)
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition &= c
    return rows.join(ranks, condition).drop(*(f"_{k}" for k in keys))


def overwrite_body(stats: DataFrame, mapping: DataFrame) -> DataFrame:
    """Block statistics with body = map(segment), identity by default, and a tombstone mark for segments that aren't themselves a body."""
    mapped = map_labels(stats.withColumn("body_id", F.col("segment_id")), mapping, "body_id")
    bodies = mapped.select(F.col("body_id").alias("_b")).distinct()
    return mapped.join(bodies, F.col("segment_id") == F.col("_b"), "left").withColumn("segment_needs_tombstone", F.col("_b").isNull()).drop("_b")


def compose(first: DataFrame, second: DataFrame) -> DataFrame:
    """The mapping that applies two one after the other, identity where the second has no entry."""
    s = second.select(F.col("orig").alias("_o"), F.col("new").alias("_n"))
    return first.join(s, F.col("new") == F.col("_o"), "left").select("orig", F.coalesce("_n", "new").alias("new"))


def invert(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.col("new").alias("orig"), F.col("orig").alias("new"))
