"""Numbers and running totals over a whole table's order, without a task that sees the whole table.

Rows are dealt by ranges of the order, sorted in each, and written once, so that every row's range and place in it are settled. What
comes to the driver is one row for each range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.lineage import cut

_PLACE = (1 << 33) - 1


def _placed(df: DataFrame, order: list[str | Column]) -> DataFrame:
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))


def _part() -> Column:
    return F.shiftright("_id", 33).cast("int")


def _offsets(sums: dict[int, int], start: int = 0, kind: str = "long") -> Column:
    """The sum of all ranges before a row's own."""
    at, before = start, []
    for p in range(max(sums, default=-1) + 1):
        before.append(at)
        at += sums.get(p, 0)
    return F.element_at(F.array(*[F.lit(b).cast(kind) for b in before or [start]]), _part() + 1)


def number_rows(df: DataFrame, order: list[str | Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers from `start` in an order."""
    placed = _placed(df, order)
    counts = {r["p"]: r["n"] for r in placed.groupBy(_part().alias("p")).agg(F.count("*").alias("n")).collect()}
    return placed.withColumn(name, _offsets(counts, start) + F.col("_id").bitwiseAND(_PLACE)).drop("_id")


def running_totals(df: DataFrame, order: list[str | Column], totals: dict[str, str], kind: str = "long") -> DataFrame:
    """For each new column the sum of a column of numbers over all rows before, as `kind`."""
    placed = _placed(df, order)
    rows = placed.groupBy(_part().alias("p")).agg(*(F.sum(c).alias(n) for n, c in totals.items())).collect()
    before = Window.partitionBy(_part()).orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    added = {n: (_offsets({r["p"]: r[n] or 0 for r in rows}, kind=kind) + F.coalesce(F.sum(c).over(before), F.lit(0))).cast(kind) for n, c in totals.items()}
    return placed.withColumns(added).drop("_id")
