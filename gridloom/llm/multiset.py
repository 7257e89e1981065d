"""Homomorphic multiset hash of a text's paragraphs, by DataFrame functions alone.

A text is the multiset of its units: its paragraphs (lines), cut at sentence ends so that texts of one paragraph compare by degree
too. Each unit hashes to a wide vector and the fingerprint is the sum of the vectors modulo powers of two, so it doesn't
depend on order, and adding or removing a paragraph adds or subtracts its vector (`combine`).

A vector has two parts. DENSE lanes modulo 2**32, all of them hashed from the unit's text under seeds of their own, tell equality: other
multisets agree in all with a chance of 2**-(32 DENSE), as far as the hash (xxHash64, which isn't cryptographic) is random. Of the other lanes, modulo 2**16, a unit touches one: it falls into stratum s of
STRATA with chance 2**-(s + 1), and there into one of LANES. Lanes that differ between two fingerprints are those that
the differing units touched, so the share of equal lanes, from the first stratum that isn't crowded on, is the likeness;
higher strata sample the units of long texts, up to some 10**10 units. This part is kept sparse, as sorted numbers lane * 2**16 + sum.

The document next to each one, in descending order of id, comes from one shuffle: ids are cut into ranges by their
quantiles, an id that is several quantiles is cut by a hash of the text, and the first row of each range is sent to the range above as
well, where it sorts last.

Defined results: a null text is empty; an empty text has no units, the fingerprint of zeros, and likeness 1 to another
such text; a null id stands after all others; rows that share an id are ordered by descending hash of their text, then by text, and equal rows are each other's next; an
empty table gives no rows; a single row is its own next; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import text_of

DENSE, STRATA, LANES = 8, 32, 32
#: A stratum with more lanes in use than this is crowded.
CROWDED = 20
UNIT = r"\n+|(?<=[.!?])\s+"
_LOW32, _LOW16 = (1 << 32) - 1, (1 << 16) - 1


def units_of(text: Column) -> Column:
    return F.filter(F.split(text, UNIT), lambda u: u != "")


def dense(units: Column) -> Column:
    """Sums by lane; a hash under one seed gives two lanes."""

    def two(j: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

        def step(s: Column, u: Column) -> Column:
            h = F.xxhash64(F.lit(j), u)
            return F.struct((s["a"] + h.bitwiseAND(_LOW32)).bitwiseAND(_LOW32).alias("a"), (s["b"] + F.shiftrightunsigned(h, 32)).bitwiseAND(_LOW32).alias("b"))

        return F.aggregate(units, start, step, lambda s: F.array(s["a"], s["b"]))

    return F.flatten(F.array(*map(two, range(DENSE // 2))))


def _entry(unit: Column) -> Column:
    """lane * 2**16 + value for a unit."""
    h = F.xxhash64(F.lit(-1), unit)
    low = h.bitwiseAND((1 << STRATA - 1) - 1)
    # The stratum is the number of zeros below the lowest bit that is set.
    lowest = low.bitwiseAND(-low)
    stratum = F.when(low == 0, F.lit(STRATA - 1)).otherwise(F.length(F.bin(lowest)) - 1).cast("long")
    lane = stratum * LANES + F.shiftrightunsigned(h, 32).bitwiseAND(LANES - 1)
    return F.shiftleft(lane, 16).bitwiseOR(F.shiftrightunsigned(h, 48))


def _summed(entries: Column) -> Column:
    """Sorted entries with those of one lane added, and lanes that sum to 0 left out."""
    start = F.struct(F.lit(-1).cast("long").alias("lane"), F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("out"))

    def closed(a: Column) -> Column:
        return F.when(a["sum"] == 0, a["out"]).otherwise(F.array_append(a["out"], F.shiftleft(a["lane"], 16).bitwiseOR(a["sum"])))

    def step(a: Column, x: Column) -> Column:
        lane, value = F.shiftright(x, 16), x.bitwiseAND(_LOW16)
        same = F.struct(lane.alias("lane"), (a["sum"] + value).bitwiseAND(_LOW16).alias("sum"), a["out"].alias("out"))
        return F.when(a["lane"] == lane, same).otherwise(F.struct(lane.alias("lane"), value.alias("sum"), closed(a).alias("out")))

    return F.aggregate(F.array_sort(entries), start, step, closed)


def sparse(units: Column) -> Column:
    return _summed(F.transform(units, _entry))


def fingerprint(dense: Column, sparse: Column) -> Column:
    """Hexadecimal: all dense lanes, a point, and each lane in use with its sum."""
    return F.concat(F.array_join(F.transform(dense, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""), F.lit("."), F.array_join(F.transform(sparse, lambda x: F.lpad(F.lower(F.hex(x)), 7, "0")), ""))


def combine(dense_a: Column, sparse_a: Column, dense_b: Column, sparse_b: Column, sign: int = 1) -> tuple[Column, Column]:
    """The vectors of the union of two multisets (sign 1), or of the first without the second (sign -1)."""
    lanes = F.zip_with(dense_a, dense_b, lambda a, b: (a + F.lit(sign) * b).bitwiseAND(_LOW32))
    moved = sparse_b if sign > 0 else F.transform(sparse_b, lambda x: F.shiftleft(F.shiftright(x, 16), 16).bitwiseOR((-x).bitwiseAND(_LOW16)))
    return lanes, _summed(F.concat(sparse_a, moved))


def likeness(dense_a: Column, sparse_a: Column, dense_b: Column, sparse_b: Column) -> Column:
    """0 to 1: the share of equal lanes among those in use in either, from the first stratum on that isn't crowded in either."""

    def in_stratum(entries: Column, s: Column) -> Column:
        return F.size(F.filter(entries, lambda x: F.shiftright(x, 16).between(s * LANES, s * LANES + LANES - 1)))

    def crowded(s: Column) -> Column:
        return (in_stratum(sparse_a, s) > CROWDED) | (in_stratum(sparse_b, s) > CROWDED)

    strata = F.array(*[F.lit(s).cast("long") for s in range(STRATA - 1)])
    few = F.size(sparse_a) + F.size(sparse_b) <= CROWDED
    first = F.when(few, F.lit(0).cast("long")).otherwise(F.aggregate(strata, F.lit(0).cast("long"), lambda a, s: F.when(crowded(s), s + 1).otherwise(a)))

    def used(entries: Column, least: Column) -> Column:
        return F.filter(entries, lambda x: F.shiftright(x, 16) >= least * LANES)

    def lanes(entries: Column) -> Column:
        return F.transform(entries, lambda x: F.shiftright(x, 16))

    def share(least: Column) -> Column:
        a, b = used(sparse_a, least), used(sparse_b, least)
        either = F.size(F.array_union(lanes(a), lanes(b)))
        return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(F.lit(0.0))

    bound = F.transform(F.array(first), share)[0]
    return F.when(dense_a == dense_b, F.lit(1.0)).otherwise(bound)


def with_next(df: DataFrame, key: str, value: Column, tie: str, parts: int | None = None) -> DataFrame:
    """`df` with _next: `value` of the row after it in descending order of `key`, a hash of `tie`, and ascending order of `tie`; after the last comes the first."""
    spark = df.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    ids = df.select(order.alias("_k"), F.xxhash64(tie).alias("_t"))
    steps = [i / parts for i in range(1, parts)]
    found = ids.agg(F.percentile_approx("_k", F.array(*map(F.lit, steps)), F.lit(10 * parts)).alias("q")).first()["q"] or []
    # An id that is n quantiles has more than (n - 1) / parts of all rows: n + 1 ranges, equal ones of the hash.
    bounds = [(k, -(2**63) + (i << 64) // (n + 1)) for k, n in sorted(Counter(found).items()) for i in range(n + 1 if n > 1 else 1)]
    at = _range_of(bounds)
    tops = {r["_b"]: r["top"] for r in ids.groupBy(at.alias("_b")).agg(F.max(F.struct("_k", "_t")).alias("top")).collect()}  # one row for each range
    there = sorted(tops)
    if not there:
        return df.withColumn("_next", value)
    above = {b: there[(i + 1) % len(there)] for i, b in enumerate(there)}
    every = range(len(bounds) + 1)
    of_range = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("_b") + 1)
    is_top = (of_range([tops[b]["_k"] if b in tops else 0 for b in every]) == F.col("_k")) & (of_range([tops[b]["_t"] if b in tops else 0 for b in every]) == F.col("_t"))
    rows = df.withColumns({"_k": order, "_t": F.xxhash64(tie)}).withColumn("_b", at)
    here = F.struct(F.col("_b").alias("b"), F.lit(False).alias("ghost"))
    there_too = F.struct(of_range([above.get(b, 0) for b in every]).alias("b"), F.lit(True).alias("ghost"))
    rows = rows.withColumn("_to", F.explode(F.when(is_top, F.array(here, there_too)).otherwise(F.array(here))))
    after = Window.partitionBy("_to.b").orderBy(F.col("_to.ghost"), F.col("_k").desc(), F.col("_t").desc(), F.col(tie))
    return rows.withColumn("_next", F.lead(value).over(after)).where(~F.col("_to.ghost")).drop("_k", "_t", "_b", "_to")


def _range_of(bounds: list[tuple[int, int]]) -> Column:
    """The number of bounds at or below (_k, _t), by binary search."""
    if not bounds:
        return F.lit(0)
    limit = lambda part, at: F.element_at(F.array(*[F.lit(b[part]).cast("long") for b in bounds]), F.least(at, F.lit(len(bounds))))

    def step(low: Column, k: Column) -> Column:
        at = low + k
        reached = (limit(0, at) < F.col("_k")) | ((limit(0, at) == F.col("_k")) & (limit(1, at) <= F.col("_t")))
        return F.when((at <= len(bounds)) & reached, at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(1 << j) for j in range(len(bounds).bit_length() - 1, -1, -1)]), F.lit(0), step)


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, dense, sparse, fingerprint) for each row."""
    rows = df.select(F.col(key), units_of(text_of(text)).alias("_u"))
    rows = rows.select(key, dense(F.col("_u")).alias("dense"), sparse(F.col("_u")).alias("sparse"))
    return rows.withColumn("fingerprint", fingerprint(F.col("dense"), F.col("sparse")))


def edited(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each text against its edit: its last third replaced by the beginning of the next document."""
    rows = df.select(F.col(key).alias("_key"), text_of(text).alias("_text")).withColumn("_u", units_of(F.col("_text")))
    rows = rows.select("_key", "_text", dense(F.col("_u")).alias("_d"), sparse(F.col("_u")).alias("_s"))
    rows = with_next(rows, "_key", F.struct("_text", "_d", "_s"), "_text")
    n = F.char_length("_text")
    third = F.floor(n / 3).cast("int")
    rows = rows.withColumn("_edit", F.concat(F.substring("_text", F.lit(1), n - third), F.substring("_next._text", F.lit(1), third)))
    rows = rows.withColumn("_u", units_of(F.col("_edit")))
    rows = rows.select("_key", n.cast("long").alias("n_chars"), F.sha2(F.encode("_edit", "utf-8"), 256).alias("edited_sha256"), "_d", "_s", F.col("_next._d").alias("_nd"), F.col("_next._s").alias("_ns"), dense(F.col("_u")).alias("_ed"), sparse(F.col("_u")).alias("_es"))
    return rows.select(
        F.col("_key").alias(key), "n_chars", "edited_sha256",
        fingerprint(F.col("_d"), F.col("_s")).alias("fingerprint"), fingerprint(F.col("_ed"), F.col("_es")).alias("edited_fingerprint"),
        likeness(F.col("_d"), F.col("_s"), F.col("_ed"), F.col("_es")).alias("near_edited"), likeness(F.col("_d"), F.col("_s"), F.col("_nd"), F.col("_ns")).alias("near_next"),
    )
