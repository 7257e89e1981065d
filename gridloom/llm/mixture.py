"""Mixing sources to target weights by capped water-filling.

A budget of `epochs` times all words is shared among sources by weight; a source takes at most `cap` times its own size
and what is above that is reshared by weight until none is above. That is one water level: target = least of
cap x size and level x weight. In the order of cap by weight, the sources up to some place are capped and the others share what is left
by weight; the level is the greatest of these shares, which running sums over the source table give in one pass.

A target of q whole sizes and a part makes q repetitions of every document and one of a seeded sample: documents of a
source in the order of a seeded hash of their ids, then of a hash of their texts, until the part is used up; the document that crosses it
gives only its first words. The place that is crossed is found by summing words by source and prefix of the hash; of the rows of a source's
prefix that is crossed the next digits are summed, until few rows are left to order. Then each row tells from its own place
what it gives: no text moves, and what is known of the sources is a row for each.

Sources number as many as there are; their table is broadcast only if a count shows it small, else it is joined by
a shuffle in which AQE splits the hot sources' rows.

Defined results: a null text has no words; a null source is a source of its own, ordered last; an empty table gives no
rows; a source without words takes none; rows of a source with the same id and text give alike, so if they cross the part, it is
met but for a word of each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, cut, text_of
from gridloom.operators.numbering import number_rows, running_totals

#: Words for sizes.
WORD = r"[^\x20\x09-\x0D]+"
#: Digits of a place, and how many of them are told apart at once.
PLACE, DIGITS = 64, 3
#: Rows of one source that are ordered in one task, at most, unless their ids and texts are the same.
FEW = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """`sources` with `_rank` from 0 by code point, null last; ranges of sources are counted apart, so no task sees them all."""
    return number_rows(sources, [F.col("_source").isNull(), F.encode("_source", "utf-8")], "_rank")


def water_level(sources: DataFrame, budget: float) -> float:
    """The level for columns _cap and _weight: the greatest share of the sources from some place on, where those before are capped."""
    order = [F.col("_cap") / F.col("_weight"), F.col("_rank")]
    before = running_totals(sources, order, {"_caps": "_cap", "_weights": "_weight"}, "double")
    total = sources.agg(F.sum("_weight")).first()[0] or 0.0
    return before.agg(F.max((F.lit(float(budget)) - F.col("_caps")) / (F.lit(float(total)) - F.col("_weights")))).first()[0] or 0.0


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0) -> DataFrame:
    """`sizes` (_source, source_size) with target; weights repeat over sources in order of code point."""
    sources = ranked(sizes)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = cut(sources.select("_source", "source_size", "_rank", weight.alias("_weight"), (F.lit(float(cap)) * F.col("source_size")).alias("_cap")))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = water_level(sources, epochs * total)
    return sources.select("_source", "source_size", F.least("_cap", F.lit(level) * F.col("_weight")).alias("target"))


def _by_id(key: Column, seed: str) -> Column:
    """The first half of a row's place in the seeded order: digits of the id's hash."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))


def _by_text(text: Column) -> Column:
    """The second half: digits of the text's."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def _crossed(sums: DataFrame) -> DataFrame:
    """Of rows (_s, _lo, words, n, _left) the one of each source whose words, in the order of _lo, cross _left, with what is left there."""
    order = Window.partitionBy("_s").orderBy("_lo")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    found = sums.withColumn("_before", before).where((F.col("_before") <= F.col("_left")) & (F.col("_left") < F.col("_before") + F.col("words")))
    return cut(found.select("_s", "_lo", "n", (F.col("_left") - F.col("_before")).alias("_left")))


def goals(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Of rows (_source, _half, _text) a row for each source: source_size, target, repeats, _part (words of the partial repetition), and the
    place _at at which it ends, after _left words of the _n rows there."""
    sums = F.sum(n_words(F.col("_text"))).alias("words"), F.count("*").alias("n")
    digits = cut(rows.groupBy(F.col("_source").alias("_s"), F.substring("_half", 1, DIGITS).alias("_lo")).agg(*sums))
    found = targets(digits.groupBy(F.col("_s").alias("_source")).agg(F.sum("words").alias("source_size")), weights, epochs, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    found = found.withColumn("repeats", whole).withColumn("_part", F.floor(F.col("target") - F.col("repeats") * F.col("source_size") + 0.5).cast("long"))
    found = cut(found.select(F.col("_source").alias("_s"), "source_size", "target", "repeats", "_part"))
    parts = found.select(F.col("_s").alias("_p"), F.col("_part").alias("_left"))
    at = _crossed(digits.join(bounded(parts), F.col("_s").eqNullSafe(F.col("_p"))).drop("_p"))
    known = DIGITS
    while known < PLACE:
        most = at.agg(F.max("n")).first()[0] or 0
        # Few rows are told apart at once; else the next digits are.
        known = PLACE if most <= FEW else known + DIGITS
        inside = at.select(F.col("_s").alias("_p"), F.col("_lo").alias("_prefix"), "_left")
        place = F.col("_half") if known <= PLACE // 2 else F.concat("_half", _by_text(F.col("_text")))
        met = rows.join(bounded(inside), F.col("_source").eqNullSafe(F.col("_p")) & place.startswith(F.col("_prefix")))
        at = _crossed(met.groupBy(F.col("_source").alias("_s"), F.substring(place, 1, known).alias("_lo"), "_left").agg(*sums))
    end = at.select(F.col("_s").alias("_p"), F.col("_lo").alias("_at"), F.col("n").alias("_n"), "_left")
    return cut(found.join(end, F.col("_s").eqNullSafe(F.col("_p")), "left").drop("_p"))


def mix_sources(df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """The rows of `df` as the struct `row`, with size, source_size, target, taken, repeats (whole repetitions) and extra (words of
    the partial one). Texts stay where they are."""
    by_source = goals(df.select(F.col(source).cast("string").alias("_source"), _by_id(F.col(key), seed).alias("_half"), F.col(text).cast("string").alias("_text")), weights, epochs, cap)
    by_source = by_source.withColumns({"_at_half": F.substring("_at", 1, PLACE // 2), "_at_text": F.substring("_at", PLACE // 2 + 1, PLACE // 2)})
    of = lambda c: F.col(f"row.{c}")
    kept = df.select(F.struct(*(F.col(c) for c in df.columns)).alias("row"))
    kept = kept.withColumns({"_source": of(source).cast("string"), "_size": n_words(text_of(f"row.{text}")), "_half": _by_id(of(key), seed)})
    joined = kept.join(bounded(by_source), kept["_source"].eqNullSafe(F.col("_s"))).drop("_s")
    # A source whose part is all of its words isn't crossed. Texts are hashed only where ids don't tell.
    some = F.least("_size", F.floor(F.col("_left") / F.col("_n")))
    by_text = F.when(_by_text(of(text)) < F.col("_at_text"), F.col("_size")).when(_by_text(of(text)) == F.col("_at_text"), some).otherwise(F.lit(0))
    extra = F.when((F.col("_half") < F.col("_at_half")) | (F.col("_part") >= F.col("source_size")), F.col("_size")).when(F.col("_half") == F.col("_at_half"), by_text).otherwise(F.lit(0)).cast("long")
    return joined.select("row", F.col("_size").alias("size"), "source_size", "target", (F.col("repeats") * F.col("_size") + extra).alias("taken"), "repeats", extra.alias("extra"))


def repeated(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: each row of `df` as often as it is taken, the partial repetition with the first words of its text; other columns as they are."""
    mixed = mix_sources(df, text, **options)
    words = F.array_repeat(F.col("size"), F.col("repeats").cast("int"))
    copies = mixed.withColumn("_n", F.explode(F.when(F.col("extra") > 0, F.array_append(words, F.col("extra"))).otherwise(words)))
    first = F.when(F.col("_n") >= F.col("size"), F.col(f"row.{text}")).otherwise(_first_words(F.col(f"row.{text}"), F.col("_n")))
    return copies.select(*(first.alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in df.columns))


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word: the words are counted in a copy whose separators are all spaces."""
    spaced = F.regexp_replace(text, r"[\x20\x09-\x0D]", " ")
    # Places where a word ends, by cutting after each word; lengths of the pieces add up to the place.
    pieces = F.slice(F.split(spaced, "(?<=[^ ])(?= )"), F.lit(1), F.greatest(n, F.lit(0)).cast("int"))
    return F.substring(text, F.lit(1), F.aggregate(pieces, F.lit(0), lambda a, x: a + F.char_length(x)))
