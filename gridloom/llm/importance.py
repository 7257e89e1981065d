"""Quality classifier by importance resampling.

Two generative models of hashed word unigrams and bigrams are counted: one over the raw text, all documents, and one over
the target text, documents that a bounded, seeded sample of labels calls good. A document's log weight is the sum of
its n-grams' log ratios of target to raw probability, each shrunk towards 0 by a few pseudo-counts. Part of the
labelled sample is held out of the target counts; its good documents set the weight that a share `keep` of good
documents reaches, and k is the number of documents with that weight. Gumbel top-k then draws k documents: those with
the k largest sums of log weight and seeded Gumbel noise.

The k-th largest key is found by counting keys in ever narrower ranges, so nothing is sorted and only counts come to
the driver. The model is one number for each hash bucket. Distinct n-grams grow about as the root of a text's length, and so does the
number of buckets: the next power of two above SPREAD times the root of the corpus's bytes, from LEAST to MOST of them, so that a bucket
goes on to stand for few n-grams; MOST bounds what the driver gets and broadcasts (16 bytes a bucket once, then 4).

Defined results: a null or empty text has no n-grams and log weight 0; rows that repeat draw the same noise, and rows
that tie with the k-th are all kept; without good labels nothing can be told apart and all rows are kept; labels that
are null are none, and a document with both good and bad labels isn't good; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.common import cut, hashed_words, mix, seeded_sample

#: Buckets for each root of a byte, and the least and the largest number of them.
SPREAD, LEAST, MOST = 16, 1 << 16, 1 << 24
#: N-grams that a task holds before it adds them to its counts.
HELD = 1 << 22
#: Labelled documents that the target model and the threshold are fitted on, at most.
LABELLED = 20_000
#: One labelled document in so many is held out for the threshold.
HELD_OUT = 4
PSEUDO = 5.0
KEEP = 0.995
SEED = 17

_PAIR = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA5A826395121157))
WEIGHT, KEY, GRAMS = "_gl_weight", "_gl_key", "_gl_grams"


def n_buckets(docs: DataFrame) -> int:
    """The number of buckets, a power of two, for a corpus."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(MOST, max(LEAST, 1 << int(SPREAD * size**0.5).bit_length()))


def ngrams(words: np.ndarray, owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and rows of all unigrams and bigrams."""
    pair = mix(words[:-1] * _PAIR[0] + words[1:] * _PAIR[1]) if len(words) > 1 else words[:0]
    same = owner[:-1] == owner[1:]
    grams = np.concatenate([words, pair[same]]) >> np.uint64(65 - buckets.bit_length())
    return grams.astype(np.int64), np.concatenate([owner, owner[:-1][same]])


def labelled(labels: DataFrame, rows: int = LABELLED, seed: int = SEED) -> DataFrame:
    """(_label_id, _good) of a seeded sample of at most `rows` labelled documents."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_label_id")).agg(F.min(good.cast("int")).alias("_good"))
    return seeded_sample(known, rows, seed, "_label_id")


def _held_out(key: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed + 1), key), F.lit(HELD_OUT)) == 0


def count_models(docs: DataFrame, sample: DataFrame, buckets: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Counts by bucket over all documents and over the sample's good ones that aren't held out."""
    target = F.coalesce((F.col("_good") == 1) & ~_held_out(F.col("_label_id"), seed), F.lit(False))
    rows = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).join(F.broadcast(sample), F.col("_doc") == F.col("_label_id"), "left").select("_text", target.alias("_target"))
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("raw", T.LongType()), T.StructField("target", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        held: list[np.ndarray] = []

        def add():
            if held:
                raw[:] += np.bincount(np.concatenate(held), minlength=buckets)
                held.clear()

        for batch in batches:
            flag = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b, words, owner in hashed_words(batch.column(0)):
                grams, rows_of = ngrams(words, owner, buckets)
                held.append(grams)
                if sum(map(len, held)) >= HELD:
                    add()
                if flag[a:b].any():
                    np.add.at(wanted, grams[flag[a:b][rows_of]], 1)
        add()
        full = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(raw[full]), pa.array(wanted[full])], names=["bucket", "raw", "target"])

    found = rows.mapInArrow(run, schema).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    counts = found.toArrow()  # at most `buckets` rows
    raw, wanted = np.zeros(buckets), np.zeros(buckets)
    at = counts.column("bucket").to_numpy()
    raw[at], wanted[at] = counts.column("raw").to_numpy(), counts.column("target").to_numpy()
    return raw, wanted


def log_ratios(raw: np.ndarray, target: np.ndarray, pseudo: float = PSEUDO) -> np.ndarray:
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw), np.float32)
    return np.log((target + pseudo) / (raw * (target.sum() / raw.sum()) + pseudo)).astype(np.float32)


def scored(docs: DataFrame, model: Broadcast, seed: int = SEED) -> DataFrame:
    """All rows and columns of `docs` with the number of n-grams, the log weight and the Gumbel key."""
    schema = T.StructType([*docs.schema, T.StructField(GRAMS, T.LongType()), T.StructField(WEIGHT, T.DoubleType()), T.StructField(KEY, T.DoubleType())])
    arrow = to_arrow_schema(schema)
    at_text, at_id = docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = model.value
        for batch in batches:
            n = batch.num_rows
            grams_of, weight, said = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.uint64)
            for a, b, words, owner in hashed_words(batch.column(at_text)):
                grams, rows_of = ngrams(words, owner, len(ratios))
                grams_of[a:b] = np.bincount(rows_of, minlength=b - a)
                weight[a:b] = np.bincount(rows_of, ratios[grams], b - a)
                np.add.at(said[a:b], owner, words)
            ids = batch.column(at_id).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.uint64)
            draw = mix(mix(ids + np.uint64(seed)) + said)
            uniform = ((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            key = weight - np.log(-np.log(uniform))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(grams_of), pa.array(weight), pa.array(key)], schema=arrow)

    return docs.mapInArrow(run, schema)


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of a column of finite numbers, by counts in ever narrower ranges."""
    low, high, above = *df.agg(F.min(column), F.max(column)).first(), 0
    while low < high:
        width = (high - low) / bins
        inside = df.where(F.col(column).between(low, high))
        number = F.least(F.lit(bins - 1), F.floor((F.col(column) - low) / width)).cast("int") if width > 0 else F.lit(0)
        found = inside.groupBy(number.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()  # at most `bins` rows
        for r in sorted(found, key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


class Chosen:
    """A fitted model, the scores of all documents, and the key that the k chosen ones reach."""

    def __init__(self, docs: DataFrame, labels: DataFrame, keep: float = KEEP, rows: int = LABELLED, seed: int = SEED):
        sample = cut(labelled(labels, rows, seed))
        self.docs, self.seed = docs, seed
        ratios = log_ratios(*count_models(docs, sample, n_buckets(docs), seed))
        self.model = docs.sparkSession.sparkContext.broadcast(ratios)
        self.scores = cut(scored(docs.select("doc_id", "text"), self.model, seed).select("doc_id", GRAMS, WEIGHT, KEY))
        good = self.scores.join(F.broadcast(sample.where(F.col("_good") == 1).where(_held_out(F.col("_label_id"), seed))), F.col("doc_id") == F.col("_label_id"))
        n = good.count()
        self.least = kth_largest(good, WEIGHT, max(1, int(np.ceil(keep * n)))) if n else -np.inf
        self.k = self.scores.where(F.col(WEIGHT) >= self.least).count()
        self.cut_off = kth_largest(self.scores, KEY, self.k) if n and self.k else -np.inf

    def sample(self) -> DataFrame:
        """(doc_id, n_grams, log_weight, key) of the chosen documents."""
        return self.scores.where(F.col(KEY) >= self.cut_off).select("doc_id", F.col(GRAMS).alias("n_grams"), F.col(WEIGHT).alias("log_weight"), F.col(KEY).alias("gumbel_key"))

    def kept(self) -> DataFrame:
        """The chosen documents, all columns; scored again rather than joined, so no text is shuffled."""
        return scored(self.docs, self.model, self.seed).where(F.col(KEY) >= self.cut_off).drop(GRAMS, WEIGHT, KEY)
