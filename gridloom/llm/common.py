"""What the text operators share: reading, cutting lineage, bounded broadcasts, word hashing."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.lineage import cut, forget, shared_dir

__all__ = ["bounded", "cut", "forget", "hashed_words", "mix", "only", "seeded_sample", "shared_dir", "shingles", "table", "text_of"]

#: Word separators: space, and tab to carriage return.
SEPARATORS = b" \t\n\x0b\x0c\r"
#: Rows, and bytes of their strings, that may be broadcast; larger sides are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 1 << 24
#: Bytes of text that are hashed at once; arrays over a run take some hundred times as much, in each worker.
CHUNK = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`small` marked for broadcast if it has at most `rows` rows and BROADCAST_BYTES bytes of strings; otherwise as it is, for a shuffle join."""
    held = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in small.dtypes if t in ("string", "binary")]
    n, size = small.agg(F.count("*"), F.coalesce(F.sum(sum(held, F.lit(0)).cast("long")), F.lit(0))).first()
    return F.broadcast(small) if n <= rows and size <= BROADCAST_BYTES else small


def seeded_sample(df: DataFrame, rows: int, seed: int, *key: str) -> DataFrame:
    """At most `rows` rows of `df`: those with the least seeded hashes of `key`.

    A threshold leaves about as many rows, give or take six standard deviations, before they are ordered, so that no task and no
    driver gets `rows` rows of each partition."""
    n = df.count()
    order = F.xxhash64(F.lit(seed), *key)
    part = (rows + 6 * rows**0.5 + 16) / max(n, 1)
    near = df if part >= 1 else df.where(order < F.lit(int(part * 2**64) - 2**63))
    return near.orderBy(order, *key).limit(rows)


def only(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of `df` whose `key` is in (left_semi) or not in (left_anti) the one column of `ids`."""
    name = f"_{uuid.uuid4().hex}"
    ids = bounded(ids.toDF(name))
    return df.join(ids, df[key] == ids[name], how)


def text_of(column: str = "text") -> Column:
    """A text column without nulls."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _random64(n: int, seed: str) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(f"{seed}:{i}".encode(), digest_size=8).digest(), "little") for i in range(n)], dtype=np.uint64)


_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = _random64(256, "byte")
_VALUES[65:91] = _VALUES[97:123]
_IS_SEP = np.zeros(256, bool)
_IS_SEP[list(SEPARATORS)] = True
_SHINGLE = _random64(64, "shingle") | np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        found = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            found.append(np.multiply.accumulate(p))
        _POWERS[:] = found
    return _POWERS[0], _POWERS[1]


def _hash_flat(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    word = ~_IS_SEP[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    power, inverse = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data] * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def _hash_long(data: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, in chunks that end at separators."""
    found, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):
            seps = np.flatnonzero(_IS_SEP[data[at:end]])
            if len(seps):
                end = at + int(seps[-1]) + 1
            else:
                later = np.flatnonzero(_IS_SEP[data[end:]])
                end = end + int(later[0]) if len(later) else len(data)
        found.append(_hash_flat(data[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array; a null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64, len(texts) + 1, texts.offset * 8) if offs else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data and data.size else np.empty(0, np.uint8)
    return whole, offsets


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, row after the last, 64-bit hashes of their words (ASCII case ignored), and each word's row in the run.

    Temporary memory is bounded by CHUNK and the words of one text, whatever the texts' lengths."""
    data, offsets = flat(texts)
    row, n = 0, len(texts)
    while row < n:
        last = row + 1
        if offsets[last] - offsets[row] > CHUNK:
            words = _hash_long(data[offsets[row] : offsets[last]])
            yield row, last, words, np.zeros(len(words), np.int64)
        else:
            last = max(last, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
            last = min(last, n)
            part = offsets[row : last + 1] - offsets[row]
            words, owner = _hash_flat(data[offsets[row] : offsets[last]], part)
            yield row, last, words, owner
        row = last


def shingles(words: np.ndarray, owner: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `size` consecutive words and their rows; a text of fewer words has one shingle of all its words, an empty one none."""
    counts = np.bincount(owner, minlength=rows)
    n = len(words) - size + 1
    if n > 0:
        total = words[:n] * _SHINGLE[0]
        for j in range(1, size):
            total = total + words[j : n + j] * _SHINGLE[j]
        inside = owner[:n] == owner[size - 1 :]
        found, rows_of = mix(total[inside]), owner[:n][inside]
    else:
        found, rows_of = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(owner, short)
        extra = np.array([int(sum(int(words[a + j]) * int(_SHINGLE[j]) for j in range(counts[r])) + int(counts[r])) & (2**64 - 1) for r, a in zip(short, first, strict=True)], np.uint64)
        found, rows_of = np.concatenate([found, mix(extra)]), np.concatenate([rows_of, short])
        order = np.argsort(rows_of, kind="stable")
        found, rows_of = found[order], rows_of[order]
    return found, rows_of
