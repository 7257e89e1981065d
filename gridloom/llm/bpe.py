"""Byte-level BPE by monoid tree reduction.

An element is a text with its token ids; joining two elements re-encodes a window around their boundary and grows it
until what lies outside can't change, so any tree of joins gives the ids of the whole text, and decoding concatenates
up the same tree.

Two facts bound the window. The pattern never matches across a change from a non-space to a white-space character, so
such a place parts two matches whatever surrounds it. Inside one match, a row of tokens is the encoding of its bytes
if and only if each neighbouring pair is the encoding of the pair's bytes, so a re-encoded window is final once the
pairs at its two ends are.

Defined results: a null text is empty; an empty text has no ids and the digests of nothing; repeated rows and rows
that share an id are each encoded; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridloom.llm.common import text_of

RANKS = "byte_bpe_50k.tiktoken"
#: Code points of a leaf of the tree.
LEAF = 2048
#: Tokens on either side of a boundary inside one match that are re-encoded at first.
WINDOW = 4

_CUT_BACK = regex.compile(r"(?r)[\p{L}\p{N}\p{P}](?=[ \n])")
_CUT_ON = regex.compile(r"[\p{L}\p{N}\p{P}](?=[ \n])")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str = public_tokenizers.PATTERN) -> Tokenizer:
    return Tokenizer(path, pattern)


class Tokenizer:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.decimals = {i: str(i) for i in self.bytes_of}

    # The monoid of texts.

    def encode(self, text: str, leaf: int = LEAF) -> list[int]:
        """Ids of a whole text, by halves."""
        if len(text) <= leaf:
            return self.encoding.encode_ordinary(text)
        middle = len(text) // 2
        return self.join(text[:middle], self.encode(text[:middle], leaf), text[middle:], self.encode(text[middle:], leaf), leaf)

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int], leaf: int = LEAF) -> list[int]:
        """Ids of left + right from the ids of each."""
        start, end = self._safe_start(left), self._safe_end(right)
        inner = left[start:] + right[:end]
        kept_left = self._before(left_ids, len(left[start:].encode("utf-8", "surrogatepass")))
        kept_right = self._after(right_ids, len(right[:end].encode("utf-8", "surrogatepass")))
        return left_ids[:kept_left] + self._window(inner, leaf) + right_ids[kept_right:]

    @staticmethod
    def _safe_start(left: str) -> int:
        """Where the last match that more text could change begins, or a place before: after the last letter, number or mark that a space or line break follows."""
        m = _CUT_BACK.search(left)
        return m.end() if m else 0

    @staticmethod
    def _safe_end(right: str) -> int:
        m = _CUT_ON.search(right)
        return m.end() if m else len(right)

    def _before(self, ids: list[int], size: int) -> int:
        """How many ids stand before the last `size` bytes; a safe place always parts two ids."""
        at = len(ids)
        while size > 0:
            at -= 1
            size -= len(self.bytes_of[ids[at]])
        assert size == 0
        return at

    def _after(self, ids: list[int], size: int) -> int:
        at = 0
        while size > 0:
            size -= len(self.bytes_of[ids[at]])
            at += 1
        assert size == 0
        return at

    def _window(self, inner: str, leaf: int) -> list[int]:
        """Ids of the text between two safe places; a match longer than a leaf is itself encoded by halves."""
        if len(inner) <= 2 * leaf:
            return self.encoding.encode_ordinary(inner)
        found: list[int] = []
        for m in self._matches.finditer(inner):
            found += self.encode_match(m[0].encode("utf-8"), leaf)
        return found

    @functools.cached_property
    def _matches(self) -> regex.Pattern:
        return regex.compile(self.encoding._pat_str)

    # The monoid of the bytes of one match.

    def encode_match(self, piece: bytes, leaf: int = LEAF) -> list[int]:
        if len(piece) <= leaf:
            return self.encoding._encode_single_piece(piece)
        middle = len(piece) // 2
        return self.join_match(self.encode_match(piece[:middle], leaf), self.encode_match(piece[middle:], leaf))

    def join_match(self, left: list[int], right: list[int]) -> list[int]:
        """Grows the window on the side whose end pair isn't final; at most all of both is re-encoded."""
        if not left or not right or self._final(left[-1], right[0]):
            return left + right
        a = b = WINDOW
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = b"".join(self.bytes_of[i] for i in left[len(left) - a :] + right[:b])
            ids = self.encoding._encode_single_piece(window)
            good_left = a == len(left) or self._final(left[-a - 1], ids[0])
            good_right = b == len(right) or self._final(ids[-1], right[b])
            if good_left and good_right:
                return left[: len(left) - a] + ids + right[b:]
            a, b = a * (1 if good_left else 2), b * (1 if good_right else 2)

    def _final(self, a: int, b: int) -> bool:
        return self.encoding._encode_single_piece(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    # Decoding.

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return self.encoding.decode_bytes(ids)
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)


def encode(df: DataFrame, text: str = "text", key: str = "doc_id", ranks: str = RANKS, leaf: int = LEAF) -> DataFrame:
    """A row for each of `df`: the key, n_tokens, ids, and lossless: whether the ids decode to the text."""

    def row(t: Tokenizer, s: str) -> tuple[int, list[int], bool]:
        ids, decoded = _pair(t, s, leaf)
        return len(ids), ids, decoded == s.encode("utf-8", "surrogatepass")

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("lossless", T.BooleanType())]
    return _each(df, text, key, ranks, leaf, T.StructType(fields), row)


def digests(df: DataFrame, text: str = "text", key: str = "doc_id", ranks: str = RANKS, leaf: int = LEAF) -> DataFrame:
    """A row for each of `df`: the key, n_tokens, ids_sha256 and decoded_sha256; ids never leave the task that made them."""

    def row(t: Tokenizer, s: str) -> tuple[int, str, str]:
        ids, decoded = _pair(t, s, leaf)
        return len(ids), hashlib.sha256(" ".join([t.decimals[i] for i in ids]).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _each(df, text, key, ranks, leaf, T.StructType(fields), row)


def _pair(t: Tokenizer, s: str, leaf: int) -> tuple[list[int], bytes]:
    ids = t.encode(s, leaf)
    return ids, t.decode(ids, leaf)


def _each(df: DataFrame, text: str, key: str, ranks: str, leaf: int, fields: T.StructType, row) -> DataFrame:
    rows = df.select(df[key], text_of(text).alias("_text"))
    schema = T.StructType([rows.schema[0], *fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(public_tokenizers.path(ranks))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [row(t, s) for s in part.column(1).to_pylist()]
                columns = [pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), list(arrow)[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow.field(0).type), *columns], schema=arrow)

    return rows.mapInArrow(run, schema)
