"""Token counts by offset-mapped attribution.

A document is encoded once, whole. Byte-level ids give their own offsets: running sums of their bytes' lengths, mapped
to code points. An interval join of the sorted token spans with the sorted section spans, both by binary search, then
attributes each token to one section by an explicit rule:

* majority: the section with most of the token's code points, the earlier one at a tie (the default);
* start: the section of its first code point;
* share: each section gets the part of the token's code points that it holds, so counts are fractions.

A token that covers part of a code point has that code point's span. Sections are given as an array of
struct<start, end> over code points, sorted and apart; without it, they are the text's lines, each with its line break.
Tokens that touch no section are counted in a row with section -1, so counts always sum to the document's.

Defined results: a null or empty text has one section (0, 0, 0) without tokens; rows that share an id stay apart; a section of no code points
touches no token; sections that are null, or whose start or end is, are none, and the others are numbered without them; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.bpe import RANKS, tokenizer
from gridloom.llm.common import text_of

RULES = ("majority", "start", "share")


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines, each with its line break; one empty line if there is no text."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    e = np.array(ends, np.int64)
    return np.concatenate([[0], e[:-1]]), e


def token_spans(text: str, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point spans of the tokens of a text."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    data = text.encode("utf-8", "surrogatepass")
    if len(data) == len(text):
        return starts, ends
    first = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # code points begun up to each byte
    return first[starts] - 1, first[ends - 1]


def attribute(t_start: np.ndarray, t_end: np.ndarray, s_start: np.ndarray, s_end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, float]:
    """Each section's tokens, how many of the tokens that touch it touch others too, and the tokens of no section."""
    n = len(s_start)
    counts, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not len(t_start) or not n:
        return counts, crossing, float(len(t_start))
    if not (filled := s_end > s_start).all():
        counts[filled], crossing[filled], outside = attribute(t_start, t_end, s_start[filled], s_end[filled], rule)
        return counts, crossing, outside
    low = np.searchsorted(s_end, t_start, "right")  # first section that ends after the token's start
    high = np.searchsorted(s_start, t_end, "left")  # first section that starts at or after its end
    touched = high - low
    inside = (touched == 1) & (s_start[np.minimum(low, n - 1)] <= t_start) & (t_end <= s_end[np.minimum(low, n - 1)])
    np.add.at(counts, low[inside], 1)
    outside = float((touched <= 0).sum())
    for i in np.flatnonzero((touched > 0) & ~inside):
        k = np.arange(low[i], high[i])
        held = np.minimum(t_end[i], s_end[k]) - np.maximum(t_start[i], s_start[k])
        if len(k) > 1:
            crossing[k] += 1
        if rule == "share":
            counts[k] += held / (t_end[i] - t_start[i])
            outside += 1 - held.sum() / (t_end[i] - t_start[i])
        elif rule == "majority":
            counts[k[np.argmax(held)]] += 1
        elif s_start[k[0]] <= t_start[i]:
            counts[k[0]] += 1
        else:
            outside += 1
    return counts, crossing, outside


def count_tokens(df: DataFrame, text: str = "text", key: str = "doc_id", sections: str | None = None, rule: str = "majority", ranks: str = RANKS) -> DataFrame:
    """A row for each section: key, section, char_start, char_end, n_tokens and n_crossing."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    rows = df.select(df[key], text_of(text).alias("_text"), *([df[sections].alias("_sections")] if sections else []))
    whole = rule != "share"
    schema = T.StructType([rows.schema[0], T.StructField("section", T.LongType()), T.StructField("char_start", T.LongType()), T.StructField("char_end", T.LongType()), T.StructField("n_tokens", T.LongType() if whole else T.DoubleType()), T.StructField("n_crossing", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(public_tokenizers.path(ranks))
        lengths = np.zeros(max(t.bytes_of) + 1, np.int64)
        for i, b in t.bytes_of.items():
            lengths[i] = len(b)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found: list[list[np.ndarray]] = [[], [], [], [], [], []]
                given = part.column(2).to_pylist() if sections else [None] * part.num_rows
                for i, (s, own) in enumerate(zip(part.column(1).to_pylist(), given, strict=True)):
                    own = [x for x in own or [] if x and x["start"] is not None and x["end"] is not None]
                    starts, ends = (np.array([x[k] for x in own], np.int64) for k in ("start", "end")) if sections else lines(s)
                    ids = np.array(t.encoding.encode_ordinary(s), np.int64)
                    counts, crossing, outside = attribute(*token_spans(s, ids, lengths), starts, ends, rule)
                    number = np.arange(len(starts))
                    if outside > 1e-9:
                        number, starts, ends, counts, crossing = (np.append(x, y) for x, y in ((number, -1), (starts, 0), (ends, len(s)), (counts, outside), (crossing, 0)))
                    for kept, x in zip(found, (np.full(len(starts), i), number, starts, ends, counts, crossing), strict=True):
                        kept.append(x)
                if not found[0]:
                    continue
                owner, *columns = map(np.concatenate, found)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)).cast(arrow.field(0).type), *(pa.array(x.astype(np.int64) if f.type == pa.int64() else x, f.type) for x, f in zip(columns, list(arrow)[1:], strict=True))], schema=arrow)

    return rows.mapInArrow(run, schema)


def totals(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Tokens of each document, from `count_tokens`."""
    return sections.groupBy(key).agg(F.sum("n_tokens").alias("n_tokens"))
