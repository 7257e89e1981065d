"""Substring dedup by hashing lines, the clauses in them and the parts of long clauses.

Units are a text's lines, cut further after marks that end sentences and clauses, and in clauses of more than REACH words at places
that the words around choose (least hash of two words, as in winnowing). So a passage that was put into the middle of
a line is made of units of its own, but for its outermost words, wherever it begins and whatever was edited next to it: any 50
words in a row hold at least one whole unit together with what names it.

A unit is normalised (lower case, words only) and named by a 128-bit digest of its words. Whole clauses of at least MIN_WORDS words have a
digest, and whole lines whatever their length. A unit of fewer than MIN_WORDS words that is cut out of a line is named together with the units before
it, back to MIN_WORDS words, so that `Yes.` inside a line goes only where what leads to it is repeated too; one with fewer
words before it in the text goes only with its clause or line. A unit goes if its own digest, its clause's or its line's is repeated.

Words, units and digests of a run of texts are found together in arrays: a digest is two polynomials of the words' hashes, read
off running sums, so it costs the same whatever it covers. Temporary memory is bounded by CHUNK and the words of one text.

Digests are grouped globally for the least document; within a document the first place counts. What comes back to
a document is the list of digests it keeps, keyed by document, so a line that a third of all documents hold needs no
skewed join: only the grouping sees it, and that sums before the shuffle.

Defined results: each row is a document. Rows rank by id; a row whose id is null or stands in other rows too ranks after all others, by a hash of
its id and text (ids are below 2**62); of rows with the same id and text the first one met keeps what they keep and the others keep nothing. A null text
stays null and has no units; a text without words stays; a text whose units all go becomes empty, its row stays; an
empty table gives no rows; other columns pass through, and where `docs` has a column named n_units, n_chars_removed or removed,
the new one's name starts with _gl_.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.common import CHUNK, _powers, bounded, cut, mix

MIN_WORDS = 8
#: Marks that end a clause where white space follows.
MARKS = ".!?,;:"
#: Places between words of which one at least is a cut. Up to 10, any 50 words in a row hold a whole unit with what names it.
REACH = 10
_ODD = 0x9E3779B97F4A7C15
#: What makes the two halves of a digest, the names of short units and a document's keys apart.
_FIRST, _SECOND, _SHORT, _SIZE = (np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))
#: A value for each character, case ignored, and 0 for white space; beyond these characters there is neither.
_VALUES = mix(np.array([0 if chr(i).isspace() else ord(chr(i).lower()[0]) + 1 for i in range(0x20000)], np.uint64))
_MARK = np.zeros(128, bool)
_MARK[[ord(c) for c in MARKS]] = True


@dataclass
class Words:
    """The words of texts that are joined by line breaks."""

    start: np.ndarray  # of each word, in the joined text
    hash: np.ndarray
    clause: np.ndarray  # whether a clause ends after the word
    line: np.ndarray  # whether a line ends after it
    doc: np.ndarray


def words_of(texts: list[str]) -> Words:
    joined = "\n".join(texts)
    found: list[list[np.ndarray]] = [[], [], [], [], []]
    at = 0
    while at < len(joined):
        end = _blank(joined, at + CHUNK)
        code = np.frombuffer(joined[at:end].encode("utf-32-le", "surrogatepass"), "<u4")
        value = _VALUES.take(code, mode="clip")
        if code.max() >= len(_VALUES):
            value = np.where(code < len(_VALUES), value, mix(code.astype(np.uint64)))
        word = np.zeros(len(code) + 2, bool)
        word[1:-1] = value > 0
        a, b = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
        power, inverse = _powers(len(code))
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(value * power[: len(code)], out=sums[1:])
        hashes = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        for kept, x in zip(found, (a + at, b + at, hashes, _MARK.take(code[b - 1], mode="clip") & (code[b - 1] < 128), np.flatnonzero(code == 10) + at), strict=True):
            kept.append(x)
        at = end
    if not found[0] or not sum(map(len, found[0])):
        none = np.empty(0, np.int64)
        return Words(none, none.astype(np.uint64), none.astype(bool), none.astype(bool), none)
    start, stop, hashes, mark, breaks = map(np.concatenate, found)
    line = np.ones(len(start), bool)
    line[:-1] = np.searchsorted(breaks, start[1:]) > np.searchsorted(breaks, stop[:-1])
    doc = np.searchsorted(_offsets(texts), start, "right") - 1
    return Words(start, hashes, mark | line, line, doc)


def _blank(text: str, at: int) -> int:
    """The first white space at or after a place, or the text's end."""
    while at < len(text) and not text[at].isspace():
        at += 1
    return min(at, len(text))


def _offsets(texts: list[str]) -> np.ndarray:
    """Where each text starts in the joined text."""
    return np.cumsum([0, *(len(s) + 1 for s in texts[:-1])])


def _cuts(w: Words) -> np.ndarray:
    """Whether a clause of more than REACH words is cut after each word: after the word with the least hash of it and the word before, among any
    REACH places between words in a row none of which ends a clause."""
    n = len(w.hash)
    out = np.zeros(n, bool)
    if n <= REACH:
        return out
    place = w.hash * np.uint64(_ODD)
    place[1:] += np.where(w.doc[1:] == w.doc[:-1], w.hash[:-1], np.uint64(0))
    place = (mix(place) >> np.uint64(1)) + np.uint64(1)
    place[w.clause] = 0
    # The last of equal ones, so that a row of one word is cut everywhere.
    windows = np.lib.stride_tricks.sliding_window_view(place, REACH)[:, ::-1]
    for at in range(0, len(windows), CHUNK // 8):
        part = windows[at : at + CHUNK // 8]
        out[np.arange(at, at + len(part)) + REACH - 1 - part.argmin(axis=1)] = True
    return out & (place > 0)


class Cut:
    """The units of texts and the names by which they may go: first unit, unit after the last, digest halves and document of each name."""

    def __init__(self, texts: list[str], min_words: int = MIN_WORDS):
        self.texts, self.offsets = texts, _offsets(texts) if texts else np.empty(0, np.int64)
        w = words_of(texts)
        self.last = np.flatnonzero(w.clause | _cuts(w))
        self.first = np.concatenate([np.zeros(1, np.int64), self.last[:-1] + 1])[: len(self.last)]
        self.size, self.doc, self.start = self.last - self.first + 1, w.doc[self.first], w.start[self.first]
        self.n_units = np.bincount(self.doc, minlength=len(texts))
        self._name(w, min_words)

    def _name(self, w: Words, min_words: int) -> None:
        power, inverse = (p[: len(w.hash)] for p in _powers(len(w.hash)))
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(w.hash ^ salt) * power)]) for salt in (_FIRST, _SECOND)]
        clause_last, line_last = np.flatnonzero(w.clause), np.flatnonzero(w.line)
        clause_of = np.searchsorted(clause_last, self.last)  # of each unit
        line_of = np.searchsorted(line_last, clause_last)  # of each clause
        clause_size, clause_units = np.diff(clause_last, prepend=-1), np.bincount(clause_of, minlength=len(clause_last))
        line_clauses = np.bincount(line_of, minlength=len(line_last))
        with_short = np.bincount(line_of, clause_size < min_words, minlength=len(line_last)) > 0
        whole = np.flatnonzero((line_clauses == 1) | with_short)
        alone = line_clauses[line_of] == 1
        several = np.flatnonzero((clause_units > 1) & ~alone & (clause_size >= min_words))
        own = ~((clause_units == 1) & alone)[clause_of]
        long = np.flatnonzero(own & (self.size >= min_words))
        short = np.flatnonzero(own & (self.size < min_words))
        behind = self.last[short] + 1 - min_words
        doc_first = np.searchsorted(w.doc, self.doc[short])
        short, behind = short[behind >= doc_first], behind[behind >= doc_first]
        context = self.first[np.searchsorted(self.first, behind, "right") - 1]
        unit_at = lambda word: np.searchsorted(self.first, word)
        line_first, clause_first = np.concatenate([[0], line_last + 1])[whole], np.concatenate([[0], clause_last + 1])[several]
        none = np.uint64(0)
        parts = [
            (line_first, line_last[whole] + 1, unit_at(line_first), unit_at(line_last[whole] + 1), none),
            (clause_first, clause_last[several] + 1, unit_at(clause_first), unit_at(clause_last[several] + 1), none),
            (self.first[long], self.last[long] + 1, long, long + 1, none),
            (context, self.last[short] + 1, short, short + 1, _SHORT * self.size[short].astype(np.uint64)),
        ]
        a, b, self.begin, self.after = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(4))
        salt = np.concatenate([np.broadcast_to(p[4], len(p[0])) for p in parts])
        self.digest = [mix((s[b] - s[a]) * inverse[a] + (b - a).astype(np.uint64) * _SIZE + salt) if len(a) else np.empty(0, np.uint64) for s in sums]
        self.owner = self.doc[self.begin] if len(a) else np.empty(0, np.int64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each document's digests once: their halves and the document."""
        order = np.lexsort((self.begin, self.digest[0], self.owner))
        d, o = self.digest[0][order], self.owner[order]
        new = np.ones(len(order), bool)
        new[1:] = (d[1:] != d[:-1]) | (o[1:] != o[:-1])
        self._repeats = order[~new]
        return d[new], self.digest[1][order][new], o[new]

    def clean(self, kept: np.ndarray, kept_by: np.ndarray) -> list[tuple[str, list[tuple[int, int]]]]:
        """Each text without the units that go, and their spans, neighbours joined; `kept` are first halves of digests and `kept_by` their documents."""
        self.distinct()
        key = lambda digest, doc: mix(digest + mix(doc.astype(np.uint64) * np.uint64(_ODD)))
        goes = ~np.isin(key(self.digest[0], self.owner), key(kept, kept_by))
        goes[self._repeats] = True
        depth = np.zeros(len(self.first) + 1, np.int64)
        np.add.at(depth, self.begin[goes], 1)
        np.add.at(depth, self.after[goes], -1)
        gone = np.cumsum(depth)[:-1] > 0
        out = [(s, []) for s in self.texts]
        edge = np.concatenate([[0], np.cumsum(self.n_units)])
        for i in np.unique(self.doc[gone]).tolist():
            a, b, text = edge[i], edge[i + 1], self.texts[i]
            at = self.start[a:b] - self.offsets[i]
            at[0] = 0
            flag = np.concatenate([[False], gone[a:b], [False]])
            ends = np.append(at, len(text))
            spans = list(zip(ends[np.flatnonzero(flag[1:] & ~flag[:-1])].tolist(), ends[np.flatnonzero(flag[:-1] & ~flag[1:])].tolist(), strict=True))
            stays = zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)], strict=True)
            out[i] = ("".join([text[x:y] for x, y in stays]), spans)
        return out


def units(text: str) -> list[tuple[int, int]]:
    """Start of each unit and of the next: units and the breaks after them make up the text."""
    starts = Cut([text]).start.tolist()
    return list(zip([0, *starts[1:]], [*starts[1:], len(text)], strict=True)) if starts else []


def _runs(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    """Rows in runs of about CHUNK bytes, or of one long text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, before = 0, 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
        yield at, end, column.slice(at, end - at).to_pylist()
        at, before = end, int(ends[end - 1])


def ranked(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`docs` with _gl_rank: the id where it is the row's own, else a hash of id and text beyond all ids."""
    own = F.col(key).cast("long")
    repeated = cut(docs.where(F.col(key).isNotNull()).groupBy(own.alias("_gl_id")).agg(F.count("*").alias("_gl_n")).where("_gl_n > 1").select("_gl_id"))
    late = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(key, text), 2)
    met = docs.join(bounded(repeated), own == F.col("_gl_id"), "left")
    return met.withColumn("_gl_rank", F.when(own.isNull() | F.col("_gl_id").isNotNull(), late).otherwise(own)).drop("_gl_id")


def occurrences(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(_h1, _h2, _rank): each digest once of each document, ranked by _gl_rank."""
    rows = docs.select(F.col("_gl_rank").alias("_rank"), F.col(text).alias("_text"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("_h1", "_h2", "_rank")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(0).to_numpy()
            for a, b, given in _runs(batch.column(1)):
                one, two, owner = Cut([s or "" for s in given], min_words).distinct()
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(rank[a:b][owner])], names=["_h1", "_h2", "_rank"])

    return rows.mapInArrow(run, schema)


def kept_digests(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(_rank, _kept): for each document the digests whose earliest document it is."""
    first = occurrences(docs, text, min_words).groupBy("_h1", "_h2").agg(F.min("_rank").alias("_rank"))
    return first.groupBy("_rank").agg(F.collect_list("_h1").alias("_kept"))


REMOVED = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def dedup_units(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of `docs` with the text cleaned, and n_units, n_chars_removed and removed: spans of the original text."""
    rows = ranked(docs, text, key)
    kept = kept_digests(rows, text, min_words).select(F.col("_rank").alias("_gl_r"), F.col("_kept").alias("_gl_kept"))
    joined = rows.join(kept, F.col("_gl_rank") == F.col("_gl_r"), "left")
    # The join has dealt and sorted the rows so; of equal ones only the first keeps digests.
    place = F.row_number().over(Window.partitionBy("_gl_rank").orderBy("_gl_rank"))
    joined = joined.select(*(F.col(c) for c in docs.columns), F.when(place == 1, F.col("_gl_kept")).alias("_gl_kept"))
    taken = {"n_units", "n_chars_removed", "removed"} & set(docs.columns)
    own = [f"_gl_{n}" if n in taken else n for n in ("n_units", "n_chars_removed", "removed")]
    schema = T.StructType([*docs.schema, T.StructField(own[0], T.LongType()), T.StructField(own[1], T.LongType()), T.StructField(own[2], REMOVED)])
    arrow = to_arrow_schema(schema)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, given in _runs(batch.column(at)):
                part = batch.slice(a, b - a)
                texts = [s or "" for s in given]
                lists = part.column(part.num_columns - 1).fill_null([])
                owner = np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                cut = Cut(texts, min_words)
                made = cut.clean(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), owner)
                columns = [*part.columns[:-1]]
                columns[at] = pa.array([None if s is None else m[0] for s, m in zip(given, made, strict=True)], arrow.field(at).type)
                spans = [[{"start": x, "end": y} for x, y in m[1]] for m in made]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cut.n_units.astype(np.int64)), pa.array([sum(y - x for x, y in m[1]) for m in made], pa.int64()), pa.array(spans, arrow.field(len(arrow) - 1).type)], schema=arrow)

    return joined.mapInArrow(run, schema)
