r"""Chat formatting with offset-aligned masks.

A conversation is rendered whole: for each turn `<|im_start|>`, the role, a line break, the text, `<|im_end|>` and a
line break. Inside roles and texts a backslash is doubled and `<|` is written `<\|`, and a line break in a role is
written `\n`, so control strings stand only where the template put them and reading back undoes the escapes.
The rendered text is encoded once; token spans come from the ids' byte lengths. Each assistant text's span is
intersected with the sorted token spans by binary search, which gives the tokens under the loss mask and how much of
the first and the last token belongs to the text.

Conversations are dealt by id and sorted by turn; a task reads them as a stream and holds one at a time. Rows without an id are dealt
by what they say.

Defined results: a null role or text is empty; a null turn comes first; turns with the same number are sorted by role,
then text, and each kept; each row with a null id is a conversation of its own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.attribution import token_spans
from gridloom.llm.bpe import RANKS, tokenizer

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def render(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The rendered conversation and the spans of the texts to learn from."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == learn and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, f"{END}\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation. A control string can't be part of a text: escaping leaves no `<|` there."""
    turns, at = [], 0
    while at < len(formatted):
        assert formatted.startswith(START, at)
        role_end = formatted.index("\n", at)
        text_end = formatted.index(END, role_end)
        turns.append((unescape_role(formatted[at + len(START) : role_end]), unescape(formatted[role_end + 1 : text_end])))
        at = text_end + len(END) + 1
    return turns


def mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """For each span: first token, token after the last, and the code points it covers."""
    return [(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left")), a, b) for a, b in spans]


def masked_text(formatted: str, masks: list[tuple[int, int, int, int]], starts: np.ndarray, ends: np.ndarray) -> str:
    """What the tokens under the mask say, without the parts of the outer tokens that belong to the template; unescaped."""
    return "".join(unescape(formatted[max(int(starts[i]), a) : min(int(ends[j - 1]), b)]) for i, j, a, b in masks if j > i)


_MASK = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("first_token", "end_token", "char_start", "char_end")]))


def format_chats(df: DataFrame, learn: str = "assistant", ranks: str = RANKS) -> DataFrame:
    """A row for each conversation: conv_id, formatted, ids, loss_mask (a boolean for each id), loss_spans, and what is read back from
    them: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    fields = [T.StructField("formatted", T.StringType()), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("loss_mask", T.ArrayType(T.BooleanType())), T.StructField("loss_spans", _MASK), *_DIGESTS]

    def row(t, lengths, turns):
        formatted, spans = render(turns, learn)
        ids, starts, ends = _encode(t, lengths, formatted)
        masks = mask(starts, ends, spans)
        flags = np.zeros(len(ids), bool)
        for i, j, _, _ in masks:
            flags[i:j] = True
        return formatted, ids.tolist(), flags.tolist(), [dict(zip(("first_token", "end_token", "char_start", "char_end"), x, strict=True)) for x in masks], *_read(formatted, masks, starts, ends)

    return _each(df, fields, row, ranks)


def digests(df: DataFrame, learn: str = "assistant", ranks: str = RANKS) -> DataFrame:
    """As `format_chats`, with only what is read back; texts and ids don't leave the task."""

    def row(t, lengths, turns):
        formatted, spans = render(turns, learn)
        _, starts, ends = _encode(t, lengths, formatted)
        return _read(formatted, mask(starts, ends, spans), starts, ends)

    return _each(df, _DIGESTS, row, ranks)


_DIGESTS = [T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]


def _encode(t, lengths: np.ndarray, formatted: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.array(t.encoding.encode_ordinary(formatted), np.int64)
    return ids, *token_spans(formatted, ids, lengths)


def _read(formatted: str, masks, starts: np.ndarray, ends: np.ndarray) -> tuple[int, str, int, str, int]:
    turns, loss = read_back(formatted), masked_text(formatted, masks, starts, ends)
    said = hashlib.sha256()
    for role, text in turns:
        said.update(f"{role}\n{text}\n".encode())
    return len(turns), said.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)


def _each(df: DataFrame, fields: list[T.StructField], row, ranks: str) -> DataFrame:
    empty = F.lit("")
    rows = df.select("conv_id", F.col("turn").alias("_turn"), F.coalesce(F.col("role"), empty).alias("_role"), F.coalesce(F.col("text"), empty).alias("_text"))
    apart = F.when(F.col("conv_id").isNull(), F.xxhash64("_turn", "_role", "_text"))
    rows = rows.repartition(F.col("conv_id"), apart).sortWithinPartitions("conv_id", "_turn", "_role", "_text")
    schema = T.StructType([rows.schema[0], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(public_tokenizers.path(ranks))
        lengths = np.zeros(max(t.bytes_of) + 1, np.int64)
        for i, b in t.bytes_of.items():
            lengths[i] = len(b)
        held, turns, made, size = None, [], [], 0

        def end(conv):
            made.append((conv, *row(t, lengths, turns)))
            turns.clear()

        def batch_of():
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), arrow, strict=True)], schema=arrow)
            made.clear()
            return out

        for batch in batches:
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if turns and (conv != held or conv is None):
                    end(held)
                    if size > 1 << 20 or len(made) >= 1000:
                        yield batch_of()
                        size = 0
                held = conv
                turns.append((role, text))
                size += len(text)
        if turns:
            end(held)
        if made:
            yield batch_of()

    return rows.mapInArrow(run, schema)
