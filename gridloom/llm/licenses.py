"""License scans.

Aho-Corasick automata find notice phrases over a text's words and identifier tags over the text itself; a shunting-yard
parser turns the expression after a tag into a tree of and/or/with, which is evaluated to its licences and to how far
it lets one go: an `or` allows the freest of its sides, an `and` binds to the strictest, `with` relaxes a licence by an
exception.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case.

Defined results: a null or empty text has no words, no places and score 0; an expression reaches to the end of its line or to the
next tag, and its longest start that parses counts. If words follow that start, or if there is none, what stands there may be prose: then
a name is a licence id if its family is known or it holds a digit, `-`, `.` or `+`, and a start with other names is none. An expression
that is none gives the label of each licence id in it and no terms. Repeated rows are each scanned; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.common import text_of

#: Base phrases and labels; given by the query's contract.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Phrases and labels of this scan.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc",
    "creative commons zero": "cc0",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:", "license-identifier:")
#: How much a licence family asks, by the start of its identifier.
TERMS = {"public-domain": 0, "cc0": 0, "unlicense": 0, "mit": 1, "isc": 1, "bsd": 1, "apache": 1, "zlib": 1, "cc-by-sa": 3, "cc-by-nc": 4, "cc-by": 1, "mpl": 2, "epl": 2, "lgpl": 2, "gpl": 3, "agpl": 4}
NAMES = ("public", "permissive", "weak copyleft", "copyleft", "restricted")
#: What one place of each kind says, at most; places of different kinds are independent evidence.
TAG_WEIGHT, PHRASE_WEIGHT = 0.95, 0.8

_WORD = bytes(i if i >= 128 or 48 <= i < 58 or 97 <= i < 123 else i + 32 if 65 <= i < 91 else 32 for i in range(256))
_EXPRESSION = re.compile(r"[\t ]*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]*[a-z0-9+]", re.ASCII)
_TOKENS = re.compile(rf"(?:\s*(?:{_TOKEN.pattern}))*", re.ASCII)
_BINDS = {"or": 1, "and": 2, "with": 3}


@dataclass(frozen=True)
class Node:
    op: str  # or, and, with, id
    left: Node | str
    right: Node | None = None


def _read(tokens: list[str]) -> tuple[list[Node], list[str], int, int]:
    """Operands and operators, how many tokens the longest start that is an expression has, and how many any expression can start with."""
    out: list[Node] = []
    ops: list[str] = []
    brackets = whole = 0
    operand = True
    for n, token in enumerate(tokens):
        try:
            if token == "(":
                if not operand:
                    raise ValueError("an operator is missing")
                ops.append(token)
                brackets += 1
            elif token == ")":
                while ops and ops[-1] != "(":
                    _reduce(out, ops)
                if operand or not ops:
                    raise ValueError("a bracket has no other")
                ops.pop()
                brackets -= 1
            elif token in _BINDS:
                if operand:
                    raise ValueError("an operand is missing")
                while ops and ops[-1] != "(" and _BINDS[ops[-1]] >= _BINDS[token]:
                    _reduce(out, ops)
                ops.append(token)
                operand = True
            else:
                if not operand:
                    raise ValueError("an operator is missing")
                out.append(Node("id", token))
                operand = False
            if not operand and not brackets:
                if ops and ops[-1] == "with":
                    _reduce(out, ops)
                whole = n + 1
        except ValueError:
            return out, ops, whole, n
    return out, ops, whole, len(tokens)


def _reduce(out: list[Node], ops: list[str]) -> None:
    op = ops.pop()
    if len(out) < 2:
        raise ValueError("an operand is missing")
    right = out.pop()
    if op == "with" and (right.op != "id" or out[-1].op != "id"):
        raise ValueError("with joins a licence and an exception")
    out.append(Node(op, out.pop(), right))


def _tree(tokens: list[str]) -> Node:
    out, ops, whole, _ = _read(tokens)
    if not tokens or whole != len(tokens):
        raise ValueError("no expression")
    while ops:
        _reduce(out, ops)
    return out[0]


def parse(expression: str) -> Node:
    """The tree of a licence expression; ValueError if it isn't one."""
    return _tree(_TOKEN.findall(expression.lower()))


def licenses(node: Node) -> set[str]:
    found, todo = set(), [node]
    while todo:
        node = todo.pop()
        if node.op == "id":
            found.add(node.left)
        else:
            todo += [node.left] if node.op == "with" else [node.left, node.right]
    return found


def _family(name: str) -> str | None:
    return max((k for k in TERMS if name.startswith(k)), key=len, default=None)


def terms(node: Node) -> int | None:
    """How much the expression asks, as a place in NAMES; None if a licence that matters isn't known."""
    order, todo = [], [node]
    while todo:
        order.append(node := todo.pop())
        if node.op != "id":
            todo += [node.left, node.right]
    asked: list[int | None] = []
    for node in reversed(order):
        if node.op == "id":
            family = _family(node.left)
            asked.append(None if family is None else TERMS[family])
            continue
        b, a = asked.pop(), asked.pop()
        if node.op == "with":
            asked.append(a and max(a - 1, 1))
        elif node.op == "or":
            asked.append(min((x for x in (a, b) if x is not None), default=None))
        else:
            asked.append(None if a is None or b is None else max(a, b))
    return asked[0]


def _formed(name: str) -> bool:
    """Whether a name is a licence id even where prose may stand."""
    family = _family(name)
    return bool(family and name[len(family) :][:1] in ("", "-")) or not name.isalpha()


def _loose(tokens: list[str]) -> set[str]:
    """The licence ids of tokens that are no expression."""
    return {x for n, x in enumerate(tokens) if x not in _BINDS and x not in "()" and not (n and tokens[n - 1] == "with") and _formed(x)}


class Scanner:
    def __init__(self, base: dict[str, str], more: dict[str, str], tags: tuple[str, ...]):
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase, label in {**more, **base}.items():
            self.phrases.add_word(f" {phrase} ", (len(phrase) + 1, label, phrase in base))
        for tag in tags:
            self.tags.add_word(tag, tag)
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: str) -> tuple:
        words = text.encode("utf-8", "surrogatepass").translate(_WORD).split()
        line = " " + b" ".join(words).decode("latin-1") + " "
        ends, base_labels, labels, places = [], set(), set(), 0
        for end, (size, label, is_base) in self.phrases.iter(line):
            labels.add(label)
            places += 1
            if is_base:
                ends.append(end - size)
                base_labels.add(label)
        base = np.searchsorted(np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32), ends).tolist() if ends else []
        found, asked, tagged = [], [], 0
        lower = text.lower()
        if "icense-" in lower:
            sizes: dict[int, int] = {}
            for end, tag in self.tags.iter(lower):
                sizes[end] = max(sizes.get(end, 0), len(tag))
            tagged = len(sizes)
            nexts = [*(end + 1 - size for end, size in sizes.items()), len(lower)][1:]
            for end, until in zip(sizes, nexts, strict=True):
                rest = _EXPRESSION.match(lower, end + 1, max(until, end + 1))[1]
                read = _TOKENS.match(rest)[0]
                tokens = _TOKEN.findall(read)
                *_, whole, _ = _read(tokens)
                tree = _tree(tokens[:whole]) if whole else None
                prose = whole < len(tokens) or any(c.isalnum() for c in rest[len(read) :])
                if tree is None or (prose and not all(map(_formed, licenses(tree)))):
                    labels |= _loose(tokens)
                    continue
                found.append(rest.strip())
                labels |= licenses(tree)
                asked.append(terms(tree))
        score = 1 - (1 - PHRASE_WEIGHT) ** min(places, 8) * (1 - TAG_WEIGHT) ** min(tagged, 8)
        known = [x for x in asked if x is not None]
        return len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, " | ".join(found) or None, NAMES[max(known)] if known else None


_FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("expression", T.StringType()), T.StructField("terms", T.StringType())]


def scan(df: DataFrame, text: str = "text", key: str = "doc_id", base: dict[str, str] = BASE, more: dict[str, str] = MORE, tags: tuple[str, ...] = TAGS) -> DataFrame:
    """A row for each of `df`: key, n_words, n_base, first_word, last_word, base_labels, labels, score, expression, terms."""
    rows = df.select(df[key], text_of(text).alias("_text"))
    schema = T.StructType([rows.schema[0], *_FIELDS])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, more, tags)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = [scanner.scan(s) for s in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow.field(0).type), *(pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), list(arrow)[1:], strict=True))], schema=arrow)

    return rows.mapInArrow(run, schema)
