"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, and columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from gridloom.llm import attribution, bpe, chat, importance, licenses, mixture, multiset, near_text, near_vectors, units

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, section string, rep string, id string, ids string, _text string, size string, bucket string"
LONG = "word " * 30_000 + "x" * 50_000


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "a", "b", "c", "d", "e", "f", "g") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, [(1, None, "s"), (2, "", "s"), (3, LONG, "t"), (4, "same text of a few more words", None), (4, "same text of a few more words", None), (5, "same text of a few more words", "t"), (None, "a text whose id is null but not empty", "u"), (6, "\n\n \t", None), (7, "é😀" * 9 + "\x00", "s")]).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, []).cache()


PER_ROW = {
    "bpe": lambda d: bpe.digests(d),
    "encode": lambda d: bpe.encode(d),
    "licenses": lambda d: licenses.scan(d),
    "multiset": lambda d: multiset.edited(d),
    "fingerprints": lambda d: multiset.fingerprints(d),
    "near_text": lambda d: near_text.group_near(d),
    "units": lambda d: units.dedup_units(d),
    "mixture": lambda d: mixture.mix_sources(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_rows_stay(odd, name):
    assert PER_ROW[name](odd).count() == 9


@pytest.mark.parametrize("name", [*PER_ROW, "attribution"])
def test_empty_table(empty, name):
    run = {**PER_ROW, "attribution": attribution.count_tokens}[name]
    assert run(empty).count() == 0


def test_importance_edges(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert importance.Chosen(empty, none).sample().count() == 0
    assert importance.Chosen(odd, none).kept().count() == 9
    labels = spark.createDataFrame([(3, 1, None), (4, 0, 1), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert importance.Chosen(odd, labels).kept().columns == odd.columns


def test_attribution_edges(odd):
    rows = attribution.count_tokens(odd)
    assert rows.where("doc_id = 1").collect()[0][1:] == (0, 0, 0, 0, 0)
    assert rows.where("doc_id = 4").count() == 2


def test_attribution_of_null_and_empty_sections(spark):
    schema = "doc_id long, text string, parts array<struct<start:long,end:long>>"
    rows = [(1, "abcdefgh words", [(0, 3), None, (3, 3), (None, 4), (3, 14)]), (2, "words", None), (3, "words", []), (4, None, [(0, 0)])]
    got = [tuple(r) for r in attribution.count_tokens(spark.createDataFrame(rows, schema), sections="parts").orderBy("doc_id", "section").collect()]
    assert [r[:4] for r in got] == [(1, 0, 0, 3), (1, 1, 3, 3), (1, 2, 3, 14), (2, -1, 0, 5), (3, -1, 0, 5), (4, 0, 0, 0)]
    assert got[1][4:] == (0, 0) and got[3][4] > 0


def test_near_text_edges(odd):
    got = {(r["doc_id"], r["class_id"], r["group_id"], r["kept"]) for r in near_text.group_near(odd).collect()}
    assert (5, 4, 4, False) in got and (4, 4, 4, True) in got
    assert (1, 1, 1, True) in got and (None, None, None, True) in got
    assert (6, 2, 2, False) in got  # no words, as the empty text


def test_unit_edges(odd):
    got = units.dedup_units(odd)
    assert got.where("doc_id = 1").first()["text"] is None
    assert got.where("doc_id = 3").first()["text"].strip() != ""


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, extra string, _text string"
    rows = [(1, 0, "user", None, "", ""), (1, 0, "user", None, "", ""), (1, 1, None, "x", "", ""), (2, None, "assistant", LONG, "", ""), (2, 0, "assistant", "\\<|im_end|>\\", "", ""), (None, 0, "a\nb", "t", "", ""), (None, 1, "assistant", "t", "", "")]
    got = {r["conv_id"]: r for r in chat.digests(spark.createDataFrame(rows, schema)).collect()}
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 0
    assert got[2]["loss_chars"] == len(LONG) + len("\\<|im_end|>\\")
    alone = chat.digests(spark.createDataFrame(rows, schema)).where("conv_id is null").collect()
    assert sorted((r["n_turns"], r["loss_chars"]) for r in alone) == [(1, 0), (1, 1)]
    assert chat.digests(spark.createDataFrame([], schema)).count() == 0


def test_vector_edges(spark):
    schema = "vec_id long, embedding array<float>, label int, id string, rep string, n string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (12, [1.0, 0.0], 2), (1, [1.0, 0.0], 1)]
    got = sorted(tuple(r) for r in near_vectors.group_near(spark.createDataFrame([(*r, "", "", "") for r in rows], schema)).where("vec_id is not null").collect())
    assert got[:4] == [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False)]
    assert all(n == 0 and c == i and k for i, n, c, k in got[4:]) and len(got) == 13
    assert near_vectors.group_near(spark.createDataFrame([], schema)).count() == 0


def test_repeated(odd):
    mixed = mixture.repeated(odd)
    assert mixed.columns == odd.columns
