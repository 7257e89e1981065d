"""Each operator against brute force, an exact round trip, or what its method promises."""

import collections
import hashlib
import itertools
import random
import re
import struct
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.llm import attribution, bpe, chat, importance, licenses, mixture, multiset, near_text, near_vectors, registry, units
from gridloom.llm.bpe import tokenizer
from gridloom.llm.common import hashed_words, shingles

SF = "/root/testdata/sf0.001"
TOK = tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def words(n, seed, pool=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


# Words and shingles.


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \n\t", max_size=30), max_size=8))
def test_hashed_words_agree_with_split(texts):
    seen = collections.defaultdict(set)
    for a, b, hashes, owner in hashed_words(pa.array(texts, pa.string())):
        for i in range(b - a):
            own = re.findall(r"[^\x20\x09-\x0D]+", texts[a + i])
            assert len(own) == (owner == i).sum()
            for w, h in zip(own, hashes[owner == i].tolist(), strict=True):
                seen["".join(c.lower() if c.isascii() else c for c in w)].add(h)
    assert all(len(h) == 1 for h in seen.values()) and len({h for s in seen.values() for h in s}) == len(seen)


def test_long_text_hashes_like_a_short_one(monkeypatch):
    from gridloom.llm import common

    texts = pa.array([" ".join(words(500, 1)), "x" * 300 + " y", None])
    whole = [h for *_, h, _ in hashed_words(texts)]
    monkeypatch.setattr(common, "CHUNK", 64)
    assert np.array_equal(np.concatenate(whole), np.concatenate([h for *_, h, _ in hashed_words(texts)]))


# 9. Byte-level BPE.


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aabcdth e  \n\té日😀1'sréx!.-  ", max_size=120), st.integers(1, 16))
def test_bpe_tree_is_the_library(text, leaf):
    assert TOK.encode(text, leaf) == TOK.encoding.encode_ordinary(text)
    assert TOK.decode(TOK.encode(text, leaf), leaf) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdethings", min_size=1, max_size=400), st.integers(1, 8))
def test_bpe_inside_one_match(text, leaf):
    assert TOK.encode_match(text.encode(), leaf) == TOK.encoding._encode_single_piece(text.encode())


def test_bpe_digests_are_the_library_s(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in bpe.digests(docs).collect()}
    for r in docs.collect():
        ids = TOK.encoding.encode_ordinary(r["text"] or "")
        d = got[r["doc_id"]]
        assert (d["n_tokens"], d["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert d["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


# 2. Attribution.


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_against_a_loop(spark, rule):
    rng = random.Random(3)
    rows = []
    for i in range(30):
        text = "".join(rng.choices(["the ", "é", "\n", "\n\n", "ing", " ", "😀", "w1 "], k=40))
        cuts = sorted(rng.sample(range(len(text) + 1), 6))
        rows.append((i, text, [(cuts[0], cuts[1]), (cuts[2], cuts[3]), (cuts[3], cuts[5])]))
    df = spark.createDataFrame(rows, "doc_id long, text string, parts array<struct<start:long,end:long>>")
    got = collections.defaultdict(float)
    for r in attribution.count_tokens(df, sections="parts", rule=rule).collect():
        got[r["doc_id"], r["section"]] += r["n_tokens"]
    want = collections.defaultdict(float)
    for i, text, parts in rows:
        data, at = text.encode(), 0
        for b in (TOK.bytes_of[t] for t in TOK.encoding.encode_ordinary(text)):
            start = sum((c & 0xC0) != 0x80 for c in data[: at + 1]) - 1
            stop = sum((c & 0xC0) != 0x80 for c in data[: at + len(b)])
            held = [max(0, min(stop, e) - max(start, s)) for s, e in parts]
            if rule == "share":
                for k, h in enumerate(held):
                    want[i, k] += h / (stop - start)
                want[i, -1] += 1 - sum(held) / (stop - start)
            elif not any(held) or (rule == "start" and not any(s <= start < e for s, e in parts)):
                want[i, -1] += 1
            else:
                want[i, held.index(max(held)) if rule == "majority" else next(k for k, (s, e) in enumerate(parts) if s <= start < e)] += 1
            at += len(b)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in {*got, *want})


def test_attribution_counts_all_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in attribution.totals(attribution.count_tokens(docs)).collect()}
    assert got == {r["doc_id"]: len(TOK.encoding.encode_ordinary(r["text"])) for r in docs.collect()}


# 10. Chats.


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb\\n<|"]), st.text(alphabet="<|im_end>\\ \nab", max_size=20)), max_size=6))
def test_chat_round_trip(turns):
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    lengths = np.zeros(max(TOK.bytes_of) + 1, np.int64)
    for i, b in TOK.bytes_of.items():
        lengths[i] = len(b)
    _, starts, ends = chat._encode(TOK, lengths, formatted)
    masks = chat.mask(starts, ends, spans)
    assert chat.masked_text(formatted, masks, starts, ends) == "".join(x for r, x in turns if r == "assistant")


def test_chat_query_and_full_output_agree(spark):
    got = {r["conv_id"]: r for r in registry.op10_chat_format(spark, SF).collect()}
    assert got[-1]["n_turns"] == 2 and got[-1]["loss_sha256"] == hashlib.sha256(registry.HOSTILE.encode()).hexdigest()
    full = chat.format_chats(spark.read.parquet(f"{SF}/conversations.parquet")).limit(5).collect()
    assert all(len(r["ids"]) == len(r["loss_mask"]) and r["loss_sha256"] == got[r["conv_id"]]["loss_sha256"] for r in full)


# 7. Licences.


def test_license_places_against_a_loop():
    rng = random.Random(5)
    pool = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "é", "License", "MIT"]
    s = licenses.Scanner(licenses.BASE, {}, licenses.TAGS)
    for _ in range(300):
        text = "".join(rng.choice(pool) + rng.choice([" ", "-", "\n", ", ", ""]) for _ in range(rng.randrange(40)))
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
        places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
        got = s.scan(text)
        assert got[:5] == (len(own), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))


@pytest.mark.parametrize(
    ("expression", "ids", "terms"),
    [
        ("MIT OR Apache-2.0", {"mit", "apache-2.0"}, 1),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", {"gpl-2.0-only", "mit"}, 2),
        ("(MIT AND GPL-3.0) OR BSD-3-Clause", {"mit", "gpl-3.0", "bsd-3-clause"}, 1),
        ("MIT AND GPL-3.0 OR AGPL-3.0", {"mit", "gpl-3.0", "agpl-3.0"}, 3),
    ],
)
def test_license_expressions(expression, ids, terms):
    tree = licenses.parse(expression)
    assert licenses.licenses(tree) == ids and licenses.terms(tree) == terms


@pytest.mark.parametrize("bad", ["", "MIT OR", "(MIT", "MIT)", "MIT Apache", "AND", "(MIT OR ISC) WITH x", "()"])
def test_license_expressions_that_are_none(bad):
    with pytest.raises(ValueError):
        licenses.parse(bad)


def test_license_tag_in_prose():
    got = licenses.Scanner(licenses.BASE, licenses.MORE, licenses.TAGS).scan("// SPDX-License-Identifier: MIT OR GPL-2.0-only */ and so on")
    assert got[5] == "gpl-2.0-only,mit" and got[8] == "permissive" and 0 < got[6] <= 1


def test_license_expressions_of_any_length():
    scan = licenses.Scanner(licenses.BASE, licenses.MORE, licenses.TAGS).scan
    tag = "SPDX-License-Identifier: "
    for n in (40, 20_000):
        many = " AND ".join(["MIT"] * n + ["AGPL-3.0"])
        for text in (many, f"({many})", f"({many}) */ and so on", "(" * n + many + ")" * n, "MIT AND (" * n + "AGPL-3.0" + ")" * n):
            got = scan(tag + text)
            assert (got[5], got[8]) == ("agpl-3.0,mit", "restricted") and got[7] == text.lower()
    assert scan(f"{tag}MIT\n{tag}ISC {tag}BSD-3-Clause")[5] == "bsd-3-clause,isc,mit"


@pytest.mark.parametrize(("text", "labels"), [("(MIT OR Apache-2.0", "apache-2.0,mit"), ("AND MIT", "mit"), ("(GPL-2.0 WITH x AND own-1", "gpl-2.0,own-1"), ("(see the file", ""), ("see the file", ""), ("see mit", "mit"), ("((MIT) ISC and mitigate", "isc,mit"), ("", "")])
def test_license_ids_of_what_does_not_parse(text, labels):
    got = licenses.Scanner({}, {"none": "none"}, licenses.TAGS).scan("SPDX-License-Identifier: " + text)
    assert got[5] == labels and got[7] is None and got[8] is None


def test_license_names_that_stand_alone():
    scan = licenses.Scanner({}, {"none": "none"}, licenses.TAGS).scan
    assert scan("license-identifier: WTFPL */")[5] == "wtfpl" and scan("SPDX-LiCeNsE-Identifier: mit")[5] == "mit"
    assert scan("license-identifier: own-2 and so on")[5] == "own-2" and scan("license-identifier: own and so on")[5] == ""


def test_many_licences_and_many_places():
    scan = licenses.Scanner(licenses.BASE, licenses.MORE, licenses.TAGS).scan
    for text in (" or ".join(f"x-{i}" for i in range(80)), "(" + " or ".join(f"x-{i}" for i in range(80)) + ")"):
        assert scan(f"SPDX-License-Identifier: {text}")[5] == ",".join(sorted(f"x-{i}" for i in range(80)))
    start = time.perf_counter()
    got = scan("cc by " * 1_000_000)
    assert got[:4] == (2_000_000, 1_000_000, 0, 1_999_998) and time.perf_counter() - start < 20


def test_license_scan_against_a_loop():
    """Labels, score and terms word by word and line by line, for expressions without brackets or with."""
    rng = random.Random(11)
    known = {"mit": 1, "isc": 1, "gpl-3.0": 3, "agpl-3.0": 4, "cc0-1.0": 0, "own-1": None}
    phrases = {**licenses.MORE, **licenses.BASE}

    def term(expression):
        # An expression without brackets: `or` of `and`s.
        sides = [[known[x.split(" with ")[0]] if " with " not in x else known[x.split(" with ")[0]] and max(known[x.split(" with ")[0]] - 1, 1) for x in side.split(" and ")] for side in expression.split(" or ")]
        asked = [None if None in side else max(side) for side in sides]
        return min((x for x in asked if x is not None), default=None)

    for _ in range(400):
        lines, labels, asked, tags = [], set(), [], 0
        for _ in range(rng.randrange(5)):
            if rng.random() < 0.5:
                parts = [rng.choice(list(known)) + (" with x-exception" if rng.random() < 0.2 else "") for _ in range(rng.randrange(1, 5))]
                expression = parts[0] + "".join(rng.choice([" and ", " or "]) + p for p in parts[1:])
                lines.append(f"// SPDX-License-Identifier: {expression.upper()}")
                labels |= {p.split(" with ")[0] for p in parts}
                asked.append(term(expression))
                tags += 1
            else:
                lines.append(" ".join(rng.choice([*phrases, "prose", "words"]) for _ in range(rng.randrange(4))))
        text = "\n".join(lines)
        own = re.findall(r"[0-9a-z]+", text.lower())
        places = [label for p, label in phrases.items() for i in range(len(own)) if own[i : i + len(p.split())] == p.split()]
        got = licenses.Scanner(licenses.BASE, licenses.MORE, licenses.TAGS).scan(text)
        asked = [x for x in asked if x is not None]
        assert got[5] == ",".join(sorted(labels | set(places)))
        assert got[6] == pytest.approx(1 - 0.2 ** min(len(places), 8) * 0.05 ** min(tags, 8))
        assert got[8] == (licenses.NAMES[max(asked)] if asked else None)


def test_longest_start_against_all_starts():
    rng = random.Random(7)

    def parses(tokens):
        try:
            return bool(licenses.parse(" ".join(tokens)))
        except ValueError:
            return False

    for _ in range(3000):
        tokens = [rng.choice(["mit", "isc", "(", ")", "or", "and", "with"]) for _ in range(rng.randrange(12))]
        whole = licenses._read(tokens)[2]
        assert whole == max((n for n in range(len(tokens) + 1) if parses(tokens[:n])), default=0)


# 5. Multiset hash.


def test_edits_and_neighbours(spark):
    rows = {r["doc_id"]: r for r in registry.op5_multiset_hash(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    prints = collections.defaultdict(set)
    for d, nxt in zip(docs, [*docs[1:], docs[0]], strict=True):
        k = len(d["text"]) // 3
        text = d["text"][: len(d["text"]) - k] + nxt["text"][:k]
        r = rows[d["doc_id"]]
        assert r["n_chars"] == len(d["text"]) and r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        prints[d["text"]].add(r["fingerprint"])
        assert (r["near_edited"] == 1) == (r["fingerprint"] == r["edited_fingerprint"])
        assert 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values()) and len({p for s in prints.values() for p in s}) == len(prints)
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.3 > 0.1 > np.mean([r["near_next"] for r in rows.values()])


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_document_by_ranges(spark, parts):
    ids = [5, 5, 9, 1, 100, 7, 3, 3, 3, None, 50]
    df = spark.createDataFrame([(i, f"{i}-{k}") for k, i in enumerate(ids)], "k long, v string").repartition(3)
    order = sorted(((i, f"{i}-{k}") for k, i in enumerate(ids)), key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), -signed(xxhash.xxh64_intdigest(r[1].encode(), 42)), r[1]))
    want = {a[1]: b[1] for a, b in zip(order, [*order[1:], order[0]], strict=True)}
    assert {r["v"]: r["_next"] for r in multiset.with_next(df, "k", F.col("v"), "v", parts).collect()} == want


def test_hot_ids_are_cut_into_ranges(spark):
    ids = [None] * 300 + [7] * 200 + list(range(20))
    df = spark.createDataFrame([(i, f"{k}") for k, i in enumerate(ids)], "k long, v string")
    with_next = multiset.with_next(df, "k", F.col("v"), "v", 16)
    assert max(r["count"] for r in with_next.groupBy(F.spark_partition_id()).count().collect()) < 400
    order = sorted(((i, f"{k}") for k, i in enumerate(ids)), key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), -signed(xxhash.xxh64_intdigest(r[1].encode(), 42)), r[1]))
    assert {r["v"]: r["_next"] for r in with_next.collect()} == {a[1]: b[1] for a, b in zip(order, [*order[1:], order[0]], strict=True)}


def signed(x):
    return x - 2**64 if x >> 63 else x


def fingerprint_by_loop(text):
    """The sums of a text's units, from the definition of xxHash64 with a seed hashed from the number of a pair of lanes."""
    dense, sparse = [0] * 8, collections.Counter()
    for u in re.split(r"\n+|(?<=[.!?])\s+", text, flags=re.ASCII):
        if u:
            h = lambda j: xxhash.xxh64_intdigest(u.encode(), xxhash.xxh64_intdigest(struct.pack("<i", j), 42))  # noqa: B023, E731
            for j in range(8):
                dense[j] = (dense[j] + (h(j // 2) >> 32 * (j % 2))) % 2**32
            e = h(-1)
            zeros = next((k for k in range(31) if e >> k & 1), 31)
            sparse[zeros * 32 + (e >> 32) % 32] += e >> 48
    lanes = {k: v % 2**16 for k, v in sparse.items() if v % 2**16}
    return "".join(f"{x:08x}" for x in dense) + "." + "".join(f"{k << 16 | v:07x}" for k, v in sorted(lanes.items())), lanes


def likeness_by_loop(a, b):
    (one, x), (two, y) = a, b
    if one.split(".")[0] == two.split(".")[0]:
        return 1.0
    least = 0
    if len(x) + len(y) > 20:
        for s in range(31):
            if any(sum(k // 32 == s for k in z) > 20 for z in (x, y)):
                least = s + 1
    x, y = ({k: v for k, v in z.items() if k // 32 >= least} for z in (x, y))
    return sum(y.get(k) == v for k, v in x.items()) / len({*x, *y}) if x or y else 0.0


def test_fingerprints_against_a_loop(spark):
    got = {r["doc_id"]: r for r in registry.op5_multiset_hash(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    prints = [fingerprint_by_loop(d["text"]) for d in docs]
    for k, (d, nxt) in enumerate(zip(docs, [*docs[1:], docs[0]], strict=True)):
        third = len(d["text"]) // 3
        edited = fingerprint_by_loop(d["text"][: len(d["text"]) - third] + nxt["text"][:third])
        r = got[d["doc_id"]]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (prints[k][0], edited[0])
        assert r["near_edited"] == pytest.approx(likeness_by_loop(prints[k], edited)) and r["near_next"] == pytest.approx(likeness_by_loop(prints[k], prints[(k + 1) % len(docs)]))


def test_fingerprint_adds_and_takes_away(spark):
    a, b = ["one two.", "three.", "four five six."], ["three.", "seven."]
    rows = [(1, "\n".join(a)), (2, "\n".join(b)), (3, "\n".join(b + a)), (4, "\n".join(a[::-1]))]
    f = multiset.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    prints = {r["doc_id"]: r["fingerprint"] for r in f.collect()}
    assert prints[1] == prints[4] != prints[2]
    x, y, z = (f.where(f"doc_id = {i}").select(F.col("dense").alias(f"d{i}"), F.col("sparse").alias(f"s{i}")) for i in (1, 2, 3))
    both = x.crossJoin(y).crossJoin(z)
    joined = multiset.fingerprint(*multiset.combine(F.col("d1"), F.col("s1"), F.col("d2"), F.col("s2")))
    back = multiset.fingerprint(*multiset.combine(F.col("d3"), F.col("s3"), F.col("d2"), F.col("s2"), -1))
    assert both.select(joined, back).first()[:] == (prints[3], prints[1])


def test_likeness_of_long_texts(spark):
    base = [f"unit {i} of a long text." for i in range(3000)]
    rows = [(0, "\n".join(base)), (1, "\n".join(base[:2000] + [f"other {i}." for i in range(1000)])), (2, "\n".join(f"none {i}." for i in range(3000)))]
    f = multiset.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    a, b = f.alias("a"), f.alias("b")
    near = a.join(b, F.col("a.doc_id") < F.col("b.doc_id")).select("a.doc_id", "b.doc_id", multiset.likeness(F.col("a.dense"), F.col("a.sparse"), F.col("b.dense"), F.col("b.sparse"))).collect()
    got = {(r[0], r[1]): r[2] for r in near}
    assert 0.25 < got[0, 1] < 0.75 and got[0, 2] < 0.15


# 4. BagMinHash.


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 6, 300), rng.integers(0, 12, 300)
    b = np.where(rng.random(300) < 0.7, a, b)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    found = []
    for k in range(60):
        g = near_text.mix(base + np.uint64(k * 7919))
        both = np.concatenate([g, g[b > 0]])
        s = near_text.signatures(both, np.repeat([0, 1], [300, (b > 0).sum()]), np.concatenate([a, b[b > 0]]), 2)
        found.append((s[0] == s[1]).mean())
    error = (want * (1 - want) / near_text.M / 60) ** 0.5
    assert abs(np.mean(found) - want) < 4 * error


def test_near_texts_against_all_pairs(spark):
    rng = random.Random(2)
    texts = []
    for base in range(12):
        own = words(120, base)
        texts.append(" ".join(own))
        for _ in range(rng.randrange(12)):
            copy = own[:]
            for _ in range(rng.randrange(1, 9)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += [texts[0], "", "  ", "one two", "One  two"]
    # A common passage in texts that are otherwise apart.
    passage = words(60, 99)
    texts += [" ".join(passage + words(60, 100 + i, 10**6)) for i in range(40)]
    got = {r["doc_id"]: r["group_id"] for r in near_text.group_near(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    bags = near_text._bags(pa.array(texts))
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if near_text.overlap(bags[i], bags[j]) >= 0.8:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    assert got == {i: top(i) for i in range(len(texts))}


def pairs_by_loop(texts):
    """The least index that each text reaches by links, from all pairs."""
    bags = near_text._bags(pa.array(texts))
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bags[i][1].sum() and bags[j][1].sum() and near_text.overlap(bags[i], bags[j]) >= 0.8:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return {i: top(i) for i in range(len(texts))}


@pytest.mark.parametrize(("block", "size", "rows"), [(4, 200, 200_000), (2, 10**6, 3), (1024, 400_000, 1)])
def test_near_texts_in_small_blocks(spark, monkeypatch, block, size, rows):
    monkeypatch.setattr(near_text, "BLOCK", block)
    monkeypatch.setattr(near_text, "WORDS", size)
    monkeypatch.setattr(near_text, "HOT", rows)
    monkeypatch.setattr(near_text, "SHARE", 3 if rows < 10 else 256)
    rng = random.Random(block)
    base = words(150, 31, 10**6)
    texts = []
    for _ in range(40):
        # Texts of one bucket, in chains and apart, all within the reach of a band.
        a, n = rng.randrange(10), rng.randrange(0, 40)
        texts.append(" ".join(base[a : a + 110] + words(n, rng.randrange(6), 10**6)))
    got = {r["doc_id"]: r["group_id"] for r in near_text.group_near(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == pairs_by_loop(texts)


def test_near_texts_of_book_length(spark):
    n = 220_000
    base = [f"w{i * 7919 % 1000003}" for i in range(n)]
    texts = {i: " ".join(base[: n - k] + [f"e{i}x{j}" for j in range(k)]) for i, k in ((7, 0), (11, 29_500), (17, 29_600), (21, 29_700), (30, 9_000))}
    got = {r["doc_id"]: r["group_id"] for r in near_text.group_near(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    want = pairs_by_loop(list(texts.values()))
    assert got == {i: list(texts)[want[k]] for k, i in enumerate(texts)}


def test_shingles_of_short_texts():
    flat = [(a, b, *shingles(w, o, b - a, 5)) for a, b, w, o in hashed_words(pa.array(["", "a b", "a b c d e", "a b c d e f"]))]
    assert [np.bincount(r, minlength=4).tolist() for *_, r in flat] == [[0, 1, 1, 2]]


def test_near_texts_in_empty_blocks(spark, monkeypatch):
    base = words(300, 6, 10**6)
    texts = {i: " ".join(base[: 300 - 14 * (i % 4)] + words(14 * (i % 4), 700 + i // 4, 10**6)) for i in range(24)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    signed = near_text.sign(docs).cache()
    members = signed.select(F.explode("bands").alias("bucket"), "id", "weight", F.col("id").alias("comp"))
    rows = members.join(members.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("weight").alias("words")).where("n > 1"), "bucket").select("bucket", "id", "weight", "comp", "n", "words").cache()

    def groups(size):
        monkeypatch.setattr(near_text, "WORDS", size)
        top = {i: i for i in texts}
        for a, b in near_text._residual(rows, signed, docs, "text", "doc_id", near_text.SIMILARITY).collect():
            old, new = max(top[a], top[b]), min(top[a], top[b])
            top = {i: new if t == old else t for i, t in top.items()}
        return top

    # Blocks of one text or so: a bucket has more of them than members.
    assert len(set(groups(400_000).values())) < len(texts) and groups(200) == groups(400_000)


# 8. Multi-index.


@pytest.mark.parametrize(("recall", "least"), [(1.0, 1.0), (0.999, 0.97)])
def test_vectors_against_all_pairs(spark, recall, least):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(250, 16))
    near = np.concatenate([base, base[:60] + rng.normal(size=(60, 16)) * 0.12, base[:1] + rng.normal(size=(150, 16)) * 0.15, base[:5]])
    labels = rng.integers(0, 2, len(near))
    labels[250:310], labels[310:460], labels[460:] = labels[:60], labels[0], labels[:5]
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(near, labels, strict=True))], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in near_vectors.group_near(df, recall=recall).collect()}
    x = near / np.linalg.norm(near, axis=1, keepdims=True)
    links = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(links, False)
    assert sum(r["n_links"] for r in got.values()) >= least * links.sum() and links.sum() > 1000
    if recall == 1:
        assert [got[i]["n_links"] for i in range(len(near))] == links.sum(axis=1).tolist()
    group = np.arange(len(near))
    for _ in range(len(near)):
        group = np.minimum(group, np.where(links, group[None, :], len(near)).min(axis=1))
    if recall == 1:
        assert [got[i]["component_id"] for i in range(len(near))] == group.tolist()


@pytest.mark.parametrize("rank", [2, 3, 6])
def test_no_cell_in_reach_is_left_out(rank):
    rng = np.random.default_rng(rank)
    x = near_vectors.unit([v.tobytes() for v in rng.normal(size=(2000, rank)) @ rng.normal(size=(rank, 768))])
    grid = near_vectors.Grid(x, 768, 64, near_vectors.radius(768, 0.98, near_vectors.RECALL), 5)
    (i, one), (j, two) = grid.bounds(x)
    a, b = np.nonzero(x @ x.T >= 0.98)
    assert (one[a, i[b]] + two[a, j[b]] <= grid.radius**2).all() and len(a) > len(x)


# 6. Mixing.


def test_mix_fits_targets(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(words(rng.randrange(200), i)), f"s{min(4, int(rng.expovariate(1)))}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture.mix_sources(df).groupBy("row.source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.first("source_size").alias("s")).collect()
    assert all(abs(r["t"] - r["g"]) <= 0.5 and r["g"] <= 2 * r["s"] + 1e-6 for r in got)
    assert abs(sum(r["g"] for r in got) - 1.5 * sum(r["s"] for r in got)) < 1e-6
    taken = mixture.repeated(df).select(mixture.n_words(F.col("text")).alias("n")).agg(F.sum("n")).first()[0]
    assert abs(taken - sum(r["g"] for r in got)) <= len(got)


@pytest.mark.parametrize("few", [4096, 2])
def test_hot_sources_and_repeated_ids(spark, monkeypatch, few):
    monkeypatch.setattr(mixture, "FEW", few)
    monkeypatch.setattr(mixture, "DIGITS", 3 if few > 2 else 13)
    rng = random.Random(few)
    rows = [(rng.choice([None, 4, 4, i]), " ".join(words(rng.randrange(30), i)), rng.choice(["hot", "hot", "hot", "a", None])) for i in range(300)]
    rows += [(5, "the same row again", "again")] * 50 + [(6, "", "none")]
    got = mixture.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target, taken, size = {}, collections.Counter(), collections.Counter()
    for r in got:
        s = r["row"]["source"]
        target[s] = r["target"]
        taken[s] += r["taken"]
        size[s] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["size"] == len((r["row"]["text"] or "").split())
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= (50 if s == "again" else 0.5) for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values())) and target["none"] == 0


def test_levels_agree_with_resharing(spark):
    rng = random.Random(9)
    for _ in range(5):
        sizes = [rng.randrange(1, 1000) for _ in range(7)]
        weights = [(5, 2, 1)[i % 3] for i in range(7)]
        goal, free, left = [0.0] * 7, set(range(7)), 1.5 * sum(sizes)
        while True:
            share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
            over = {i for i in free if share[i] > 2 * sizes[i]}
            if not over:
                goal = [share.get(i, goal[i]) for i in range(7)]
                break
            for i in over:
                goal[i] = 2.0 * sizes[i]
                left -= goal[i]
            free -= over
        df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "_source string, source_size long")
        got = {r["_source"]: r["target"] for r in mixture.targets(df).collect()}
        assert [got[f"s{i}"] for i in range(7)] == pytest.approx(goal)


# 3. Units.


def test_units_make_up_the_text():
    for r in ["", "a", "a.\n\nb c! d", "\n\nx. y", "é. \n z"]:
        assert "".join(r[a:b] for a, b in units.units(r)) == r


def test_passages_go_and_clean_texts_stay(spark):
    sentence = lambda k: " ".join(words(12, k, 10**6)).capitalize() + "."
    passage = " ".join(sentence(1000 + i) for i in range(6)) + " Yes. " + sentence(2000)
    clean = [" ".join(sentence(10 * i + j) for j in range(8)) for i in range(20)]
    rows = [(i, c if i % 4 else c + " " + passage + " " + sentence(3000 + i)) for i, c in enumerate(clean)]
    got = {r["doc_id"]: r for r in units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["text"] == rows[0][1]
    for i, text in rows[1:]:
        if i % 4:
            assert got[i]["text"] == text and got[i]["removed"] == []
        else:
            assert passage[:40] not in got[i]["text"] and "Yes." not in got[i]["text"] and got[i]["text"].startswith(clean[i])
            rest = "".join(text[a:b] for a, b in zip([0, *(r["end"] for r in got[i]["removed"])], [*(r["start"] for r in got[i]["removed"]), len(text)], strict=True))
            assert rest == got[i]["text"]


def test_short_lines_go_whatever_stands_before(spark):
    own = lambda i: " ".join(words(12, 50 + i, 10**6))
    rows = [(i, f"{own(i)}\nHome page\n{own(100 + i)} Yes.\nShare this. Print.\n{own(200 + i)}, yes.") for i in range(5)]
    got = {r["doc_id"]: r["text"] for r in units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    for i, text in rows[1:]:
        assert got[i] == text.replace("Home page\n", "").replace("Share this. Print.\n", "")


def named(text):
    """What of a text may go, word by word: spans of words and what they go by."""
    own = [(m.start(), m[0].lower()) for m in re.finditer(r"\S+", text)]
    starts = {a for a, _ in units.units(text)[1:]}
    first, line, clause = [], [], []
    for k, (at, w) in enumerate(own):
        gap = "\n" if k == 0 else text[own[k - 1][0] + len(own[k - 1][1]) : at]
        line.append("\n" in gap)
        clause.append(line[-1] or own[k - 1][1][-1] in ".!?,;:")
        first.append(clause[-1] or at in starts)
    said = [w for _, w in own]
    parts = lambda flags, a, b: [(x, y) for x, y in itertools.pairwise([*(k for k in range(a, b) if k == a or flags[k]), b])]
    out = []
    for a, b in parts(line, 0, len(own)) if own else []:
        clauses = parts(clause, a, b)
        if len(clauses) == 1 or any(y - x < 8 for x, y in clauses):
            out.append((a, b, tuple(said[a:b])))
        for x, y in clauses:
            own_units = parts(first, x, y)
            if len(clauses) == 1 and len(own_units) == 1:
                continue
            if len(clauses) > 1 and len(own_units) > 1 and y - x >= 8:
                out.append((x, y, tuple(said[x:y])))
            for p, q in own_units:
                back = p
                while q - back < 8 and back > 0:
                    back -= 1
                    while not first[back]:
                        back -= 1
                if q - back >= 8:
                    out.append((p, q, tuple(said[back:q]) if q - p >= 8 else (q - p, *said[back:q])))
    return [a for a, _ in own], out


def dedup_by_loop(rows):
    """{row: (text, removed)} of (id, text) rows, in the order of ids, rows that share one by the order given."""
    seen, out = set(), []
    for text in rows:
        starts, names = named(text)
        mine, gone = set(), set()
        for a, b, name in names:
            if name in seen or name in mine:
                gone |= set(range(a, b))
            mine.add(name)
        seen |= mine
        edges = [0, *starts[1:], len(text)]
        spans = []
        for k in sorted(gone):
            if spans and spans[-1][1] == edges[k]:
                spans[-1] = (spans[-1][0], edges[k + 1])
            else:
                spans.append((edges[k], edges[k + 1]))
        out.append(("".join(text[x:y] for x, y in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)], strict=True)), spans))
    return out


def test_units_against_a_loop(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = {i: x for (i, _), x in zip(docs, dedup_by_loop([t for _, t in docs]), strict=True)}
    got = {r["doc_id"]: (r["text"], [(x["start"], x["end"]) for x in r["removed"]]) for r in units.dedup_units(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    assert got == want
    assert sum(len(t) for _, t in docs) > 1.05 * sum(len(t) for t, _ in want.values())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aaab  .\n", max_size=90), max_size=5))
def test_units_of_a_run_against_a_loop(texts):
    found = units.Cut(texts)
    one, _, owner = found.distinct()
    first = {}
    for d, o in zip(one.tolist(), owner.tolist(), strict=True):
        first[d] = min(o, first.get(d, o))
    kept = found.clean(np.array(list(first), np.uint64), np.array(list(first.values()), np.int64))
    assert kept == dedup_by_loop(texts)


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    line = lambda k: " ".join(words(12, 70 + k, 10**6))
    rows = [(7, line(0)), (7, line(0)), (7, f"{line(1)}\n{line(0)}"), (None, line(2)), (None, f"{line(2)}\n{line(3)}"), (9, f"{line(1)}\n{line(2)}"), (None, None)]
    got = units.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = "\n".join(r["text"] or "" for r in got).split("\n")
    assert sorted(x for x in left if x) == sorted(map(line, range(4)))
    assert {x for r in got if r["doc_id"] for x in r["text"].split("\n") if x} == {line(0), line(1), line(2)}


def test_a_line_counts_once_however_its_units_are_named():
    clean = lambda text: units.Cut([text]).clean(units.Cut([text]).digest[0], units.Cut([text]).owner)[0][0]
    text = "a b. c\n \nx\nx. \n\nlast line here"
    assert clean(text) == text
    assert clean(text + "\nx") == text + "\n"


@pytest.mark.parametrize("marks", [0, 0.03, 0.1, 0.3])
def test_no_fifty_words_of_an_earlier_text_stay(marks):
    rng = random.Random(marks)

    def prose(n):
        return [f"w{rng.randrange(10**6)}" + (rng.choice([".", ",", "\n"]) if rng.random() < marks else "") for _ in range(n)]

    for _ in range(150):
        run = prose(50)
        one, two = (" ".join(prose(rng.randrange(80)) + run + prose(rng.randrange(80))) for _ in range(2))
        first, cut = units.Cut([one]).digest[0], units.Cut([two])
        kept = cut.digest[0][~np.isin(cut.digest[0], first)]
        (text, gone), n = cut.clean(kept, np.zeros(len(kept), np.int64))[0], cut.n_units[0]
        left = re.findall(r"\S+", text)
        assert " ".join(w.strip() for w in run).split() not in [left[i : i + 50] for i in range(len(left) - 49)]
        removed = sum(len(two[a:b].split()) for a, b in gone)
        assert 0 < removed <= 50 and n == len(units.units(two))


def test_long_units_are_cut_alike_in_chunks_and_in_any_case(monkeypatch):
    text = " ".join(words(300, 3, 10**6)) + "\u00a0É é\U00010400 " + "x" * 200 + " " + " ".join(words(30, 4))
    whole = units.units(text)
    assert max(len(text[a:b].split()) for a, b in whole) <= units.REACH + 1
    assert whole == units.units(text.upper())
    monkeypatch.setattr(units, "CHUNK", 64)
    assert units.units(text) == whole and "".join(text[a:b] for a, b in whole) == text


def test_new_columns_give_way(spark):
    got = units.dedup_units(spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, n_units int, removed string"))
    assert got.columns == ["doc_id", "text", "n_units", "removed", "_gl_n_units", "n_chars_removed", "_gl_removed"]
    assert got.first()[:5] == (1, "a b", 5, "x", 1)


# 1. Importance resampling.


def test_importance_keeps_good_and_drops_junk(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    # Fitted on half of the labels, judged on the rest.
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    kept = importance.Chosen(docs, labels.where(half)).sample().select("doc_id", F.lit(1).alias("k"))
    r = labels.where(~half).join(kept, "doc_id", "left").groupBy("quality", "toxic").agg(F.avg(F.coalesce("k", F.lit(0))).alias("share")).collect()
    share = {(x["quality"], x["toxic"]): x["share"] for x in r}
    assert share[1, 0] > 0.97 and share[0, 0] < 0.15


def test_importance_against_a_loop(spark):
    """Models, weights, keys and the chosen documents from n-grams counted one by one."""
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(docs[0][0], docs[0][1]), (10**6, None), (10**6 + 1, "")]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    chosen = importance.Chosen(frame, labels)
    got = collections.Counter((r["doc_id"], r["n_grams"]) for r in chosen.sample().collect())
    buckets = 1 << max(16, int(16 * sum(len((t or "").encode()) for _, t in docs) ** 0.5).bit_length())
    assert len(chosen.model.value) == buckets
    hashed = {}

    def grams(text):
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        for w in own:
            if w not in hashed:
                hashed[w] = int(next(h for *_, h, _ in hashed_words(pa.array([w])))[0])
        h = [hashed[w] for w in own]
        two = [int(importance.mix(np.array([(a * int(importance._PAIR[0]) + b * int(importance._PAIR[1])) % 2**64], np.uint64))[0]) for a, b in itertools.pairwise(h)]
        return [x >> 64 - buckets.bit_length() + 1 for x in h + two], sum(h)

    good = collections.defaultdict(lambda: True)
    for r in labels.collect():
        if r["doc_id"] is not None and r["quality"] is not None:
            good[r["doc_id"]] &= r["quality"] == 1 and not r["toxic"]
    held = {i: signed(xxhash.xxh64_intdigest(struct.pack("<q", i), xxhash.xxh64_intdigest(struct.pack("<i", importance.SEED + 1), 42))) % 4 == 0 for i in good}
    raw, target, own = collections.Counter(), collections.Counter(), [grams(t) for _, t in docs]
    for (i, _), (g, _) in zip(docs, own, strict=True):
        raw.update(g)
        if i in good and good[i] and not held[i]:
            target.update(g)
    share = target.total() / raw.total()
    ratio = {k: np.log((target[k] + 5) / (n * share + 5)) for k, n in raw.items()}
    weight = [sum(ratio[x] for x in g) for g, _ in own]
    noise = [int(importance.mix(importance.mix(np.array([i + importance.SEED], np.uint64)) + np.uint64(said % 2**64))[0]) for (i, _), (_, said) in zip(docs, own, strict=True)]
    key = [w - np.log(-np.log(((d >> 11) + 0.5) * 2.0**-53)) for w, d in zip(weight, noise, strict=True)]
    judged = sorted((w for (i, _), w in zip(docs, weight, strict=True) if i in good and good[i] and held[i]), reverse=True)
    least = judged[int(np.ceil(importance.KEEP * len(judged))) - 1]
    # Weights are summed in single precision here and there, so the least one and the last key are allowed a little.
    k = sum(w >= least - 1e-3 for w in weight)
    assert chosen.k == k and chosen.least == pytest.approx(least, rel=1e-4, abs=1e-3)
    last = sorted(key, reverse=True)[k - 1]
    assert got == collections.Counter((i, len(g)) for (i, _), (g, _), x in zip(docs, own, key, strict=True) if x >= last - 1e-3)


@pytest.mark.parametrize("seed", range(4))
def test_kth_largest(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([0.0, 1.5, rng.gauss(0, 10**seed)]) for _ in range(40)]
    k = rng.randrange(1, 41)
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    assert importance.kth_largest(df, "v", k, 4) == sorted(values, reverse=True)[k - 1]
