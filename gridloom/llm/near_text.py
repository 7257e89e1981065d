"""Near-duplicate texts by BagMinHash.

A text is the multiset of its word 5-shingles. For each shingle and each unit of weight there is a Poisson process of
points on a time axis, each point belonging to one of M signature components; the signature of a multiset holds, for each
component, the first point of all the processes its weights reach, and two components agree with a chance of the weighted
Jaccard similarity. Weights are discretised to whole counts and grouped in a hierarchy of blocks, (0, 1], (1, 2], (2, 4],
(4, 8] and so on: a block has one process at the rate of all its units, whose points then fall to a unit and a component, so a count
of w takes about log w processes, and a time limit ends most of them before their first point: about M log M points are made
for a text of any length. A signature that the limit leaves with a gap is made again with twice the limit, so the limit never shows.

Texts with equal shingles are a class, for which the least id stands. Signatures are cut into BANDS bands of ROWS. In
each bucket the least representative is the centre, every other one is compared with it, and the exact multiset overlap is
verified. Where these links leave a bucket's members in several components, the member with most links is its next
centre, for the members of other components: of a group of edited copies that is the text they were made from. A bucket
that is still in several components is then examined in full: its members are compared in blocks, by signatures and then by
their texts, and each block gives only the links that join components. So no bucket is cut off and none gives all its pairs. Documents are grouped by the components of the verified links.

Hot groups: copies collapse before banding; a bucket's centre is found by a sum before the shuffle; pairs join texts by
id, and a hot centre's pairs are dealt into parts of about SHARE, each with the centre's text; what is known of the hottest buckets and
centres is broadcast to their members, and the others are joined by a shuffle, so no task gets a whole hot one; blocks bound what
one task sees of a bucket.

Defined results: a null text links with nothing; texts without words are copies of each other; a text of fewer words than a
shingle has one shingle of all; a null id stands for itself, its class id is null and it isn't compared; rows that share an id are all kept if the
id is; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gridloom.llm.common import cut, forget, hashed_words, mix, shingles
from gridloom.operators.components import components_of_edges, extended

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 26, 5
M = BANDS * ROWS
#: Mean points for each component before the time limit; a signature has a gap with a chance of about M exp(-LIMIT).
LIMIT = float(np.log(M)) + 3.0
#: Members, and shingles about, in a block of a bucket that is examined in full.
BLOCK, WORDS = 1024, 400_000
#: Buckets or centres that count as hot, at most, and so are broadcast; pairs of one centre in a part, about.
HOT, SHARE = 20_000, 256
#: How far the signatures' estimate may be below the least similarity: over four standard deviations.
SLACK = 4.2 * (SIMILARITY * (1 - SIMILARITY) / M) ** 0.5
#: Elements of multisets handled at once.
ELEMENTS = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)


def bag(grams: np.ndarray, owner: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row with their counts, sorted by row and shingle."""
    order = np.lexsort((grams, owner))
    g, o = grams[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return g[at], o[at], np.diff(np.append(at, len(g)))


def _blocks(grams: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The processes of the elements: seed, row, units in the block, units of it that the count reaches."""
    parts = [(mix(grams + _STEP), owner, np.ones(len(grams), np.int64), np.ones(len(grams), np.int64))]
    low = 1
    while (more := np.flatnonzero(counts > low)).size:
        parts.append((mix(grams[more] + np.uint64((low + 1) * int(_STEP) % 2**64)), owner[more], np.full(len(more), low), np.minimum(counts[more] - low, low)))
        low *= 2
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def signatures(grams: np.ndarray, owner: np.ndarray, counts: np.ndarray, rows: int, m: int = M, limit: float | None = None) -> np.ndarray:
    """rows x m 64-bit components; those of a row without elements are 0."""
    limit = float(np.log(m)) + 3.0 if limit is None else limit
    total = np.bincount(owner, counts, rows)
    seeds, of, width, reach = _blocks(grams, owner, counts)
    first = np.full(rows * m, np.inf)
    until = np.full(rows, 0.0)
    open_rows = total > 0
    until[open_rows] = limit / total[open_rows]
    while open_rows.any():
        live = np.flatnonzero(open_rows[of])
        seed, row, w, top = seeds[live], of[live], width[live], reach[live]
        time = np.zeros(len(seed))
        while len(seed):
            seed = seed + _STEP
            draw = mix(seed)
            time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / (m * w)
            on = time <= until[row]
            seed, row, w, top, time = seed[on], row[on], w[on], top[on], time[on]
            place = mix(draw[on] ^ np.uint64(0xA0761D6478BD642F))
            unit = ((place >> np.uint64(32)) % w.astype(np.uint64)).astype(np.int64)
            hit = unit < top
            component = ((place[hit] & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(first, row[hit] * m + component, time[hit])
        gaps = np.isinf(first.reshape(rows, m)).any(axis=1) & open_rows
        open_rows = gaps
        until[gaps] *= 2
    out = mix(first.view(np.uint64) + _STEP).reshape(rows, m)
    out[total == 0] = 0
    return out


def _signed(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of rows: first, last, signatures, total weights and 128-bit names of the multisets."""
    pending: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flush():
        a, b = pending[0][0], pending[-1][1]
        grams = np.concatenate([p[2] for p in pending])
        owner = np.concatenate([p[3] + (p[0] - a) for p in pending])
        counts = np.concatenate([p[4] for p in pending])
        total = np.bincount(owner, counts, b - a).astype(np.int64)
        name = np.zeros((b - a, 2), np.uint64)
        for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(salt)) * mix(counts.astype(np.uint64) + np.uint64(salt)))])
            at = np.searchsorted(owner, np.arange(b - a + 1))
            name[:, k] = mix(sums[at[1:]] - sums[at[:-1]] + total.astype(np.uint64))
        return a, b, signatures(grams, owner, counts, b - a), total, name

    for a, b, words, owner in hashed_words(texts):
        found, rows_of = shingles(words, owner, b - a, SHINGLE)
        element = bag(found, rows_of, b - a)
        pending.append((a, b, *element))
        size += len(element[0])
        if size >= ELEMENTS:
            yield flush()
            pending, size = [], 0
    if pending:
        yield flush()


def sign(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(id, h1, h2, weight, bands, signature) of each row with an id and a text; signature has 16 bits for each component."""
    rows = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("_text"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("weight", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType(), False)), T.StructField("signature", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sig, total, name in _signed(batch.column(1)):
                keys = np.zeros((b - a, BANDS), np.uint64)
                for r in range(ROWS):
                    keys = mix(keys * _STEP + sig[:, r::ROWS])
                keys = mix(keys + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                short = (sig & np.uint64(0xFFFF)).astype(np.uint16).tobytes()
                cells = [short[i : i + 2 * M] for i in range(0, len(short), 2 * M)]
                half = name.view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(half[:, 0].copy()), pa.array(half[:, 1].copy()), pa.array(total), bands.cast(arrow.field(4).type), pa.array(cells, pa.binary())], schema=arrow)

    return rows.mapInArrow(run, schema)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets given as sorted elements and counts."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    either = int(a[1].sum() + b[1].sum()) - least
    return least / either if either else 1.0


def _bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for a, b, words, owner in hashed_words(texts):
        grams, rows_of, counts = bag(*shingles(words, owner, b - a, SHINGLE), b - a)
        at = np.searchsorted(rows_of, np.arange(b - a + 1))
        out += [(grams[x:y], counts[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]
    return out


def verify(pairs: DataFrame, docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of ids whose texts' multisets overlap enough, with their similarity."""
    both = _with_both(pairs, docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_held")))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("similarity", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found = np.array([overlap(x, y) for x, y in zip(_bags(part.column(2)), _bags(part.column(3)), strict=True)])
                good = np.flatnonzero(found >= similarity)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(good)), part.column(1).take(pa.array(good)), pa.array(found[good])], names=["a", "b", "similarity"])

    return both.mapInArrow(run, schema)


def _meet(members: DataFrame, known: DataFrame, on: str = "bucket") -> DataFrame:
    """Members joined with a row for their bucket that has its number of members n.

    Buckets with more than 1 / HOT of all members number at most HOT; these are broadcast, so no task gets a whole hot bucket."""
    rows, total = known.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = F.col("n") > F.lit(total / HOT if rows > HOT else 0)
    named = known.withColumnRenamed(on, "_bucket")
    same = F.col(on) == F.col("_bucket")
    few = F.broadcast(named.where(hot))
    met = members.join(few, same)
    if rows > HOT:
        met = met.union(members.join(few.select("_bucket"), same, "left_anti").join(named.where(~hot), same))
    return met.drop("_bucket")


def _with_both(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """(a, b, _a, _b) of pairs (a, b) that `cut` has written: what `held` (_id, _held) has of both."""
    centres = cut(pairs.groupBy("a").agg(F.count("*").alias("n")))
    parts = F.ceil(F.col("n") / SHARE).cast("int")
    dealt = _meet(pairs, centres, "a").select("a", "b", F.pmod(F.xxhash64("b"), parts).cast("int").alias("_part"))
    centres = centres.select(F.col("a").alias("_centre"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("_of"))
    centres = centres.join(held, F.col("_centre") == F.col("_id")).select("_centre", "_of", F.col("_held").alias("_a"))
    one = dealt.join(held, F.col("b") == F.col("_id")).select("a", "b", "_part", F.col("_held").alias("_b"))
    return one.join(centres, (F.col("a") == F.col("_centre")) & (F.col("_part") == F.col("_of"))).select("a", "b", "_a", "_b")


def _unresolved(buckets: DataFrame, components: DataFrame) -> DataFrame:
    """(bucket, id, weight, comp, n, words) of the buckets whose members are in several components; n and words are sums over a bucket's members."""
    found = components.withColumnRenamed("component", "_c")
    member = cut(buckets.join(found, F.col("id") == F.col("node"), "left").select("bucket", "id", "weight", F.coalesce("_c", "id").alias("comp")))
    several = cut(member.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count("*").alias("n"), F.sum("weight").alias("words")).where("_lo < _hi").select("bucket", "n", "words"))
    out = cut(_meet(member, several))
    forget(member, several)
    return out


def _second(unresolved: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of each bucket's member with most links and the members of other components."""
    degree = links.select(F.explode(F.array("a", "b")).alias("_id")).groupBy("_id").agg(F.count("*").alias("_links"))
    known = unresolved.join(degree, F.col("id") == F.col("_id"), "left").select("bucket", "id", "weight", "comp", F.coalesce("_links", F.lit(0)).alias("links"))
    best = cut(known.groupBy("bucket").agg(F.max(F.struct("links", (-F.col("id")).alias("i"), "weight", "comp")).alias("_b"), F.count("*").alias("n")).select("bucket", "n", (-F.col("_b.i")).alias("centre"), F.col("_b.weight").alias("_w"), F.col("_b.comp").alias("_comp")))
    met = _meet(unresolved.drop("n"), best).where("comp <> _comp").where(_alike(F.col("weight"), F.col("_w")))
    return met.select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct()


def _alike(x: Column, y: Column) -> Column:
    """Whether multisets of these sizes can be similar enough."""
    return F.least(x, y) >= F.lit(SIMILARITY) * F.greatest(x, y)


def _blocks_of(unresolved: DataFrame, signed: DataFrame) -> DataFrame:
    """The members of unresolved buckets in blocks: a row for each meeting of its block with another or itself, in the task of both."""
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("words") / WORDS)).cast("int")
    member = unresolved.select("bucket", "id", "weight", "comp", blocks.alias("blocks"))
    dealt = member.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
    sigs = signed.select(F.col("id").alias("_id"), "bands", "signature").dropDuplicates(["_id"])
    return dealt.join(sigs, F.col("id") == F.col("_id")).select("bucket", "low", "high", "block", "id", "weight", "comp", "bands", "signature")


def _grouped(df: DataFrame) -> DataFrame:
    return df.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "id")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Successive rows with equal bucket, low and high, whatever batches they came in."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            mine = tuple(key[:, a])
            if held and mine != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = mine
    if held:
        yield pa.Table.from_batches(held)


def _candidates(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of different components and blocks low and high that can be similar, each in the first bucket that both are in."""
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    bucket = group.column("bucket")[0].as_py()
    block, weight, comp = (group.column(c).to_numpy() for c in ("block", "weight", "comp"))
    sig = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint16).reshape(-1, M)
    bands = np.concatenate([c.flatten().to_numpy() for c in group.column("bands").chunks]).reshape(-1, BANDS)
    place = (bands == bucket).argmax(axis=1)
    x, y = np.flatnonzero(block == low), np.flatnonzero(block == high)
    found = []
    for k in x:
        other = y[y > k] if low == high else y
        other = other[(comp[other] != comp[k]) & (np.minimum(weight[other], weight[k]) >= SIMILARITY * np.maximum(weight[other], weight[k]))]
        if len(other):
            other = other[(sig[other] == sig[k]).mean(axis=1) >= SIMILARITY - SLACK]
        if len(other):
            same = bands[other] == bands[k]
            other = other[same.argmax(axis=1) == place[k]]
        found.append((np.full(len(other), k), other))
    none = np.empty(0, np.int64)  # a meeting may have the members of one block only, or of the high one
    return np.concatenate([none, *(f[0] for f in found)]), np.concatenate([none, *(f[1] for f in found)])


def _residual(unresolved: DataFrame, signed: DataFrame, docs: DataFrame, text: str, key: str, similarity: float) -> DataFrame:
    """Verified links (a, b) between different components of unresolved buckets: the edges of a forest over each meeting of blocks.

    Members without a candidate leave first, by their signatures; the others meet again with their texts, and what is verified there is
    all that comes out, however many pairs were compared."""
    rows = _blocks_of(unresolved, signed)

    def busy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if group.num_rows > 1:
                x, y = _candidates(group)
                if len(x):
                    yield from group.take(pa.array(np.union1d(x, y))).combine_chunks().to_batches()

    asked = _grouped(rows).mapInArrow(busy, rows.schema)
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    met = _grouped(asked.join(texts, F.col("id") == F.col("_id")).drop("_id").dropDuplicates(["bucket", "low", "high", "id"]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            x, y = _candidates(group)
            if not len(x):
                continue
            bags = _bags(group.column("_text").combine_chunks())
            ids, top = group.column("id").to_numpy(), {}

            def root(c: int, top: dict[int, int] = top) -> int:
                while top.setdefault(c, c) != c:
                    c = top[c]
                return c

            comp, links = group.column("comp").to_pylist(), []
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                a, b = root(comp[i]), root(comp[j])
                if a != b and overlap(bags[i], bags[j]) >= similarity:
                    top[max(a, b)] = min(a, b)
                    links.append((int(ids[i]), int(ids[j])))
            if links:
                a, b = np.array(links, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def group_near(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, class_id, group_id, kept) for each row: class_id stands for the texts with equal shingles, group_id for the
    component of verified links; kept is true for the one document of each group with its id."""
    signed = cut(sign(docs, text, key))
    names = cut(signed.groupBy("h1", "h2").agg(F.min("id").alias("rep")))
    first = names.select(F.col("rep").alias("_rep"))
    reps = signed.join(first, F.col("id") == F.col("_rep"), "left_semi").dropDuplicates(["id"])
    members = reps.where("weight > 0").select("id", "weight", F.explode("bands").alias("bucket"))
    shared = cut(members.groupBy("bucket").agg(F.min(F.struct("id", "weight")).alias("_c"), F.count("*").alias("n")).where("n > 1").select("bucket", "n", F.col("_c.id").alias("centre"), F.col("_c.weight").alias("_w")))
    buckets = cut(_meet(members, shared).select("bucket", "id", "weight", "centre", "_w"))
    pairs = buckets.where("id <> centre").where(_alike(F.col("weight"), F.col("_w"))).select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = cut(verify(cut(_estimated(pairs, signed)), docs, text, key))
    found = components_of_edges(links, "a", "b")
    first_left = _unresolved(buckets, found)
    more = cut(verify(cut(_estimated(_second(first_left, links), signed)), docs, text, key))
    found = extended(found, more, "a", "b")
    left = _unresolved(first_left.select("bucket", "id", "weight"), found)
    rest = cut(_residual(left, signed, docs, text, key, SIMILARITY))
    found = cut(extended(found, rest, "a", "b"))
    forget(shared, buckets, links, first_left, more, left, rest)
    grouped = names.join(found, F.col("rep") == F.col("node"), "left").select("h1", "h2", "rep", F.coalesce("component", "rep").alias("_g"))
    each = signed.select("id", F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).distinct()
    classes = each.join(grouped, (F.col("_h1") == F.col("h1")) & (F.col("_h2") == F.col("h2"))).groupBy("id").agg(F.min("rep").alias("_class"), F.min("_g").alias("_group"))
    rows = docs.select(docs[key].alias("_key")).join(classes, F.col("_key").cast("long") == F.col("id"), "left")
    own = F.col("_key").cast("long")
    return rows.select(F.col("_key").alias(key), F.coalesce("_class", own).alias("class_id"), F.coalesce("_group", own).alias("group_id"), (F.coalesce("_group", own).eqNullSafe(own)).alias("kept"))


def _estimated(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs whose signatures don't rule out the similarity."""
    both = _with_both(cut(pairs), signed.select(F.col("id").alias("_id"), F.col("signature").alias("_held")).dropDuplicates(["_id"]))
    schema = "a long, b long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, M) for k in (2, 3))
            good = pa.array((a == b).mean(axis=1) >= SIMILARITY - SLACK)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    return both.mapInArrow(run, schema)
