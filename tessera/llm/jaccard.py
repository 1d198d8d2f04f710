"""Operator 10: n-gram Jaccard join by vertical partitioning of the n-gram order."""

from __future__ import annotations

from bisect import bisect_right
from functools import cache, reduce
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.shared import components, discard, keyed, packed_texts, unpacked, written

#: Vertical fragments in which overlaps are counted.
FRAGMENTS = 4
#: Fragments beyond the pigeonhole's need and those that are empty by chance.
SPARE = 2
PARITY_WORDS = 8
CHUNK_BYTES = 4 << 20
#: Parts of the keys that are grouped one after another, so that only one part's shuffles take disk at a time.
PASSES = 4
_INFO = "doc_id bigint, rid bigint, node bigint, n bigint, parity array<bigint>, long array<bigint>"
_KEYS = [f"keys{p}" for p in range(PASSES)]


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of every text as sorted 64-bit hashes; A-Z in lower case."""
    words = w.split(w.lowered(texts))
    hashes = w.string_hashes(words.uniques)[words.codes]
    h = w.window_hashes(hashes, k)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(h[a : b - k + 1]))
        else:
            out.append(w.mix(w.window_hashes(hashes[a:b], b - a) + np.uint64(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def size_classes(most: int = 1 << 40) -> list[int]:
    """Lower bounds of the classes of set sizes; a class reaches to half as much again."""
    bounds = [1]
    while bounds[-1] < most:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return bounds


BOUNDS = size_classes()


@cache
def spare_fragments(k: int, percent: int, differ: int) -> int:
    """Fragments of size class k beyond the pigeonhole's need: about as many as the least set leaves empty, by chance."""
    empty = (differ + 1) * exp(-BOUNDS[k - 1] / (1.1 * (differ + 1)))
    return SPARE + ceil(empty + 3 * sqrt(empty))


def fragment_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which two sets that are similar enough share one at least.

    The n-gram order (by hash) is cut into m fragments, m more than the n-grams in which two sets of
    the size class may differ, so in m - differ fragments they agree; a key is the hash of a
    fragment's part.  A set also takes the fragments of the larger classes that its partners may
    belong to.  An empty part gives no key, for it would bring together sets with nothing in common.
    If every part in which two sets agree is empty, both have at least m - differ empty parts; such
    sets give their first n-grams in the order as well (as many as a similar set must meet in one).
    """
    n = len(s)
    own, last = bisect_right(BOUNDS, n), bisect_right(BOUNDS, n * 100 // percent)
    keys, sparse = [], False
    for k in range(own, last + 1):
        differ = (100 - percent) * 2 * (BOUNDS[k] - 1) // (100 + percent)
        if not differ:
            continue
        spare = spare_fragments(k, percent, differ)
        m = differ + 1 + spare
        part = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        first = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        sums = np.add.reduceat(w.mix(s + np.uint64(k)), first)
        keys.append(w.mix(sums ^ w.mix(part[first] + np.uint64(k << 40))))
        sparse |= m - len(first) > spare
    if sparse:
        keys.append(w.mix(s[: n - -(-n * percent // 100) + 1] + np.uint64(1)))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def parity(s: np.ndarray) -> np.ndarray:
    """Per hash bucket, whether it holds an odd number of n-grams: sets differ in at least as many n-grams as bits."""
    odd = np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def long_parity(s: np.ndarray) -> np.ndarray:
    """As :func:`parity`, with a bit per n-gram at least, so that it tells large sets apart too.

    The number of words is a power of two; of a pair, the longer vector is folded in half.
    """
    bits = 64 << max(3, (max(1, len(s)) - 1).bit_length() - 6)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _describe(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    def run(batches):
        for batch in w.chunks(batches, most=CHUNK_BYTES):
            sets = shingle_sets(w.texts_of(batch), shingle)
            size = np.array([len(s) for s in sets], np.int64)
            node = [int(w.mix(np.array([w.mix(s).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0]) for s in sets]
            keys = [fragment_keys(s, percent).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            bits = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * PARITY_WORDS, np.concatenate([parity(s) for s in sets]))
            long = [long_parity(s) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in long])]).astype(np.int32)
            flat, owner = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(x) for x in keys])
            parts = []
            for p in range(PASSES):
                mine = (flat & (PASSES - 1)) == p
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner[mine], minlength=len(keys)))]).astype(np.int32)
                parts.append(pa.ListArray.from_arrays(cuts, flat[mine]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(node, pa.int64()), pa.array(size), bits, pa.ListArray.from_arrays(ends, np.concatenate(long)), *parts], names=["doc_id", "rid", "node", "n", "parity", "long", *_KEYS])

    return rows.mapInArrow(w.releasing(run), ", ".join([_INFO, *(f"{k} array<bigint>" for k in _KEYS)]))


def _near(percent: int):
    """The pair (na, nb, pa, pb) may be similar enough, by sizes and parities; never false for one that is."""
    apart = (100 - percent) * (F.col("na") + F.col("nb"))
    bits = sum((F.bit_count(F.col("pa")[i].bitwiseXOR(F.col("pb")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    return (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (bits * (100 + percent) <= apart)


def _near_in_all_bits(percent: int):
    """As :func:`_near`, by the long parities la and lb."""
    short, far = "least(size(la), size(lb))", "greatest(size(la), size(lb))"
    bits = F.expr(f"CASE WHEN {far} > 2 * {short} THEN 0 ELSE aggregate(sequence(0, {short} - 1), 0, (t, i) -> t + bit_count(la[i] ^ lb[i] ^ IF(size(la) > {short}, la[i + {short}], 0L) ^ IF(size(lb) > {short}, lb[i + {short}], 0L))) END")
    return bits * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))


def _segments(rows: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, fragment, segment): the sets of the given nodes (node, rid), cut along the n-gram order."""

    def run(batches):
        for batch in w.chunks(batches, "size", CHUNK_BYTES):
            node, fragment, segment = [], [], []
            for x, s in zip(batch.column("node").to_pylist(), shingle_sets(unpacked(batch.column("packed"), batch.column("size")), shingle), strict=True):
                cuts = np.searchsorted(s, np.arange(1, FRAGMENTS, dtype=np.uint64) << np.uint64(62))
                for f, part in enumerate(np.split(s, cuts)):
                    node.append(x)
                    fragment.append(f)
                    segment.append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(fragment, pa.int32()), pa.array(segment, pa.binary())], names=["node", "fragment", "segment"])

    texts = packed_texts(rows).drop("doc_id").join(nodes, "rid").select("node", "packed", "size")
    return texts.mapInArrow(w.releasing(run), "node bigint, fragment int, segment binary")


def _links(rows: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough: partial overlaps by fragment, summed per pair."""
    side = classes.select("node", "n", "parity")
    near = written(pairs.join(side.toDF("a", "na", "pa"), "a").join(side.toDF("b", "nb", "pb"), "b").filter(_near(percent)).select("a", "b", "na", "nb"), "near")
    side = classes.select("node", "long")
    pairs = written(near.join(side.toDF("a", "la"), "a").join(side.toDF("b", "lb"), "b").filter(_near_in_all_bits(percent)).select("a", "b", "na", "nb"), "pairs")
    discard(near)
    wanted = pairs.select("a").union(pairs.select("b")).distinct().toDF("node").join(classes.select("node", "rid"), "node")
    segments = written(_segments(rows, wanted, shingle).dropDuplicates(["node", "fragment"]), "segments")

    def overlap(batches):
        for batch in w.chunks(batches, "sa"):
            got = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("a", "b", "na", "nb")), pa.array(got, pa.int64())], names=["a", "b", "na", "nb", "common"])

    cut = pairs.withColumn("fragment", F.explode(F.array(*map(F.lit, range(FRAGMENTS)))))
    cut = cut.join(segments.toDF("a", "fragment", "sa"), ["a", "fragment"]).join(segments.toDF("b", "fragment", "sb"), ["b", "fragment"])
    parts = cut.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(w.releasing(overlap), "a bigint, b bigint, na bigint, nb bigint, common bigint")
    total = parts.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    links = written(total.filter(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b"), "links")
    discard(pairs, segments)
    return links


def _meeting(sets: DataFrame) -> DataFrame:
    """(key, low, node): every node of every key that several nodes have, and the least of them."""
    parts = []
    for name in _KEYS:
        keys = sets.select(F.explode(name).alias("key"), "node")
        # Grouped values are written before they are joined back, so that adaptive execution can split a hot key.
        groups = written(keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key", "low"), "groups")
        parts.append(written(keys.join(groups, "key").select("key", "low", "node").distinct(), "live"))
        discard(groups)
    live = written(reduce(DataFrame.unionByName, parts), "live")
    discard(*parts)
    return live


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _prepared(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, every row's class and size, classes of equal sets, the keys on which several classes meet)."""
    rows = keyed(docs)
    sets = written(_describe(rows, shingle, percent), "sets")
    info = written(sets.select("doc_id", "rid", "node", "n"), "info")
    some = sets.filter("n > 0").drop(*_KEYS)
    head = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid"))
    classes = written(some.groupBy("node").agg(F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("long").alias("long"), head.alias("head"), F.count(F.lit(1)).alias("members")).select("node", "n", "parity", "long", "head", "members", F.col("head.rid").alias("rid")), "classes")
    live = _meeting(sets)
    discard(sets)
    return rows, info, classes, live


def similar_pairs(docs: DataFrame, *, shingle: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """The whole join: (pairs of classes, membership).

    Pairs: (a, b, doc_a, doc_b), every two classes of different sets that link, once, with the smallest
    ``doc_id`` of each.  Membership: (doc_id, rid, node, n_shingles, n_links), a row per row of ``docs``:
    its class, and how many other rows it links with, copies included.  So no link is lost and copies
    are not spelled out.  The pairs that meet on a key are compared under the bounds of
    :func:`similar_groups`; where many different texts are near copies of each other, the links
    themselves grow with the square of their number, which is what :func:`similar_groups` avoids.

    Nulls, empty texts, repeated rows and extra columns: as for :func:`similar_groups`; rows without
    words have no links.
    """
    rows, info, classes, live = _prepared(docs, shingle, percent)
    left = written(live.select("key", "node").join(classes.select("node", "n", "parity"), "node"), "meeting")
    a = left.select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    b = left.select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    links = _links(rows, classes, a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & _near(percent)).select("a", "b").distinct(), shingle, percent)
    discard(live, left)
    side = classes.select("node", F.col("head.doc_id").alias("doc"), "members")
    pairs = links.join(side.toDF("a", "doc_a", "_"), "a").join(side.toDF("b", "doc_b", "__"), "b").select("a", "b", "doc_a", "doc_b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(side.select(F.col("node").alias("b"), "members"), "b").groupBy("a").agg(F.sum("members").alias("others"))
    known = classes.select("node", "members").join(others.withColumnRenamed("a", "node"), "node", "left")
    members = info.join(known, "node", "left").select("doc_id", "rid", "node", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("members") - 1 + F.coalesce("others", F.lit(0))).otherwise(F.lit(0).cast("long")).alias("n_links"))
    return pairs, members


def similar_groups(docs: DataFrame, *, shingle: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, rid, n_shingles, component_id, leader) of every row of ``docs`` (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of distinct
    ``shingle``-word shingles; a component is what links reach, named by its smallest ``doc_id``.
    ``leader`` is the ``rid`` of one row of the smallest ``doc_id`` of the component.

    1. Documents of equal sets form a class; only classes are compared.
    2. Classes meet on :func:`fragment_keys`.  Of every group that meets, each class is paired with
       the least one and with the one that meets the most others, so pairs grow with the groups.
    3. Pairs that pass the bounds of sizes and parities (one bit per n-gram at the last) are verified: the sets are cut into vertical
       fragments along the n-gram order, overlaps are counted by fragment and summed per pair.
    4. Links give components.  Groups that still hold several components are compared in full, across
       components, under the same bounds, so no link is missed; what passes is verified likewise.

    Fewer words than ``shingle`` make one shingle.  Texts without words, and null ones, have none and
    link with nothing.  A row with a null ``doc_id`` takes part and names a component only if it has
    no other.  Repeated rows are of one class.  Very long texts are compared whole; an empty table gives
    no row; columns of any other name are not read.  Shingles are compared by 64-bit hashes.
    """
    rows, info, classes, live = _prepared(docs, shingle, percent)
    degree = live.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    central = written(live.join(degree, "node").groupBy("key").agg(F.max_by("node", F.struct("degree", "node")).alias("a")), "central")
    stars = live.select(F.col("low").alias("a"), F.col("node").alias("b")).unionByName(live.join(central, "key").select("a", F.col("node").alias("b")))
    links = _links(rows, classes, _ordered(stars), shingle, percent)
    first = components(links)

    placed = live.select("key", "node").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = written(placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key"), "keys")
    left = written(placed.join(open_, "key").join(classes.select("node", "n", "parity"), "node"), "open")
    a = left.select("key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    b = left.select("key", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    rest = a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _near(percent)).select("a", "b").distinct()
    late = _links(rows, classes, rest, shingle, percent)
    discard(live, central, open_, left)

    named = components(links.unionByName(late))
    whole = classes.select("node", "head").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = whole.groupBy("component").agg(F.min("head").alias("head"))
    labels = whole.select("node", "component").join(heads, "component").select("node", F.col("head.doc_id").alias("component_id"), F.col("head.rid").alias("leader"))
    return info.join(labels, "node", "left").select("doc_id", "rid", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.when(F.col("n") > 0, F.col("leader")).otherwise(F.col("rid")).alias("leader"))


def keep_leaders(docs: DataFrame, *, shingle: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one row of each component of :func:`similar_groups`, all columns as they are.

    Rows without words are in no group and all stay.
    """
    groups = similar_groups(docs, shingle=shingle, percent=percent)
    stay = groups.filter("n_shingles = 0 OR rid = leader").select("rid", (F.col("n_shingles") == 0).alias("every")).distinct()
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rid"), F.struct(*docs.columns).alias("row")).join(stay, "rid")
    # The join has dealt and sorted the rows by rid already.
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("rid").orderBy("every"))).filter("every OR nth = 1")
    return rows.select("row.*")
