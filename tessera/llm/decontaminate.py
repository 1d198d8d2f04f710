"""Operator 5: benchmark decontamination by spaced-seed hashing."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.shared import written

#: 1: the token counts, 0: it may differ.
MASKS = ("1101101", "1110011", "1011101", "11001011")
SHORTEST = min(map(len, MASKS))
#: Words of benchmark items that are broadcast at once, about; a larger benchmark takes several passes.
BLOCK_WORDS = 400_000
OVERLAP = "array<struct<item_id:bigint,doc_start:int,item_start:int,length:int,matches:int>>"
_OVERLAP = pa.list_(pa.struct([("item_id", pa.int64()), ("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32()), ("matches", pa.int32())]))


def normal_words(texts: pa.Array) -> w.Words:
    """Words in lower case without anything but letters and digits; words of neither go."""
    words = w.split(texts)
    plain = pc.replace_substring_regex(pc.utf8_lower(words.uniques), r"[^\p{L}\p{N}]+", "").dictionary_encode()
    words = w.Words(words.offsets, plain.indices.to_numpy(zero_copy_only=False)[words.codes] if len(words.codes) else words.codes, plain.dictionary)
    return words.keep(pc.binary_length(words.uniques).to_numpy(zero_copy_only=False) > 0)


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the tokens that the mask keeps, for every start."""
    n = max(0, len(hashes) - len(mask) + 1)
    h = np.full(n, len(mask) * 64 + mask.count("1"), np.uint64)
    for j, keep in enumerate(mask):
        if keep == "1":
            h = (h ^ hashes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


@dataclass
class Seeds:
    """Where a mask's seeds lie in the items: for each different hash its groups, one for an item, of places."""

    mask: str
    hashes: np.ndarray
    groups: np.ndarray
    items: np.ndarray
    places: np.ndarray
    at: np.ndarray


@dataclass
class Block:
    """A part of the benchmark: its words, and its seeds by mask."""

    items: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    seeds: list[Seeds]


def build_block(ids: list[int], texts: list[str]) -> Block:
    words = normal_words(pa.array(texts, pa.string()))
    hashes, seeds = w.string_hashes(words.uniques)[words.codes], []
    short = sorted({int(n) for n in words.counts if 0 < n < SHORTEST})
    for mask in (*MASKS, *("1" * n for n in short)):
        starts = w.window_starts(words.offsets, len(mask))
        if len(mask) < SHORTEST:  # a short item is looked for as a whole
            starts = words.offsets[:-1][words.counts == len(mask)]
        h = seed_hashes(hashes, mask)[starts]
        order = np.argsort(h, kind="stable")  # by hash, then place, and so by item
        h, at = h[order], starts[order]
        item = np.searchsorted(words.offsets, at, side="right") - 1
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        first = np.flatnonzero(new | np.concatenate([[True], item[1:] != item[:-1]])) if len(h) else np.zeros(0, np.int64)
        seeds.append(Seeds(mask, h[new], np.append(np.flatnonzero(new[first]), len(first)), item[first], np.append(first, len(h)), at))
    return Block(np.array(ids, np.int64), words.offsets, hashes, seeds)


def blocks(benchmark: DataFrame):
    """The benchmark in blocks of bounded size; null items are skipped."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").dropna().distinct().orderBy("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"]) // 4
        if size >= BLOCK_WORDS:
            yield build_block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield build_block(ids, texts)


def segments(match: np.ndarray, least: int, share: Fraction) -> list[tuple[int, int]]:
    """Disjoint segments of at least ``least`` tokens of which at least ``share`` are equal, none left out.

    The one with most equal tokens above that share comes first (the shortest, then first of equals), then
    the best on either side of it, and so on.
    """
    total = np.concatenate([[0], np.cumsum(np.where(match, share.denominator - share.numerator, -share.numerator))])
    found, open_ = [], [(0, len(match))]
    while open_:
        first, last = open_.pop()
        if last - first < least:
            continue
        sums = total[first : last + 1]
        low = np.minimum.accumulate(sums[: len(sums) - least])
        end = int(np.argmax(sums[least:] - low))
        if sums[least + end] < low[end]:
            continue
        start = first + int(np.flatnonzero(sums[: end + 1] == low[end])[-1])
        end += first + least
        found.append((start, end))
        open_ += [(first, start), (end, last)]
    return sorted(found)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, nth) of rows repeated ``counts`` times."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def diagonals(hashes: np.ndarray, words: w.Words, block: Block) -> np.ndarray:
    """(text, item, shift), different and in order: the diagonals on which a text and an item share a seed.

    What texts and items share is counted first.  A pair with more shared seeds than diagonals, as
    repetitive texts make, takes all of them; the seeds of the others are placed one by one, so the
    work on a pair is bounded by its two lengths.
    """
    counts = np.diff(block.offsets)
    shared, pairs, times = [], [], []
    for seeds in block.seeds:
        starts = w.window_starts(words.offsets, len(seeds.mask))
        h = seed_hashes(hashes, seeds.mask)[starts]
        if not len(seeds.hashes) or not len(h):
            continue
        kind = np.minimum(np.searchsorted(seeds.hashes, h), len(seeds.hashes) - 1)
        hit = np.flatnonzero(seeds.hashes[kind] == h)
        at, kind = starts[hit], kind[hit]
        text = np.searchsorted(words.offsets, at, side="right") - 1
        order = np.lexsort((at, kind, text))
        at, kind, text = at[order], kind[order], text[order]
        first = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (text[1:] != text[:-1])])) if len(at) else np.zeros(0, np.int64)
        n = np.diff(np.append(first, len(at)))
        which, nth = _spread(np.diff(seeds.groups)[kind[first]])
        group = seeds.groups[kind[first]][which] + nth
        pair = text[first][which] * len(counts) + seeds.items[group]
        shared.append((seeds, at, first[which], n[which], group, pair))
        pairs.append(pair)
        times.append(n[which] * (seeds.places[group + 1] - seeds.places[group]))
    if not pairs:
        return np.zeros((0, 3), np.int64)
    every, back = np.unique(np.concatenate(pairs), return_inverse=True)
    text, item = np.divmod(every, len(counts))
    dense = np.bincount(back, weights=np.concatenate(times), minlength=len(every)) > words.counts[text] + counts[item]
    which, nth = _spread(words.counts[text[dense]] + counts[item[dense]] - 1)
    found = [np.stack([text[dense][which], item[dense][which], nth - counts[item[dense]][which] + 1], axis=1)]
    for seeds, at, first, n, group, pair in shared:
        keep = ~dense[np.searchsorted(every, pair)]
        first, n, group, pair = first[keep], n[keep], group[keep], pair[keep]
        m = seeds.places[group + 1] - seeds.places[group]
        which, nth = _spread(n * m)
        t, i = np.divmod(pair[which], len(counts))
        in_text, in_item = at[first[which] + nth // m[which]], seeds.at[seeds.places[group[which]] + nth % m[which]]
        found.append(np.unique(np.stack([t, i, in_text - words.offsets[t] - (in_item - block.offsets[i])], axis=1), axis=0))
    return np.unique(np.concatenate(found), axis=0)


def overlaps_of(words: w.Words, block: Block, least_words: int, identity: float) -> list[list[dict]]:
    """Verified overlaps of every text with the block's items, in the order of OVERLAP's fields."""
    hashes = w.string_hashes(words.uniques)[words.codes]
    share = Fraction(identity).limit_denominator(1000)
    out: list[list[dict]] = [[] for _ in range(len(words.offsets) - 1)]
    for d, i, shift in diagonals(hashes, words, block).tolist():
        base, size = int(words.offsets[d]), int(words.counts[d])
        at, length = int(block.offsets[i]), int(block.offsets[i + 1] - block.offsets[i])
        first, last = max(0, -shift), min(length, size - shift)
        match = hashes[base + shift + first : base + shift + last] == block.hashes[at + first : at + last]
        for start, end in segments(match, min(least_words, length), share if length >= SHORTEST else Fraction(1)):
            out[d].append({"item_id": int(block.items[i]), "doc_start": shift + first + start, "item_start": first + start, "length": end - start, "matches": int(match[start:end].sum())})
    for found in out:
        found.sort(key=lambda x: tuple(x.values()))
    return out


def _scan(docs: DataFrame, block: Block, least_words: int, identity: float, give) -> DataFrame:
    """One pass over the texts against a block; ``give`` makes a batch of a batch and its overlaps."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in w.chunks(batches):
            yield give(batch, overlaps_of(normal_words(w.texts_of(batch)), shared.value, least_words, identity))

    return docs.mapInArrow(w.releasing(run), docs.schema)


def _listed(batch: pa.RecordBatch, found: list[list[dict]]) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index("overlaps"), "overlaps", pa.array(found, _OVERLAP))


def _clean(batch: pa.RecordBatch, found: list[list[dict]]) -> pa.RecordBatch:
    return batch.filter(pa.array([not x for x in found], pa.bool_()))


def _all_blocks(docs: DataFrame, first: list[Block], rest, least_words: int, identity: float) -> DataFrame:
    """(rid, overlaps) of the texts that overlap, over several blocks, a pass each, one block in memory at a time."""
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rid"), "text", F.expr(f"cast(array() AS {OVERLAP})").alias("overlaps"))
    parts = [written(_scan(rows, block, least_words, identity, _listed).filter("size(overlaps) > 0").select("rid", "overlaps").dropDuplicates(["rid"]), "overlaps") for block in chain(first, rest)]
    return written(reduce(DataFrame.unionByName, parts).groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list("overlaps"))).alias("overlaps")), "overlaps")


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, least_words: int = 12, identity: float = 0.75) -> DataFrame:
    """One row per document: doc_id and ``overlaps`` with benchmark items (item_id, text).

    Words are compared in lower case without punctuation.  Fixed masks that ignore some tokens are
    hashed over the items and over every text; a shared hash is a hit, and the whole diagonal of both
    word sequences on which it lies is compared token by token.  Overlaps are its segments of at least
    ``least_words`` words, or the whole item if that is shorter, of which at least ``identity`` are equal:
    the best one, and the best of what lies on either side of it, until none is left.  Positions count
    such words; overlaps are sorted by item and place.

    A benchmark of up to about ``BLOCK_WORDS`` words is broadcast and documents never move; a larger one
    takes a pass over the texts for each such block, one block in memory at a time.

    Null and empty texts and items overlap with nothing; items of fewer words than a mask must occur
    whole and unchanged; equal items are reported under each id; repeated rows each get a row; very
    long and repetitive texts are compared whole, a pair at most on each of its diagonals once; an empty
    table gives no row, an empty benchmark no overlap; other columns are not read.
    """
    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text", f"cast(array() AS {OVERLAP}) AS overlaps")
    rest = blocks(benchmark)
    first = list(islice(rest, 2))
    if len(first) < 2:
        return (_scan(rows, first[0], least_words, identity, _listed) if first else rows).drop("text")
    found = _all_blocks(docs, first, rest, least_words, identity)
    keys = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"))
    return keys.join(found, "rid", "left").select("doc_id", F.coalesce("overlaps", F.expr(f"cast(array() AS {OVERLAP})")).alias("overlaps"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, least_words: int = 12, identity: float = 0.75) -> DataFrame:
    """The rows of ``docs`` without an overlap, as :func:`find_overlaps` defines it, all columns kept."""
    rest = blocks(benchmark)
    first = list(islice(rest, 2))
    if len(first) < 2:
        return _scan(docs, first[0], least_words, identity, _clean) if first else docs
    found = _all_blocks(docs, first, rest, least_words, identity).select("rid")
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rid"), F.struct(*docs.columns).alias("row"))
    return rows.join(found, "rid", "left_anti").select("row.*")
