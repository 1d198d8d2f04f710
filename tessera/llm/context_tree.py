"""Operator 13: language-model scores by context-tree weighting over the bits of bytes.

A text is its words, A-Z in lower case, joined by one space and ended by a newline.  Each byte is eight
binary decisions; a decision is a *node* (the bits so far, as 1 to 255), and its contexts are the 0 to
``depth`` bytes before, at most six, newlines before a text's start.  Whatever is counted has a 64-bit key: a
byte behind its longest context, or a word (its hash, negative).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.shared import discard, written

END = 10
#: Bytes of normal text in a chunk, and in what is looked at at once within it; a longer text stands alone.
CHUNK_BYTES, PIECE_BYTES = 48 << 20, 2 << 20
#: Keys of a chunk's pieces that wait before equal ones are summed, and keys that leave a task in one batch.
HELD_KEYS, SENT_KEYS = 1 << 20, 1 << 18
#: The tree is cut at contexts of so many bytes: at most 256 ** (depth + 1 - CUT) byte keys lie beyond one of them.
CUT = 3
#: Byte keys of the part of the tree that one call works on, about.
PART_KEYS = 100_000
_WORD = np.int64(-(1 << 63))
_CHUNK = "ids array<bigint>, held array<boolean>, size bigint, data binary"
_SCORE = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


# ---------------------------------------------------------------- texts in chunks


def chunked(docs: DataFrame, held: Column) -> DataFrame:
    """(chunk, ids, held, size, data): the normal texts of some documents, compressed; texts move no more than that."""

    def packed(ids, held, parts, size):
        data = pa.Codec("zstd", compression_level=9).compress(b"".join(parts), asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), pa.array([size], pa.int64()), pa.array([data], pa.binary())], names=["ids", "held", "size", "data"])

    def run(batches):
        ids, held, parts, size = [], [], [], 0
        for batch in w.chunks(batches):
            for i, h, text in zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), w.texts_of(batch).to_pylist(), strict=True):
                part = b" ".join(text.encode().lower().split()) + b"\n"  # of bytes: ASCII alone
                ids.append(i)
                held.append(h)
                parts.append(part)
                size += len(part)
                if size >= CHUNK_BYTES:
                    yield packed(ids, held, parts, size)
                    ids, held, parts, size = [], [], [], 0
        if ids:
            yield packed(ids, held, parts, size)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(w.releasing(run), _CHUNK).select(F.monotonically_increasing_id().alias("chunk"), "*"), "chunks")


def pieces(data: bytes, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, where each text ends in them) of a chunk, some whole texts at a time."""
    whole = np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), np.uint8)
    ends = np.flatnonzero(whole == END) + 1
    first, start = 0, 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, start + PIECE_BYTES, side="right")))
        yield whole[start : ends[last - 1]], ends[first:last] - start
        first, start = last, int(ends[last - 1])


def byte_keys(text: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """The key of every byte: itself behind the ``depth`` bytes before it, the nearest lowest."""
    padded = np.concatenate([np.full(7, END, np.uint8), text])
    keys = np.ndarray(len(text), ">i8", padded, strides=(1,)).astype(np.int64) & ((1 << 8 * (depth + 1)) - 1)
    starts = np.concatenate([[0], ends[:-1]])
    for j in range(depth):  # a text's first bytes see newlines instead of another text
        at = starts[starts + j < ends] + j
        keys[at] = keys[at] & ((1 << 8 * (j + 1)) - 1) | sum(END << 8 * k for k in range(j + 1, depth + 1))
    return keys


def word_keys(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the key of every word, where each text's words begin and the last one's end)."""
    stops = np.flatnonzero((text == 32) | (text == END))
    starts = np.concatenate([[0], stops[:-1] + 1])
    empty = stops == starts  # of a text without words
    starts, stops = starts[~empty], stops[~empty]
    hashes = w.span_hashes(text, starts, stops)
    return hashes.view(np.int64) | _WORD, np.concatenate([[0], np.searchsorted(stops, ends)])


#: No word has no byte.
END_KEY = int(w.span_hashes(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(1, np.int64)).view(np.int64)[0] | _WORD)


def counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys, how often each is marked in ``train``)."""
    marked = np.sort(keys[train])
    first = np.flatnonzero(np.concatenate([[True], marked[1:] != marked[:-1]])) if len(marked) else np.zeros(0, np.int64)
    other = np.sort(keys[~train])
    other = other[np.concatenate([[True], other[1:] != other[:-1]])] if len(other) else other
    return np.concatenate([marked[first], other]), np.concatenate([np.diff(np.append(first, len(marked))), np.zeros(len(other), np.int64)])


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys in order, the sum of each)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order], first)


def key_counts(chunks: DataFrame, depth: int) -> DataFrame:
    """(chunk, key, n): every key that a chunk holds, and how often in texts to learn from."""

    def of_chunk(data, size, held):
        found, first, waiting = [], 0, 0
        for text, ends in pieces(data, size):
            train = ~np.array(held[first : first + len(ends)], bool)
            first += len(ends)
            found.append(counted(byte_keys(text, ends, depth), np.repeat(train, np.diff(ends, prepend=0))))
            words, offsets = word_keys(text, ends)
            found.append(counted(words, np.repeat(train, np.diff(offsets))))
            found.append((np.array([END_KEY]), np.array([train.sum()])))
            waiting += sum(len(keys) for keys, _ in found[-3:])
            if waiting >= max(HELD_KEYS, len(found[0][0])):  # so that a chunk's sums stay in proportion to its keys
                found, waiting = [summed(*(np.concatenate(x) for x in zip(*found, strict=True)))], 0
        return summed(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, held, size, data = (batch.column(x)[row].as_py() for x in ("chunk", "held", "size", "data"))
                keys, counts = of_chunk(data, size, held)
                for at in range(0, len(keys), SENT_KEYS):
                    k, n = keys[at : at + SENT_KEYS], counts[at : at + SENT_KEYS]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), chunk)), pa.array(k), pa.array(n)], names=["chunk", "key", "n"])

    return written(chunks.mapInArrow(w.releasing(run), "chunk bigint, key bigint, n bigint"), "keys", codec="zstd")


# ---------------------------------------------------------------- the tree


def _log_gamma(x, log):
    """Of a column or an array, by Stirling's series eight places on, where its error is below 1e-11."""
    z, near = x + 8, x
    for k in range(1, 8):
        near = near * (x + k)
    return (z - 0.5) * log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - log(near)


def _evidence(a, b, log=np.log):
    """Natural log of the Krichevsky-Trofimov probability of ``a`` zeros and ``b`` ones."""
    return _log_gamma(a + 0.5, log) + _log_gamma(b + 0.5, log) - math.log(math.pi) - _log_gamma(a + b + 1, log)


@dataclass
class Level:
    """Nodes (low 8 bits) behind contexts of one length: zeros and ones seen there, the share ``stop`` of the node's
    own estimate and the weighted log-probability; ``up`` is each node's place in the next shorter level."""

    place: np.ndarray
    a: np.ndarray
    b: np.ndarray
    stop: np.ndarray
    weighted: np.ndarray
    up: np.ndarray | None = None


def _summed(place: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None) -> tuple[Level, np.ndarray]:
    """(the level of the sums by place, which of its nodes each entry went to); no ``below``: the longest contexts."""
    place, to = np.unique(place, return_inverse=True)
    a, b = (np.bincount(to, weights=x, minlength=len(place)) for x in (a, b))
    own = _evidence(a, b)
    if below is None:
        return Level(place, a, b, np.ones(len(place)), own), to
    below = np.bincount(to, weights=below, minlength=len(place))
    return Level(place, a, b, 1 / (1 + np.exp(np.clip(below - own, -700, 700))), np.logaddexp(own, below) - math.log(2)), to


def levels_above(key: np.ndarray, n: np.ndarray, depth: int, cut: int) -> tuple[list[Level], np.ndarray]:
    """(levels from the longest contexts to those of ``cut`` bytes, the longest level's node of each decision of each key)."""
    byte = key & 255
    place = np.concatenate([key - byte + ((1 << j) | byte >> 8 - j) for j in range(8)])
    one = np.concatenate([byte >> 7 - j & 1 for j in range(8)])
    counts = np.tile(n, 8)
    level, where = _summed(place, counts * (1 - one), counts * one, None)
    levels = [level]
    for d in range(depth - 1, cut - 1, -1):
        level, levels[-1].up = _summed(levels[-1].place & ((1 << 8 * (d + 1)) - 1), levels[-1].a, levels[-1].b, levels[-1].weighted)
        levels.append(level)
    return levels, where


def key_logs(key: np.ndarray, n: np.ndarray, depth: int, cut: int, left: np.ndarray, total: np.ndarray, p: np.ndarray) -> np.ndarray:
    """log10 of the probability of each key's byte, given what the paths have at the nodes of ``cut``, in order."""
    levels, where = levels_above(key, n, depth, cut)
    for level in reversed(levels[:-1]):
        left, total, p = left[level.up], total[level.up], p[level.up]
        seen, ones = level.a + level.b > 0, (level.b + 0.5) / (level.a + level.b + 1)
        p = np.where(seen, total + left * ones, p)
        left, total = np.where(seen, left * (1 - level.stop), left), np.where(seen, total + left * level.stop * ones, total)
    one, byte = p[where].reshape(8, -1), key & 255
    return sum(np.where(byte >> 7 - j & 1, np.log10(one[j]), np.log1p(-one[j]) / math.log(10)) for j in range(8))


def byte_logs(counts: DataFrame, depth: int) -> DataFrame:
    """(key, v): log10 of the probability of each key's byte behind its contexts.

    ``counts`` (key, n) has every byte key that is to be scored, also with n = 0.  From the longest contexts
    up, a context's probability of what was seen there is half its own Krichevsky-Trofimov estimate and half
    the product over its longer contexts, so the share ``stop`` of the estimate follows.  Back down, the
    estimates along a path are mixed by these shares.  Where a longer context was not seen in training, its
    part goes to the estimate of the shorter one.

    Keys are dealt by the last ``CUT`` bytes of their context; beyond these, paths up and down lie in one
    part each.  The shorter contexts, whose number is bounded, are grouped sums and joins over all parts.
    """
    cut = min(CUT, depth)
    parts = F.lit(max(1, -(-counts.count() // PART_KEYS)))
    part = lambda context: F.pmod(F.xxhash64(context), parts).alias("part")
    dealt = counts.select("key", "n", part(F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * cut) - 1))))

    def upper(rows: pa.Table) -> pa.Table:
        level = levels_above(rows.column("key").to_numpy(), rows.column("n").to_numpy(), depth, cut)[0][-1]
        return pa.table({"place": level.place, "a": level.a, "b": level.b, "stop": level.stop, "weighted": level.weighted})

    levels = [written(dealt.groupBy("part").applyInArrow(w.released(upper), "place bigint, a double, b double, stop double, weighted double"), f"level-{cut}")]
    own, below = F.col("own"), F.col("below")
    for d in range(cut - 1, -1, -1):
        shorter = F.col("place").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("place")
        level = levels[-1].groupBy(shorter).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("weighted").alias("below")).withColumn("own", _evidence(F.col("a"), F.col("b"), F.log))
        weighted = F.greatest(own, below) + F.log1p(F.exp(-F.abs(own - below))) - math.log(2)
        levels.append(written(level.select("place", "a", "b", (1 / (1 + F.exp(below - own))).alias("stop"), weighted.alias("weighted")), f"level-{d}"))
    seen, ones = F.col("a") + F.col("b") > 0, (F.col("b") + 0.5) / (F.col("a") + F.col("b") + 1)
    paths = None
    for d, level in enumerate(reversed(levels)):
        if paths is None:
            rows = level.withColumns({"left0": F.lit(1.0), "sum0": F.lit(0.0), "p0": F.lit(0.5)})
        else:
            before = paths.select(F.col("place").alias("up"), F.col("left").alias("left0"), F.col("sum").alias("sum0"), F.col("p").alias("p0"))
            rows = level.withColumn("up", F.col("place").bitwiseAND(F.lit((1 << 8 * d) - 1))).join(before, "up")
        taken = F.col("sum0") + F.col("left0") * F.col("stop") * ones
        last, paths = paths, written(rows.select("place", F.when(seen, F.col("left0") * (1 - F.col("stop"))).otherwise(F.col("left0")).alias("left"), F.when(seen, taken).otherwise(F.col("sum0")).alias("sum"), F.when(seen, F.col("sum0") + F.col("left0") * ones).otherwise(F.col("p0")).alias("p")), f"paths-{d}")
        discard(*([last] if last else []))
    discard(*levels)

    def logs(rows: pa.Table, paths: pa.Table) -> pa.Table:
        key, order = rows.column("key").to_numpy(), np.argsort(paths.column("place").to_numpy())
        left, total, p = (paths.column(c).to_numpy()[order] for c in ("left", "sum", "p"))
        return pa.table({"key": key, "v": key_logs(key, rows.column("n").to_numpy(), depth, cut, left, total, p)})

    known = paths.select("place", "left", "sum", "p", part(F.shiftright("place", 8)))
    values = written(dealt.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(w.released(logs), "key bigint, v double"), "logs")
    discard(paths)
    return values


# ---------------------------------------------------------------- scores


def score_texts(docs: DataFrame, held: Column, *, depth: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The tree learns from the rows for which ``held`` is false and scores all of them; ``score`` is log10 of
    the probability of the whole normal text with its end, -score * log2(10) / bytes its code length in
    bits per byte.  ``base_score`` is that of a unigram model over words and the end, with half a count added.

    Texts lie in chunks in the shared folder.  A chunk gives its different keys; their counts and
    probabilities are found by grouping and joining keys, and what belongs to a chunk comes back to it.
    Nothing of the model reaches the driver but the number of tokens and of different ones.

    Null and empty texts are the end alone; a null doc_id is passed through; repeated rows each count and
    each get a row; a null ``held`` counts as false; very long texts are scored whole; with nothing to learn
    from every bit has probability one half; an empty table gives no row.  Other columns are not read.
    Words are told apart by 63-bit hashes.
    """
    chunks = chunked(docs, F.coalesce(held, F.lit(False)))
    keys = key_counts(chunks, depth)
    counts = written(keys.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    words, grams = counts.filter("key < 0"), counts.filter("key >= 0")
    tokens, different = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    logs = byte_logs(grams, depth)
    values = logs.unionByName(words.select("key", F.col("n").cast("double").alias("v")))
    met = keys.select("chunk", "key").join(values, "key")

    def score(values: pa.Table, chunk: pa.Table) -> pa.Table:
        order = np.argsort(values.column("key").to_numpy())
        known, v = values.column("key").to_numpy()[order], values.column("v").to_numpy()[order]
        out = []
        for row in range(chunk.num_rows):
            ids, held, size, data = (chunk.column(x)[row].as_py() for x in ("ids", "held", "size", "data"))
            n_tokens, n_known, base, scores = [], [], [], []
            for text, ends in pieces(data, size):
                codes, seen = pd.factorize(byte_keys(text, ends, depth))
                scores.append(np.add.reduceat(v[np.searchsorted(known, seen)][codes], np.concatenate([[0], ends[:-1]])))
                words, offsets = word_keys(text, ends)
                codes, seen = pd.factorize(words)
                c = v[np.searchsorted(known, np.concatenate([seen, [END_KEY]]))]
                logs = np.log10((c + 0.5) / (tokens + 0.5 * (different + 1)))
                n_tokens.append(np.diff(offsets) + 1)
                n_known.append(w.sums((c[:-1] > 0)[codes], offsets) + int(c[-1] > 0))
                base.append(w.sums(logs[:-1][codes], offsets) + logs[-1])
            columns = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), *(pa.array(np.concatenate(x).astype(np.int64)) for x in (n_tokens, n_known)), pa.array(np.full(len(ids), tokens)), pa.array(np.concatenate(base)), pa.array(np.concatenate(scores))]
            out.append(pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)

    scored = written(met.groupBy("chunk").cogroup(chunks.groupBy("chunk")).applyInArrow(w.released(score), _SCORE), "scores")
    discard(chunks, keys, counts, logs)
    return scored
