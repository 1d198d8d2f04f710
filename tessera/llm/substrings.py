"""Operator 4: exact substring dedup by level-wise doubling of repeated windows."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.shared import discard, keyed, packed_texts, unpacked, written

#: No level starts below this many words: short windows repeat everywhere.
LEAST_LEVEL = 12


def level_lengths(window: int) -> list[int]:
    """Lengths of the levels, each at most twice the one before, the last being ``window``; two at least."""
    lengths = [max(1, -(-window // 2)), window]
    while -(-lengths[0] // 2) >= LEAST_LEVEL:
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


def _slide(values: np.ndarray, size: int, op) -> np.ndarray:
    """op over every ``size`` consecutive values, in log2(size) steps."""
    done, out = 1, values
    while 2 * done <= size:
        out, done = op(out[:-done], out[done:]), 2 * done
    return op(out[: len(out) - (size - done)], out[size - done :]) if size > done else out


def anchors(hashes: np.ndarray, offsets: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the windows of ``length`` words that are least in some window of ``reach``.

    Equal windows of ``reach`` words hold equal anchors, so no repeat of that length is missed, while
    only about 2 / (reach - length + 2) of all positions are kept.
    """
    starts = w.window_starts(offsets, reach)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    h = w.window_hashes(hashes, length)
    span = reach - length + 1
    least = np.zeros(len(h), np.uint64)
    least[starts] = _slide(h, span, np.minimum)[starts]
    top = _slide(np.concatenate([np.zeros(span - 1, np.uint64), least]), span, np.maximum)
    at = np.flatnonzero(top == h)
    at = at[h[at] > 0]
    return at, h[at]


def _digest(words: w.Words, listed: list[str], i: int, drop: np.ndarray | None = None) -> str:
    codes = words.codes[words.offsets[i] : words.offsets[i + 1]]
    if drop is not None:
        codes = codes[~drop]
    return hashlib.sha256(" ".join([listed[k] for k in codes.tolist()]).encode()).hexdigest()


def _first_level(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Per row its words, digest and whole-sequence hash, and its anchors: hashes, positions and longer windows.

    ``longer`` has, for every anchor and every level between the first and the last, the hash of the
    window that starts with the anchor and of the one that ends with it (0 where the text is too
    short): whatever window of the last level holds the anchor holds one of the two.
    """
    between = lengths[1:-1]

    def run(batches):
        for batch in w.chunks(batches):
            words = w.split(w.texts_of(batch))
            listed = words.uniques.to_pylist()
            hashes = w.string_hashes(words.uniques)[words.codes]
            at, h = anchors(hashes, words.offsets, lengths[0], lengths[-1])
            of = np.searchsorted(words.offsets, at, side="right") - 1
            cuts = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            size = words.counts
            whole = w.sums(w.mix(hashes + w.mix((np.arange(len(hashes)) - np.repeat(words.offsets[:-1], size)).astype(np.uint64))).view(np.int64), words.offsets)
            longer = np.zeros((len(at), 2 * len(between)), np.uint64)
            for k, length in enumerate(between):
                windows = w.window_hashes(hashes, length)
                for side, start in enumerate((at, at + lengths[0] - length)):
                    fits = np.flatnonzero((start >= words.offsets[of]) & (start + length <= words.offsets[of + 1]))
                    longer[fits, 2 * k + side] = windows[start[fits]]
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (h.view(np.int64), (at - words.offsets[of]).astype(np.int32))]
            lists.append(pa.ListArray.from_arrays(cuts, pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * longer.shape[1], pa.array(longer.ravel().view(np.int64)))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(size), pa.array([_digest(words, listed, i) for i in range(batch.num_rows)]), pa.array(whole), *lists], names=["doc_id", "rid", "n_words", "sha", "whole", "hashes", "positions", "longer"])

    return rows.mapInArrow(w.releasing(run), "doc_id bigint, rid bigint, n_words bigint, sha string, whole bigint, hashes array<bigint>, positions array<int>, longer array<array<bigint>>")


def _last_level(parts: DataFrame, length: int, window: int) -> DataFrame:
    """(h, doc_id, rid, position) of all windows of ``window`` words around given ones of ``length``."""

    def run(batches):
        for batch in w.chunks(batches, "size"):
            words = w.split(unpacked(batch.column("packed"), batch.column("size")))
            hashes = w.window_hashes(w.string_hashes(words.uniques)[words.codes], window)
            given = batch.column("positions")
            n = pc.list_value_length(given).to_numpy(zero_copy_only=False)
            flat = given.flatten().to_numpy().astype(np.int64) + np.repeat(words.offsets[:-1], n)
            marked = np.zeros(len(words.codes) + window, np.int64)
            np.add.at(marked, np.maximum(flat - (window - length), np.repeat(words.offsets[:-1], n)), 1)
            np.add.at(marked, flat + 1, -1)
            starts = w.window_starts(words.offsets, window)
            starts = starts[(np.cumsum(marked) > 0)[starts]]
            of = np.searchsorted(words.offsets, starts, side="right") - 1
            key, rid = batch.column("doc_id").to_numpy(), batch.column("rid").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(hashes[starts].view(np.int64)), pa.array(key[of]), pa.array(rid[of]), pa.array((starts - words.offsets[of]).astype(np.int32))], names=["h", "doc_id", "rid", "position"])

    return parts.select("doc_id", "rid", "packed", "size", "positions").mapInArrow(w.releasing(run), "h bigint, doc_id bigint, rid bigint, position int")


def _repeated(level: DataFrame) -> DataFrame:
    """The rows of a level whose window is in two documents at least.

    The grouped hashes are written before they are joined back: then both sides of the join are
    plain shuffles, and adaptive execution splits a passage that very many documents share.
    """
    shared = written(level.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("h", "low"), "shared")
    return level.join(shared, "h")


def _remove(parts: DataFrame, window: int) -> DataFrame:
    """Words left after those covered by windows at ``positions`` go."""

    def run(batches):
        for batch in w.chunks(batches, "size"):
            words = w.split(unpacked(batch.column("packed"), batch.column("size")))
            listed, removed, shas, texts = words.uniques.to_pylist(), [], [], []
            for i, starts in enumerate(batch.column("positions")):
                n = int(words.counts[i])
                marked = np.zeros(n + 1, np.int64)
                at = starts.values.to_numpy()
                np.add.at(marked, at, 1)
                np.add.at(marked, at + window, -1)
                drop = np.cumsum(marked)[:n] > 0
                codes = words.codes[words.offsets[i] : words.offsets[i + 1]][~drop]
                texts.append(" ".join([listed[k] for k in codes.tolist()]))
                shas.append(hashlib.sha256(texts[-1].encode()).hexdigest())
                removed.append(int(drop.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "rid", "n_removed", "kept_sha256", "kept"])

    return parts.select("doc_id", "rid", "packed", "size", "positions").mapInArrow(w.releasing(run), "doc_id bigint, rid bigint, n_removed bigint, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, *, window: int = 50, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a ``window`` of words that also starts in a smaller ``doc_id``.

    One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space) and, with ``with_text``, ``kept``, null where nothing went.

    Level by level: the first takes windows of an eighth to a quarter of the length (for 50 words: 13),
    and of these only the anchors, the least hash in each window of the full length.  Anchors that
    repeat in different word sequences are extended to windows of twice their length, forwards and
    backwards, those that repeat again to twice that, and so on, until ``window`` is reached, where
    every window around a survivor is compared, or no candidate survives.  Documents of one word
    sequence form a class: all but those of the smallest ``doc_id`` go whole, and only these take part
    in the levels.  Windows are compared by 64-bit hashes.

    Texts shorter than ``window``, null and empty texts lose nothing.  A row with a null ``doc_id``
    loses nothing and takes nothing from others.  Repeats inside one document, and rows that share a
    ``doc_id``, don't count: there must be a smaller id.
    """
    rows, lengths = keyed(docs), level_lengths(window)
    base = written(_first_level(rows, lengths), "windows")
    classes = written(base.filter("doc_id IS NOT NULL").groupBy("whole", "n_words").agg(F.min("doc_id").alias("first")), "classes")
    marked = base.drop("hashes", "positions", "longer").join(classes, ["whole", "n_words"], "left")
    leaders = base.filter("doc_id IS NOT NULL AND size(hashes) > 0").join(classes, ["whole", "n_words"]).filter("doc_id = first")
    spread = leaders.select("doc_id", "rid", F.explode(F.arrays_zip("hashes", "positions", "longer")).alias("x"))
    level = written(spread.select(F.col("x.hashes").alias("h"), "doc_id", "rid", F.col("x.positions").alias("at"), F.col("x.longer").alias("longer")), "level")
    found, old = _repeated(level).select("doc_id", "rid", "at", "longer", F.explode(F.array(F.lit(0), F.lit(1))).alias("side")), [level]
    for k, length in enumerate(lengths[1:-1]):
        h = F.element_at("longer", 2 * k + 1 + F.col("side"))
        level = written(found.select(h.alias("h"), "doc_id", "rid", "at", "longer", "side").filter("h <> 0"), "level")
        discard(*old)
        found, old = _repeated(level), [level]
        if level.isEmpty():
            break
    start = F.col("at") + F.when(F.col("side") == 1, lengths[0] - lengths[-2]).otherwise(0)
    spots = written(found.select("doc_id", "rid", start.alias("position")).groupBy("doc_id", "rid").agg(F.collect_set("position").alias("positions")), "spots")
    discard(*old)
    level = written(_last_level(packed_texts(rows).join(spots, ["doc_id", "rid"]), lengths[-2], window), "level")
    gone = _repeated(level).filter("low < doc_id").groupBy("doc_id", "rid").agg(F.collect_set("position").alias("positions"))
    cut = _remove(packed_texts(rows).join(gone, ["doc_id", "rid"]), window)
    cut = (cut if with_text else cut.withColumn("kept", F.lit(None).cast("string"))).dropDuplicates(["doc_id", "rid"])
    whole = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_words") >= window), F.lit(False))
    out = marked.join(cut, ["doc_id", "rid"], "left").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    return out if with_text else out.drop("kept")
