"""Operator 7: quality rules with a modified Kneser-Ney character n-gram model (:mod:`tessera.llm.grams`)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.grams import MAPPED, GramBlock, blocks_of, train_grams
from tessera.llm.shared import written

#: Languages up to which the bands, a row each, are broadcast; more are joined by a shuffle.
MOST_BANDS = 10_000


def base_measures(texts: pa.Array, words: w.Words) -> dict[str, np.ndarray]:
    """Counts of the base rules by text."""
    docs = len(texts)
    chars = pc.utf8_length(words.uniques).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten().dictionary_encode()
    worded = pc.match_substring_regex(flat.dictionary, "[^\\x20\\x09-\\x0D]").to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(docs, dtype=np.int64), np.diff(lines.offsets.to_numpy()))
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keep = worded[codes] if len(codes) else np.zeros(0, bool)
    of, codes = of[keep], codes[keep]
    distinct = np.unique(of * max(1, len(flat.dictionary)) + codes) // max(1, len(flat.dictionary))
    starts = w.window_starts(words.offsets, 3)
    doc = np.repeat(np.arange(docs, dtype=np.int64), np.maximum(words.counts - 2, 0))
    triple = w.mix(w.window_hashes(w.mix(words.codes.astype(np.uint64) + np.uint64(1)), 3)[starts] ^ w.mix(doc.astype(np.uint64))) if len(starts) else np.zeros(0, np.uint64)
    order = np.argsort(triple, kind="stable")
    same = triple[order][1:] == triple[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(starts) else twice
    cover = np.zeros(len(words.codes), bool)
    for j in range(3):
        cover[starts[twice] + j] = True
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": w.sums(chars[words.codes], words.offsets),
        "n_symbols": pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": np.bincount(of, minlength=docs) - np.bincount(distinct, minlength=docs),
        "n_repeat_words": w.sums(cover.astype(np.int64), words.offsets),
    }


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, block: GramBlock) -> DataFrame:
    """Per row: doc_id, lang, rid, the base measures, and the model block's ``logs`` over ``symbols``."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in w.chunks(batches, most=w.CHUNK_BYTES // 2):
            texts = w.texts_of(batch)
            got = base_measures(texts, w.split(texts))
            logs, n = shared.value.text_logs(texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "lang", "rid")), *(pa.array(got[k], pa.int64()) for k in _MEASURES), pa.array(logs), pa.array(n, pa.int64())], names=["doc_id", "lang", "rid", *_MEASURES, "logs", "symbols"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.xxhash64("doc_id", "text").alias("rid"), "text")
    return rows.mapInArrow(w.releasing(run, MAPPED), f"doc_id bigint, lang string, rid bigint, {', '.join(f'{k} bigint' for k in _MEASURES)}, logs double, symbols bigint")


def other_logs(docs: DataFrame, block: GramBlock) -> DataFrame:
    """(rid, other): what a further block of the model adds to ``logs``."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        for batch in w.chunks(batches, most=w.CHUNK_BYTES // 2):
            yield pa.RecordBatch.from_arrays([batch.column("rid"), pa.array(shared.value.text_logs(w.texts_of(batch))[0])], names=["rid", "other"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "text").mapInArrow(w.releasing(run, MAPPED), "rid bigint, other double")
    return rows.groupBy("rid").agg(F.max("other").alias("other"))


def measure_all(docs: DataFrame, table: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Rows of :func:`measure` with ``nats``, the mean negative log-probability of a symbol under the whole table."""
    rows = others = None
    for block in blocks_of(table, block_rows):
        if rows is None:
            rows = written(measure(docs, block), "measured")
        else:
            part = written(other_logs(docs, block), "measured-block")
            others = part if others is None else others.unionByName(part)
    if others is not None:
        rows = rows.join(written(others.groupBy("rid").agg(F.sum("other").alias("other")), "measured-blocks"), "rid", "left")
        rows = written(rows.withColumn("logs", F.col("logs") + F.coalesce("other", F.lit(0.0))).drop("other"), "measured")
    return rows.withColumn("nats", F.when(F.col("symbols") > 0, -F.col("logs") / F.col("symbols")))


def bands(measured: DataFrame, *, width: float = 6.0, least_words: int = 50) -> DataFrame:
    """(lang, low, high): per language the band of log-perplexity, around the median of all its documents.

    Half the band is ``width`` times the distance from the median to the nearer quartile's side
    (the lower quartile below, the upper above), and 0.05 at least.
    """
    q = F.percentile_approx("nats", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000))
    spread = measured.filter(F.col("n_words") >= least_words).groupBy("lang").agg(q.alias("q"))
    return spread.select("lang", (F.col("q")[1] - F.greatest(F.lit(0.05), width * (F.col("q")[1] - F.col("q")[0]))).alias("low"), (F.col("q")[1] + F.greatest(F.lit(0.05), width * (F.col("q")[2] - F.col("q")[1]))).alias("high"))


def apply_quality_rules(docs: DataFrame, model: DataFrame | None = None, *, least_words: int = 50, width: float = 6.0) -> DataFrame:
    """One row per document (doc_id, text, lang): the base measures, base_failed, perplexity, kept.

    A document fails the base rules with under ``least_words`` words, or if over half of its words
    lie in 3-word windows that occur twice or more.  Of the others, those outside their language's
    perplexity band (:func:`bands`; a null ``lang`` is a language of its own) are rejected.  Without
    ``model``, a table of :func:`tessera.llm.grams.train_grams` is counted over all ``docs``.

    Null and empty texts have all measures 0, a null perplexity, and fail; repeated rows count, and
    are judged, each; very long texts are measured whole; an empty table gives no row; columns of any other
    name are not read.
    """
    measured = measure_all(docs, train_grams(docs) if model is None else model)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    table = written(bands(measured, width=width, least_words=least_words), "bands")
    rows = measured.join(F.broadcast(table) if table.count() <= MOST_BANDS else table, "lang", "left")
    inside = F.coalesce(F.col("nats").between(F.col("low"), F.col("high")), F.lit(False))
    return rows.select("doc_id", *_MEASURES, failed.alias("base_failed"), (~failed & inside).alias("kept"), F.exp("nats").alias("perplexity"), F.exp("low").alias("perplexity_low"), F.exp("high").alias("perplexity_high"))
