"""Operator 11: importance resampling towards a target distribution, over hashed n-grams."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.lines import LOWER, UPPER
from tessera.llm.shared import discard, written

#: ASCII without digits and letters; every other character is part of a word.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def words_column(text: str = "text") -> Column:
    """The words of a whole text, A-Z in lower case; null has none."""
    plain = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.array_remove(F.split(plain, " ", -1), "")


def hashed_runs(words: Column, most_words: int, buckets: int) -> Column:
    """The buckets of all runs of 1 to ``most_words`` of the words.

    Runs of k words are made of those of k - 1 words and the words k - 1 places on, so a run is one
    concatenation and one checksum.
    """

    def bucket(run: Column) -> Column:
        return F.pmod(F.crc32(run.cast("binary")), F.lit(int(buckets))).cast("int")

    runs, hashed = words, [F.transform(words, bucket)]
    for k in range(2, most_words + 1):
        left = F.greatest(F.size(words) - (k - 1), F.lit(0))
        runs = F.zip_with(F.slice(runs, 1, left), F.slice(words, k, left), lambda a, b: F.concat(a, F.lit(" "), b))
        hashed.append(F.transform(runs, bucket))
    return F.concat(*hashed)


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it: a lambda's variable is."""
    return F.transform(F.array(value), use)[0]


def hashed_documents(docs: DataFrame, most_words: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, hashed) of every row: how many words its text has, and the bucket of each feature."""
    both = once(words_column(), lambda words: F.struct(F.size(words).cast("long").alias("n_words"), hashed_runs(words, most_words, buckets).alias("hashed")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.array(both)).alias("x"))
    return rows.select("doc_id", "x.n_words", "x.hashed")


def bucket_counts(hashed: DataFrame, buckets: int) -> dict[int, int]:
    """How many features lie in each bucket: a total of each task is shuffled, ``buckets`` rows reach the driver."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["b", "n"])

    counts = hashed.select("hashed").mapInArrow(run, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n"))
    return {r["b"]: r["n"] for r in counts.collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of every bucket, in doubles."""
    total_s, total_t = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * total_s / ((source.get(b, 0) + 1.0) * total_t))) for b in range(buckets)]


def score_documents(hashed: DataFrame, gains: list[int], seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of :func:`hashed_documents`, without a shuffle.

    The gains are one literal array in the plan; a document's buckets are looked up in it and summed
    where they are, so no row is made for a feature.
    """
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")
    total = F.aggregate("hashed", F.lit(0).cast("long"), lambda acc, b: acc + F.element_at(table, b + 1))
    weighed = hashed.select("doc_id", "n_words", F.size("hashed").cast("long").alias("n_features"), total.alias("total"))
    weight = F.when(F.col("n_features") > 0, F.floor(F.col("total") / F.col("n_features"))).otherwise(F.lit(0)).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{int(seed)}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    gumbel = F.floor(-1000 * F.log(-F.log(uniform))).cast("long")
    return weighed.select("doc_id", "n_words", "n_features", weight.alias("weight")).withColumn("score", F.col("weight") + gumbel)


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... of the drawn rows by falling score, then doc_id; null elsewhere.

    Scores are whole numbers within some tens of thousands, so how many rows lie above each score is a
    running sum over that many rows at most; only rows of one score are then put in order, and only
    those whose score can be drawn.
    """
    able = F.col("n_words") >= least_words
    counts = scored.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    quota = percent * (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // 100
    above = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    places = counts.select("score", above.alias("above")).filter(F.col("above") < quota)
    rows = scored.join(places, "score", "left").withColumn("open", able & F.col("above").isNotNull())
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id")))
    drawn = rows.filter("open").withColumn("rank", F.col("above") + place)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")).cast("long"))
    rest = rows.filter(~F.col("open")).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("above", "open")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 25, least_words: int = 20, most_words: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score and rank.

    Features are all runs of 1 to ``most_words`` words, hashed into ``buckets``.  A bucket's gain is how
    much commoner it is in ``target`` than in ``docs``, a document's weight the floored mean gain of its
    features, its score that weight and Gumbel noise of the doc_id.  Of the documents with at least
    ``least_words`` words the given percentage with the highest scores is drawn, so a draw follows the
    weights without replacement.

    Null and empty texts have no feature and weight 0; a null doc_id is hashed like an empty one and comes
    last among equal scores; repeated rows each count, get equal scores and ranks of their own in no
    fixed order; very long texts are read whole; an empty table of documents gives no row, an empty
    target gains from the counts of the documents alone.  Other columns are not read.
    """
    hashed = written(hashed_documents(docs, most_words, buckets), "hashed")
    wanted = bucket_counts(hashed_documents(target.select(F.lit(0).alias("doc_id"), "text"), most_words, buckets), buckets)
    gains = bucket_gains(bucket_counts(hashed, buckets), wanted, buckets)
    scored = written(score_documents(hashed, gains, seed), "scored")
    discard(hashed)
    return ranked(scored, percent, least_words)
