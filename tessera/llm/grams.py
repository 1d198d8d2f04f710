"""A modified Kneser-Ney model over the characters of whole texts, built and kept in Spark.

Texts are lower-cased and runs of ASCII white space are one space, so n-grams cross words.  No
character is cut: an n-gram of up to five code points is held exactly in two integers, ``a`` with the
first three and ``b`` with the last two (21 bits each, 0 before the start of a text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.shared import discard, written

ORDER = 5
BITS = 21
ONE, TWO = (1 << BITS) - 1, (1 << 2 * BITS) - 1
#: What is left of ``a`` and ``b`` in the last n characters.
MASKS = {1: (0, ONE), 2: (0, TWO), 3: (ONE, TWO), 4: (TWO, TWO), 5: ((1 << 3 * BITS) - 1, TWO)}
#: Rows of the table that one pass over the texts looks up; a larger table takes more passes.
BLOCK_ROWS = 4_000_000
SCORE_BYTES = 2 << 20
#: Arrays of so many bytes are mapped on their own (:func:`tessera.llm.words.releasing`).
MAPPED = 16 << 20
_PRIME = 1_000_003


def symbols_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of all normalised texts, the text of each, its place in it); a space ends a text."""
    lower = pc.utf8_lower(texts)
    cp = np.frombuffer("".join(f"{x} " for x in lower.to_pylist()).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    size = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), size)
    space = (cp == 32) | ((cp >= 9) & (cp <= 13))
    before = np.concatenate([[True], space[:-1]])
    before[(np.cumsum(size) - size)[size > 0]] = True
    keep = ~(space & before)
    cp, owner = np.where(space, 32, np.where(cp == 0, 0xFFFD, cp))[keep], owner[keep]
    return cp, owner, np.arange(len(cp)) - np.searchsorted(owner, owner)


def distinct_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a, b) of the different n-grams of the highest order, which of them each symbol ends, and its text."""
    cp, owner, place = symbols_of(texts)
    ids, known = pd.factorize(cp)
    base = len(known) + 1
    back = np.zeros(len(cp), np.int64)
    columns = []
    for j in range(ORDER - 1, -1, -1):
        columns.append(np.where(place >= j, np.concatenate([np.zeros(min(j, len(cp)), np.int64), ids[: max(0, len(cp) - j)] + 1]), 0))
        back = back * base + columns[-1]
        if base**ORDER >= 1 << 63:  # too many different characters for one integer: number what there is so far
            back = pd.factorize(back)[0].astype(np.int64)
    back, kinds = pd.factorize(back)
    first = np.zeros(len(kinds), np.int64)
    first[back[::-1]] = np.arange(len(cp) - 1, -1, -1)
    point = np.concatenate([[0], known]).astype(np.int64)
    c = [point[x[first]] for x in columns]
    return c[0] << 2 * BITS | c[1] << BITS | c[2], c[3] << BITS | c[4], back, owner


def count_grams(texts: DataFrame) -> DataFrame:
    """(a, b, n): every n-gram of the highest order in all texts."""

    def run(batches):
        for batch in w.chunks(batches, most=SCORE_BYTES):
            a, b, back, _ = distinct_grams(w.texts_of(batch))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.bincount(back, minlength=len(a)).astype(np.int64))], names=["a", "b", "n"])

    return texts.mapInArrow(w.releasing(run, MAPPED), "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of n-grams counted once, twice and more often."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    return [min(k, max(0.0, k - (k + 1) * y * b / a)) if a and y else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def _key(kind: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return w.mix(w.mix(a.astype(np.uint64) ^ (np.uint64(kind) << np.uint64(58))) + b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def train_grams(docs: DataFrame) -> DataFrame:
    """(kind, a, b, v): kind 2n has log-probabilities of n-grams, 2n + 1 log back-off weights of their contexts.

    The highest order has plain counts; an n-gram of a lower order counts the different symbols
    before it.  Every order is a grouping and two joins with what the shorter n-grams gave, so the
    table is as long as the corpus has n-grams, and only four counts an order reach the driver.
    """
    counts = {ORDER: written(count_grams(docs.select("text").filter(F.col("text").isNotNull())), "grams")}
    for n in range(ORDER - 1, 0, -1):
        a, b = (F.col(x).bitwiseAND(F.lit(m)).alias(x) for x, m in zip("ab", MASKS[n], strict=True))
        counts[n] = written(counts[n + 1].select(a, b).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), f"grams-{n}")
    parts, lower = [], None
    for n in range(1, ORDER + 1):
        seen = counts[n].agg(F.count(F.lit(1)), *(F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4))).first()
        d = discounts(*seen[1:])
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        rows = counts[n].select("a", "b", "n", off.alias("off"), F.shiftright("a", BITS).alias("ca"), F.shiftleft(F.col("a").bitwiseAND(F.lit(ONE)), BITS).bitwiseOR(F.shiftright("b", BITS)).alias("cb"))
        contexts = rows.groupBy("ca", "cb").agg(F.sum("n").alias("total"), F.greatest(F.lit(1e-9), F.sum("off") / F.sum("n")).alias("left"))
        rows = rows.join(contexts, ["ca", "cb"])
        if lower is None:
            rows = rows.withColumn("low", F.lit(1 / (seen[0] + 1)))
        else:
            a, b = (F.col(x).bitwiseAND(F.lit(m)) for x, m in zip("ab", MASKS[n - 1], strict=True))
            rows = rows.withColumns({"sa": a, "sb": b}).join(lower.select(F.col("a").alias("sa"), F.col("b").alias("sb"), F.col("p").alias("low")), ["sa", "sb"])
        lower = written(rows.select("a", "b", (F.greatest(F.col("n") - F.col("off"), F.lit(0.0)) / F.col("total") + F.col("left") * F.col("low")).alias("p")), f"model-{n}")
        parts.append(lower.select(F.lit(2 * n).alias("kind"), "a", "b", F.log(F.greatest("p", F.lit(1e-12))).cast("float").alias("v")))
        parts.append(contexts.select(F.lit(2 * n + 1).alias("kind"), F.col("ca").alias("a"), F.col("cb").alias("b"), F.log("left").cast("float").alias("v")))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    table = written(table, "model")
    discard(*counts.values())
    return table


@dataclass
class GramBlock:
    """Block ``number`` of ``blocks``: sorted hashes and values by kind.

    Longer n-grams and contexts lie in the block of the two characters before the predicted one, so
    all lookups of a symbol meet in one block; those of up to two characters are in every block.
    """

    number: int
    blocks: int
    symbols: int
    keys: list[np.ndarray]
    values: list[np.ndarray]

    def gram_logs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Natural log-probability of the last characters after the others; 0 for those of other blocks."""
        out = np.zeros(len(a))
        pair = (a & ONE) << BITS | b >> BITS
        open_ = np.flatnonzero(pair % _PRIME % self.blocks == self.number)
        weight = np.zeros(len(a))
        for n in range(ORDER, 0, -1):
            x, y = a[open_] & MASKS[n][0], b[open_] & MASKS[n][1]
            seen, v = self._get(2 * n, x, y)
            out[open_[seen]] = v[seen] + weight[open_[seen]]
            open_, x, y = open_[~seen], x[~seen], y[~seen]
            weight[open_] += self._get(2 * n + 1, x >> BITS, (x & ONE) << BITS | y >> BITS)[1]
        out[open_] = weight[open_] - np.log(self.symbols + 1)
        return out

    def _get(self, kind: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, wanted = self.keys[kind], _key(kind, a, b)
        if not len(keys):
            return np.zeros(len(a), bool), np.zeros(len(a))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        return found, np.where(found, self.values[kind][at], 0.0)

    def text_logs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the block's log-probabilities, number of symbols) of every text."""
        logs, sizes = [], []
        for part in w.chunks([pa.RecordBatch.from_arrays([texts], names=["text"])], most=SCORE_BYTES):
            a, b, back, owner = distinct_grams(part.column("text"))
            logs.append(np.bincount(owner, weights=self.gram_logs(a, b)[back], minlength=part.num_rows))
            sizes.append(np.bincount(owner, minlength=part.num_rows))
        return np.concatenate([np.zeros(0), *logs]), np.concatenate([np.zeros(0, np.int64), *sizes])


def blocks_of(table: DataFrame, block_rows: int | None = None) -> Iterator[GramBlock]:
    """The blocks of :func:`train_grams`, one at a time, each of about ``block_rows`` rows."""
    rows, symbols = table.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("kind") == 2).cast("long")), F.lit(0))).first()
    blocks = max(1, -(-rows // (block_rows or BLOCK_ROWS)))

    def run(batches):
        for batch in batches:
            kind, a, b = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("kind", "a", "b"))
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(_key(kind, a, b).view(np.int64)), batch.column("v")], names=["kind", "key", "v"])

    before = F.shiftleft(F.col("a").bitwiseAND(F.lit(ONE)), BITS).bitwiseOR(F.shiftright("b", BITS))
    pair = F.when(F.col("kind") % 2 == 0, before).otherwise(F.col("b"))
    for k in range(blocks):
        mine = table.filter((F.col("kind") < 6) | (pair % _PRIME % blocks == k))
        got = mine.mapInArrow(w.releasing(run), "kind int, key bigint, v float").toArrow()
        kind, key, v = (got.column(x).to_numpy() for x in ("kind", "key", "v"))
        key, keys, values = key.view(np.uint64), [], []
        for i in range(2 * ORDER + 2):
            own = np.flatnonzero(kind == i)
            own = own[np.argsort(key[own])]
            keys.append(key[own])
            values.append(v[own])
        yield GramBlock(k, blocks, symbols, keys, values)
