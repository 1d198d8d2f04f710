"""Operator 2: language identification by mixture inference over n-gram likelihoods."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w

BUCKET_BITS = 16
CHUNK_BYTES = 2 << 20
SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double, mixture string"


def held_out(doc_id="doc_id"):
    """crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_grams(uniques: pa.Array, orders=(1, 2, 3)) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of every character n-gram of lower-cased words with a boundary on both sides."""
    if not len(uniques):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = " " + " ".join(pc.utf8_lower(uniques).to_pylist()) + " "
    cp = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    space = cp == 32
    word = np.cumsum(space) - 1
    found, owner = [], []
    for n in orders:
        h = np.zeros(len(cp) - n + 1, np.uint64)
        ok = np.ones(len(h), bool)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + cp[j : len(cp) - n + 1 + j]
            if 0 < j < n - 1 or n == 1:
                ok &= ~space[j : len(cp) - n + 1 + j]
        found.append((w.mix(h[ok] * np.uint64(8) + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owner.append(word[: len(h)][ok])
    return np.concatenate(found), np.concatenate(owner)


@dataclass
class LanguageModel:
    languages: list[str]
    #: log-likelihood of every n-gram bucket under every language, shape (2**BUCKET_BITS, languages)
    logs: np.ndarray
    #: likelihood ratio below which a word says nothing more against a language
    floor: float = 1e-4
    rounds: int = 8
    #: penalty of a further language, in multiples of log(words) / 2
    penalty: float = 3.0
    #: by language, what an n-gram's log-likelihood is on average in its own documents
    means: np.ndarray | None = None
    #: variances of that average: between the words of a document, and between documents
    spread: tuple[float, float] = (0.0, 0.0)

    def word_logs(self, uniques: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood of every word under every language, number of its n-grams)."""
        bucket, owner = word_grams(uniques)
        logs = [np.bincount(owner, weights=self.logs[bucket, k], minlength=len(uniques)) for k in range(len(self.languages))]
        return np.stack(logs, axis=1), np.bincount(owner, minlength=len(uniques))

    def mixtures(self, words: w.Words) -> np.ndarray:
        """Language proportions of every text; all zero without letters."""
        return self.judged(words)[0]

    def judged(self, words: w.Words) -> tuple[np.ndarray, np.ndarray]:
        """(language proportions, fit) of every text; all zero without letters.

        Expectation-maximisation over words, ``rounds`` times, gives the proportions for all languages;
        the k best of them, for k = 1, 2, ..., are fitted again, and the set of the best penalised
        likelihood stays.  The sets are thus prefixes of one order, not all subsets.

        The fit is absolute: how much likelier or less likely than in the learned documents the words'
        n-grams are, each word under the language that suits it best, in standard deviations.
        """
        lettered = pc.match_substring_regex(words.uniques, r"\p{L}").to_numpy(zero_copy_only=False)
        words = words.keep(lettered)
        out, fit = np.zeros((len(words.offsets) - 1, len(self.languages))), np.zeros(len(words.offsets) - 1)
        if not (len(words.codes) and self.languages):
            return out, fit
        some = np.flatnonzero(words.counts)
        offsets = np.concatenate([words.offsets[some], words.offsets[-1:]])
        logs, grams = self.word_logs(words.uniques)
        if self.means is not None:
            near = (logs / np.maximum(grams, 1)[:, None] - self.means).max(axis=1)
            n = words.counts[some]
            fit[some] = np.add.reduceat(near[words.codes], offsets[:-1]) / n / np.sqrt(self.spread[0] / n + self.spread[1] + 1e-12)
        ratios = np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), self.floor)
        full, _ = self._em(ratios, words.codes, offsets, np.ones((len(some), len(self.languages)), bool))
        singles = np.add.reduceat(np.log(ratios)[words.codes], offsets[:-1], axis=0)
        order = np.argsort(-full, axis=1, kind="stable")
        best = np.take_along_axis(singles, singles.argmax(axis=1)[:, None], 1)[:, 0]
        chosen = np.eye(len(self.languages))[singles.argmax(axis=1)]
        n = np.diff(offsets)
        # Even all languages together, each word under its best one, gain no more than -best.
        open_ = np.flatnonzero(-best > self.penalty * np.log(n + 1) / 2)
        for k in range(2, len(self.languages) + 1):
            if not len(open_):
                break
            support = np.zeros((len(open_), len(self.languages)), bool)
            np.put_along_axis(support, order[open_, :k], True, 1)
            at = np.repeat(offsets[:-1][open_] - np.concatenate([[0], np.cumsum(n[open_])[:-1]]), n[open_]) + np.arange(n[open_].sum())
            shares, value = self._em(ratios, words.codes[at], np.concatenate([[0], np.cumsum(n[open_])]), support)
            value -= self.penalty * (k - 1) * np.log(n[open_] + 1) / 2
            better = value > best[open_]
            best[open_[better]], chosen[open_[better]] = value[better], shares[better]
            open_ = open_[-self.penalty * k * np.log(n[open_] + 1) / 2 > best[open_]]
        out[some] = chosen
        return out, fit

    def main(self, words: w.Words) -> np.ndarray:
        """The likeliest single language of every text, by its number; -1 without letters.  No mixture is fitted."""
        words = words.keep(pc.match_substring_regex(words.uniques, r"\p{L}").to_numpy(zero_copy_only=False))
        out = np.full(len(words.offsets) - 1, -1)
        if len(words.codes) and self.languages:
            some = np.flatnonzero(words.counts)
            logs, _ = self.word_logs(words.uniques)
            best = np.log(np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), self.floor))
            out[some] = w.sums(best[words.codes], words.offsets)[some].argmax(axis=1)
        return out

    def _em(self, ratios: np.ndarray, codes: np.ndarray, offsets: np.ndarray, support: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(offsets)
        of = np.repeat(np.arange(len(n)), n)
        seen = ratios[codes].astype(np.float32)
        share = (support / support.sum(axis=1, keepdims=True)).astype(np.float32)
        for _ in range(self.rounds):
            got = seen * share[of]
            got /= got.sum(axis=1, keepdims=True)
            share = np.add.reduceat(got, offsets[:-1], axis=0) / n[:, None].astype(np.float32)
        return share, np.add.reduceat(np.log((seen * share[of]).sum(axis=1)).astype(np.float64), offsets[:-1])


def train_languages(docs: DataFrame, *, smoothing: float = 0.5, fit: bool = True) -> LanguageModel:
    """Count character n-grams per language of all documents (doc_id, text, lang) that are not held out.

    The counts are summed in Spark and fill one fixed-size table on the driver.  With ``fit`` a second pass
    learns how well documents of a language fit it (:meth:`LanguageModel.judged`).
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang")
    languages = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    if not languages:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0)))
    number = {k: i for i, k in enumerate(languages)}

    def count(batches):
        table = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for batch in w.chunks(batches):
            words = w.split(w.texts_of(batch))
            bucket, owner = word_grams(words.uniques)
            of = np.repeat([number[x] for x in batch.column("lang").to_pylist()], words.counts)
            for k in np.unique(of):
                times = np.bincount(words.codes[of == k], minlength=len(words.uniques))
                table[k] += np.bincount(bucket, weights=times[owner], minlength=1 << BUCKET_BITS).astype(np.int64)
        k, b = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(b), pa.array(table[k, b])], names=["k", "bucket", "n"])

    table = np.zeros((1 << BUCKET_BITS, len(languages)))
    rows = known.mapInArrow(w.releasing(count), "k bigint, bucket bigint, n bigint").groupBy("k", "bucket").agg(F.sum("n").alias("n"))
    for k, b, n in rows.toArrow().to_pandas().itertuples(index=False):
        table[b, k] = n
    table += smoothing
    model = LanguageModel(languages, np.log(table / table.sum(axis=0)))
    if fit:
        model.means, model.spread = _own_fit(known, model, number)
    return model


def _own_fit(known: DataFrame, model: LanguageModel, number: dict[str, int]) -> tuple[np.ndarray, tuple[float, float]]:
    """``means`` and ``spread`` of the model over the documents it was learned from, summed in Spark."""
    names = ("docs", "words", "inverse", "mean", "mean2", "word2")

    def run(batches):
        for batch in w.chunks(batches, most=CHUNK_BYTES):
            words = w.split(w.texts_of(batch))
            words = words.keep(pc.match_substring_regex(words.uniques, r"\p{L}").to_numpy(zero_copy_only=False))
            some = np.flatnonzero(words.counts)
            if not len(some):
                continue
            logs, grams = model.word_logs(words.uniques)
            own = np.repeat(np.array([number[x] for x in batch.column("lang").to_pylist()]), words.counts)
            each = logs[words.codes, own] / np.maximum(grams, 1)[words.codes]
            n = words.counts[some]
            mean = w.sums(each, words.offsets)[some] / n
            square = w.sums((each - np.repeat(mean, n)) ** 2, words.offsets)[some]
            k = np.array([number[x] for x in batch.column("lang").to_pylist()])[some]
            sums = [np.bincount(k, weights=x, minlength=len(model.languages)) for x in (np.ones(len(n)), n, 1 / n, mean, mean * mean, square)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(model.languages))), *map(pa.array, sums)], names=["k", *names])

    rows = known.mapInArrow(w.releasing(run), "k bigint, " + ", ".join(f"{x} double" for x in names)).groupBy("k").agg(*(F.sum(x).alias(x) for x in names))
    means, word, between = np.zeros(len(model.languages)), 0.0, 0.0
    for r in rows.collect():  # a row for each language
        if r["docs"]:
            means[r["k"]] = r["mean"] / r["docs"]
            own = r["word2"] / max(1.0, r["words"] - r["docs"])
            word = max(word, own)
            between = max(between, r["mean2"] / r["docs"] - means[r["k"]] ** 2 - own * r["inverse"] / r["docs"])
    return means, (word, between)


def identify_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, mixture.

    ``mixture`` lists the chosen languages with their shares, largest first ("en:0.93 fr:0.07");
    ``score`` is the share of the first, which is ``lang_pred``.  A text that is null, empty or has no
    letters is ``und`` with score 0, as is every text if the model knows no language.  Ties go to the
    language that sorts first.  Only the text is looked at.  Very long texts are read whole; repeated rows
    each get the same result; an empty table gives no row; columns of any other name are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        names = [*model.languages, "und"]
        for batch in w.chunks(batches, most=CHUNK_BYTES):
            mixture = model.mixtures(w.split(w.texts_of(batch))) if model.languages else np.zeros((batch.num_rows, 0))
            some = mixture.sum(axis=1) > 0
            first = np.where(some, mixture.argmax(axis=1), -1) if model.languages else np.full(batch.num_rows, -1)
            score = np.clip(mixture.max(axis=1, initial=0), 0, 1)
            listed = [" ".join(f"{names[k]}:{row[k]:.2f}" for k in np.argsort(-row, kind="stable") if row[k] >= 0.005) for row in mixture]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([names[k] for k in first], pa.string()), pa.array(score, pa.float64()), pa.array(listed, pa.string())], names=["doc_id", "held_out", "lang_pred", "score", "mixture"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(w.releasing(run), SCHEMA)


def keep_identified(docs: DataFrame, model: LanguageModel, *, least_score: float, least_fit: float = -8.0) -> DataFrame:
    """The rows of ``docs`` whose main language has a share of ``least_score``, all columns kept.

    Texts that are ``und`` go, and so do texts whose words fit no learned language: those that lie
    more than -``least_fit`` standard deviations below what the learned documents show
    (:meth:`LanguageModel.judged`; texts of few words scatter more and are allowed more).  Very long
    texts are judged whole, empty and null ones go; nothing is shuffled.  A model that knows no
    language keeps every row with letters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in w.chunks(batches, most=CHUNK_BYTES):
            texts = w.texts_of(batch)
            if shared.value.languages:
                mixture, fit = shared.value.judged(w.split(texts))
                good = (mixture.max(axis=1, initial=0) >= least_score) & (fit >= least_fit)
            else:
                good = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(w.releasing(run), docs.schema)
