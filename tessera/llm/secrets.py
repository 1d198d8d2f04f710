"""Operator 3: secret scans by patterns and by character Markov models."""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.shared import discard, written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: The base rules' minimum lengths make these equal to the runs that are long enough.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
#: What the models judge: runs of at least 16 characters that hold a letter and a digit; a run with
#: slashes that is no secret as a whole (a path) is judged by its parts.
CANDIDATE, PART = re.compile(r"[A-Za-z0-9+/_=-]{16,}"), re.compile(r"[A-Za-z0-9+_=-]{16,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
LEAST = 16
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
_CODE = np.full(256, len(ALPHABET), np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
#: Kinds of strings that :func:`random_strings` makes in turn.
SETS = 5
KINDS = ("assign", "access", "hex", "markov")
_ROW = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_markov bigint, spans array<struct<kind:string,start:bigint,stop:bigint,secret:string>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, secret) of the base rules; an assignment's value has 6 characters at least."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if ":" in text or "=" in text else []
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    return found + [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]


def merged(spans: list[tuple[int, int, int, str]]) -> tuple[list[int], list[int]]:
    """(starts, ends) of the union of spans, in order and apart."""
    starts, ends = [], []
    for a, _, b, _ in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def meets(taken: tuple[list[int], list[int]], a: int, b: int) -> bool:
    """Whether a..b overlaps with the union, by a binary search."""
    i = bisect_left(taken[0], b)
    return i > 0 and taken[1][i - 1] > a


def random_strings(n: int, seed: int = 7) -> list[str]:
    """Labelled samples of random strings: base 62, base 64 and hex keys of 16 to 64 characters."""
    rng = random.Random(seed)
    sets = ("0123456789abcdef", ALPHABET[:62], ALPHABET[:62] + "+/", ALPHABET[:62] + "_-", ALPHABET[26:62])
    return ["".join(rng.choices(sets[i % len(sets)], k=rng.randint(16, 64))) for i in range(n)]


@dataclass
class MarkovPair:
    """Log-likelihood ratio of a random string over an ordinary identifier, per transition."""

    ratio: np.ndarray
    threshold: float

    def score(self, token: str) -> float:
        code = _CODE[np.frombuffer(token.encode(), np.uint8)]
        return float(self.ratio[code[:-1], code[1:]].mean()) if len(code) > 1 else 0.0


def _cells(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(transition, its token) of all tokens; a transition is a cell of the flattened matrix."""
    code = _CODE[np.frombuffer("".join(tokens.to_pylist()).encode("utf-8"), np.uint8)]
    owner = np.repeat(np.arange(len(tokens)), pc.binary_length(tokens).to_numpy(zero_copy_only=False))
    inside = owner[1:] == owner[:-1]
    return (code[:-1] * (len(ALPHABET) + 1) + code[1:])[inside], owner[1:][inside]


def _scores(tokens: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """:meth:`MarkovPair.score` of every token."""
    cells, owner = _cells(tokens)
    return np.bincount(owner, weights=ratio.ravel()[cells], minlength=len(tokens)) / np.maximum(np.bincount(owner, minlength=len(tokens)), 1)


def _count(tokens: list[str]) -> np.ndarray:
    return np.bincount(_cells(pa.array(tokens, pa.string()))[0], minlength=(len(ALPHABET) + 1) ** 2)


def _logs(counts: np.ndarray) -> np.ndarray:
    counts = counts.reshape(len(ALPHABET) + 1, -1) + 0.5
    return np.log(counts / counts.sum(axis=1, keepdims=True))


class _Listed:
    """Samples in a list."""

    def __init__(self, samples: list[tuple[str, int]]) -> None:
        self.by = [[x for x, label in samples if label == k] for k in (0, 1)]

    def count(self) -> np.ndarray:
        """Transitions of the short and long ordinary and of the random samples."""
        return np.stack([_count([x for x in self.by[0] if len(x) < LEAST]), _count([x for x in self.by[0] if len(x) >= LEAST]), _count(self.by[1])])

    def keep(self, ratio: np.ndarray, most: float) -> np.ndarray:
        """Leave out long ordinary samples that score above ``most``; the transitions of the others."""
        tokens = pa.array([x for x in self.by[0] if len(x) >= LEAST], pa.string())
        self.long = tokens.filter(pa.array(_scores(tokens, ratio) <= most, pa.bool_()))
        return np.bincount(_cells(self.long)[0], minlength=ratio.size)

    def top(self, ratio: np.ndarray, rank) -> float | None:
        """The score of kept sample number rank(n), from the highest down, 0 the first."""
        scores = np.sort(_scores(self.long, ratio))[::-1]
        return float(scores[rank(len(scores))]) if len(scores) else None


class _Spread:
    """The same over a table (token, label), whose sums are taken in Spark."""

    def __init__(self, samples: DataFrame) -> None:
        self.samples, self.long = samples, None

    def _sum(self, rows: DataFrame) -> np.ndarray:
        size = (len(ALPHABET) + 1) ** 2

        def run(batches):
            total = np.zeros((3, size), np.int64)
            for batch in batches:
                kind = batch.column("kind").to_numpy()
                cells, owner = _cells(batch.column("token"))
                total += np.bincount(kind[owner] * size + cells, minlength=3 * size).reshape(3, size)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total.ravel()[at])], names=["cell", "n"])

        out = np.zeros(3 * size, np.int64)
        for r in rows.mapInArrow(w.releasing(run), "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            out[r["cell"]] = r["n"]
        return out.reshape(3, size)

    def count(self) -> np.ndarray:
        kind = F.when(F.col("label") == 1, 2).when(F.length("token") >= LEAST, 1).otherwise(0)
        return self._sum(self.samples.select("token", kind.alias("kind")))

    def _scored(self, tokens: DataFrame, ratio: np.ndarray) -> DataFrame:
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("token"), pa.array(_scores(batch.column("token"), ratio))], names=["token", "score"])

        return tokens.select("token").mapInArrow(w.releasing(run), "token string, score double")

    def keep(self, ratio: np.ndarray, most: float) -> np.ndarray:
        self.delete()
        long = self.samples.filter((F.col("label") == 0) & (F.length("token") >= LEAST))
        self.long = written(self._scored(long, ratio).filter(F.col("score") <= most).select("token"), "ordinary")
        return self._sum(self.long.select("token", F.lit(1).alias("kind")))[1]

    def top(self, ratio: np.ndarray, rank) -> float | None:
        n = self.long.count()
        if not n:
            return None
        part = 1 - (rank(n) + 0.5) / n
        return self._scored(self.long, ratio).agg(F.percentile_approx("score", max(0.0, part), 1_000_000)).first()[0]

    def delete(self) -> None:
        if self.long is not None:
            discard(self.long)


def train_markov(samples: DataFrame | list[tuple[str, int]], *, most_false: float = 0.0005, rounds: int = 3) -> MarkovPair:
    """Fit both models on all (token, label) samples: 1 random, 0 not labelled and most likely ordinary.

    A first ordinary model knows only unlabelled samples shorter than a candidate.  Longer ones that
    score under it as 95 of 100 generated random strings of any one kind do are random-looking: they
    are no ordinary samples, so bare keys among them shift neither model nor threshold.  The others
    join the model, and all longer ones are judged anew by it, ``rounds`` times.

    The threshold is the ratio that at most ``most_false`` of the ordinary samples of the candidates'
    length exceed, and 0 at least.  Of few samples the highest 5 (of under 100, a twentieth) may
    exceed it, so that it is not the score of a single one.
    """
    all_ = _Listed(samples) if isinstance(samples, list) else _Spread(samples)
    short, long, random_ = all_.count()
    made = random_strings(5_000, seed=8)
    ratio = _logs(random_) - _logs(short if short.any() else long)
    for _ in range(rounds):
        scores = _scores(pa.array(made), ratio)
        most = min(float(np.quantile(scores[k::SETS], 0.05)) for k in range(SETS))
        ratio = _logs(random_) - _logs(short + all_.keep(ratio, most))
    top = all_.top(ratio, lambda n: max(int(most_false * n), min(5, n // 20)))
    if isinstance(all_, _Spread):
        all_.delete()
    return MarkovPair(ratio, max(0.0, top or 0.0))


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(token, label): the different tokens of all documents, and generated random strings.

    1: values of 16 characters or more that the base rules find, and the generated strings; 0: all
    runs of identifier characters of 6 or more outside the base rules' spans, plain numbers included.
    A token that is 1 anywhere is 1.
    """

    def run(batches):
        for batch in w.chunks(batches):
            secrets, others = set(), set()
            for text in batch.column("text").to_pylist():
                own = base_spans(text)
                taken = merged(own)
                others.update(m[0] for m in TOKEN.finditer(text) if not meets(taken, m.start(), m.end()))
                secrets.update(x[3] for x in own if len(x[3]) >= LEAST)
            others -= secrets
            yield pa.RecordBatch.from_arrays([pa.array([*secrets, *others], pa.string()), pa.array([1] * len(secrets) + [0] * len(others), pa.int32())], names=["token", "label"])

    rows = docs.select("text").filter(F.col("text").isNotNull()).mapInArrow(w.releasing(run), "token string, label int")
    made = docs.sparkSession.createDataFrame([(x, 1) for x in random_strings(4_000)], "token string, label int")
    return written(rows.unionByName(made).groupBy("token").agg(F.max("label").alias("label")), "tokens")


def model_spans(text: str, taken: tuple[list[int], list[int]], model: MarkovPair) -> list[tuple[int, int, int, str]]:
    """Spans of the models outside those ``taken`` (:func:`merged`)."""

    def secret(a: int, x: str) -> bool:
        return any(c.isdigit() for c in x) and not x.strip("-+/_=").isdigit() and any(c.isalpha() for c in x) and not meets(taken, a, a + len(x)) and model.score(x) > model.threshold

    found = []
    for m in CANDIDATE.finditer(text):
        if secret(m.start(), m[0]):
            found.append((m.start(), 3, m.end(), m[0]))
        elif "/" in m[0]:
            found += [(m.start() + p.start(), 3, m.start() + p.end(), p[0]) for p in PART.finditer(m[0]) if secret(m.start() + p.start(), p[0])]
    return found


def find_secrets(docs: DataFrame, model: MarkovPair) -> DataFrame:
    """One row per document: counts by kind and ``spans``, by start and then kind, in code points.

    Kinds: the base rules ``assign`` (whole match), ``access``, ``hex``, and ``markov``, a run of
    16 or more characters (slashes included) with a letter and a digit, outside every base span, whose
    mean log-likelihood ratio passes the model's threshold.  Null and empty texts have no spans; very
    long ones are scanned whole, in time that grows with their length.  Repeated rows each get the same
    result; an empty table gives no row; columns of any other name are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in w.chunks(batches):
            rows = []
            for text in w.texts_of(batch).to_pylist():
                spans = base_spans(text)
                spans += model_spans(text, merged(spans), model)
                rows.append(sorted(spans))
            kinds = [[x[1] for x in r] for r in rows]
            counts = [pa.array([k.count(i) for k in kinds], pa.int64()) for i in range(4)]
            spans = pa.array([[{"kind": KINDS[k], "start": a, "stop": b, "secret": x} for a, k, b, x in r] for r in rows], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("secret", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, spans], names=["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "spans"])

    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(w.releasing(run), _ROW)


def spans_text(kinds: tuple[str, ...] = KINDS):
    """``kind:start:end`` of the spans of these kinds, comma-joined."""
    wanted = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
