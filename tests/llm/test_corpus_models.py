"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import context_tree, resample, spelling
from tests.llm import brute

RNG = random.Random(31)


# ---------------------------------------------------------------- 11


def _plain_resample(docs, target, percent=25, least=20, most=2, buckets=10_000, seed=7):
    def features(text):
        x = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOWER))
        runs = [" ".join(x[i : i + n]) for n in range(1, most + 1) for i in range(len(x) - n + 1)]
        return len(x), [zlib.crc32(y.encode()) % buckets for y in runs]

    mine, theirs = [features(t) for _, t in docs], [features(t)[1] for t in target]
    s, t = Counter(b for _, x in mine for b in x), Counter(b for x in theirs for b in x)
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s.values()) + buckets) / ((s[b] + 1.0) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    rows = []
    for (d, _), (n, x) in zip(docs, mine):
        weight = math.floor(sum(gain[b] for b in x) / len(x)) if x else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = i + 1
    return [tuple(r) for r in rows]


def test_resampling_is_the_plain_one(spark):
    vocabulary = ["the", "Of", "été", "ÉTÉ", "x9", "日本", "a_b", "don't", "plain", "Zürich"]
    docs = [(i, " ".join(RNG.choices(vocabulary, k=RNG.choice([0, 3, 19, 20, 21, 60])))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "\x00\x7f @[`{ -"), (None, docs[5][1]), (203, "long " * 30_000), (204, docs[8][1]), (204, docs[8][1])]
    target = [" ".join(RNG.choices(vocabulary[:4], k=30)) for _ in range(10)] + [None, ""]
    frame = spark.createDataFrame([(d, t, 1, "s") for d, t in docs], "doc_id bigint, text string, score int, words string").repartition(3)
    for wanted, options in ((target, {}), ([], {}), (target, {"percent": 60, "least_words": 3, "most_words": 3, "buckets": 97, "seed": 5})):
        got = resample.resample(frame, spark.createDataFrame([(t,) for t in wanted], "text string"), **options)
        plain = {"percent": 25, "least_words": 20, "most_words": 2, "buckets": 10_000, "seed": 7} | options
        want = _plain_resample(docs, wanted, plain["percent"], plain["least_words"], plain["most_words"], plain["buckets"], plain["seed"])
        key = lambda r: tuple((x is not None, x) for x in r)
        assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=key) == sorted(want, key=key)
    assert resample.resample(frame.limit(0), spark.createDataFrame([("a",)], "text string")).count() == 0


def test_a_draw_follows_the_target(spark):
    docs = [(i, " ".join(RNG.choices(["sun", "sea"] if i % 2 else ["tax", "law"], k=40))) for i in range(400)]
    rows = resample.resample(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([("sun sea sea sun " * 50,)], "text string"), percent=25)
    drawn = [r.doc_id for r in rows.filter("rank IS NOT NULL").collect()]
    assert len(drawn) == 100 and np.mean([d % 2 for d in drawn]) > 0.9


# ---------------------------------------------------------------- 12


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _plain_spellings(counts, ratio=2):
    near = {x: [y for y in counts if y != x and _near(x, y)] for x in counts}
    form = {}
    for x, ys in near.items():
        best = min(ys, key=lambda y: (-counts[y], y), default=None)
        form[x] = best if best is not None and counts[best] >= ratio * counts[x] else None
    out = []
    for x in counts:
        root = x
        while form[root] is not None:
            root = form[root]
        out.append((x, form[x], root, counts[x], len(near[x]), counts[form[x]] if form[x] else None))
    return out


def _same_spellings(df, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("slice_words, bucket_words", [(20_000, 20_000), (4, 60)])
def test_spellings_are_the_plain_ones(spark, slice_words, bucket_words):
    counts = {}
    for _ in range(150):
        stem = "".join(RNG.choices("abcé", k=RNG.randint(1, 7)))
        counts[stem] = RNG.choice([3, 4, 8, 20, 50])
        for _ in range(3):
            i = RNG.randrange(len(stem) + 1)
            other = RNG.choice([stem[:i] + "b" + stem[i:], stem[:i] + stem[i + 1 :], stem[:i] + "ß" + stem[i + 1 :]])
            if other:
                counts[other] = RNG.choice([3, 3, 7, 9])
    counts |= {"z" * 3000: 5, "z" * 2999: 50, "z" * 3001: 3, "aaaaa😀": 3, "aaaaa": 6}
    rows = [(x, n, 1) for x, n in counts.items()] + [(None, 4, 1), ("", 9, 1)]
    words = spark.createDataFrame(rows, "word string, n bigint, form int").repartition(3)
    _same_spellings(spelling.group_spellings(words, slice_words=slice_words, bucket_words=bucket_words), _plain_spellings(counts))
    assert spelling.group_spellings(words.limit(0)).count() == 0
    twice = spark.createDataFrame([("aaaaa", 2), ("aaaaa", 3), ("aaaab", 2)], "word string, n int")
    _same_spellings(spelling.group_spellings(twice), _plain_spellings({"aaaaa": 5, "aaaab": 2}))


def test_chains_of_forms_reach_their_root(spark):
    chain = {"a" * (5 + k): 3 * 2**k for k in range(20)}
    _same_spellings(spelling.group_spellings(spark.createDataFrame(list(chain.items()), "word string, n bigint")), _plain_spellings(chain))


def test_automata_number_their_words_and_are_minimal():
    names = sorted({"".join(RNG.choices("ab", k=RNG.randint(1, 6))) for _ in range(60)})
    symbols, offsets = spelling._flat(names, np.zeros(len(names), np.int64))
    automaton = spelling.build(symbols, offsets)
    for i, name in enumerate(names):
        state, number = automaton.root, 0
        for s in symbols[offsets[i] : offsets[i + 1]]:
            edge, ok = automaton.step(np.array([state]), np.array([s]))
            assert ok[0]
            state, number = int(automaton.targets[edge[0]]), number + int(automaton.skips[edge[0]])
        assert automaton.final[state] and number == i
    languages = {frozenset(x[k:] for x in names if x.startswith(p)) for y in names for k in range(len(y) + 1) for p in [y[:k]]}
    assert len(automaton.final) == len(languages) + 1  # and the root before the group's symbol


def test_words_are_counted_with_planted_misspellings(spark):
    docs = [(i, " ".join(RNG.choices(["Letters", "étéÉTÉ", "x1y2zzzzz", "abcde", "ABCDEF"], k=400))) for i in range(30)] + [(None, "letters letters"), (40, None), (41, "")]
    want = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 7 == 0 else run] += 1
    got = spelling.count_words(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), one_in=7)
    assert {r.word: r.n for r in got.collect()} == {x: n for x, n in want.items() if len(x) >= 5 and n >= 3}


# ---------------------------------------------------------------- 13


class PlainTree:
    """Context-tree weighting, a bit at a time, from the definition."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, defaultdict(lambda: [0, 0])
        for text in texts:
            for context, node, bit in self.bits(text):
                for d in range(depth + 1):
                    self.counts[node, context[depth - d :]][bit] += 1
        self.children = defaultdict(set)
        for node, context in self.counts:
            if context:
                self.children[node, context[1:]].add((node, context))
        self.known = {}

    def bits(self, text):
        padded = b"\n" * self.depth + text
        for i, byte in enumerate(text):
            for j in range(8):
                yield padded[i : i + self.depth], (1 << j) | byte >> 8 - j, byte >> 7 - j & 1

    def own(self, key):
        a, b = self.counts.get(key, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, key):
        if key not in self.known:
            own = self.own(key)
            self.known[key] = own if len(key[1]) == self.depth else np.logaddexp(own, sum(self.weighted(x) for x in self.children[key])) - math.log(2)
        return self.known[key]

    def one(self, node, context, d=0):
        key = node, context[self.depth - d :]
        a, b = self.counts.get(key, (0, 0))
        if not a + b:
            return 0.5
        estimate, longer = (b + 0.5) / (a + b + 1), (node, context[self.depth - d - 1 :])
        if d == self.depth or longer not in self.counts:
            return estimate
        stop = 1 / (1 + math.exp(sum(self.weighted(x) for x in self.children[key]) - self.own(key)))
        return stop * estimate + (1 - stop) * self.one(node, context, d + 1)

    def log10(self, text):
        return sum(math.log10(p if bit else 1 - p) for context, node, bit in self.bits(text) for p in [self.one(node, context)])


def _normal(text):
    return b" ".join((text or "").translate(brute.LOWER).encode().split()) + b"\n"


def test_tree_scores_are_the_plain_ones(spark):
    docs = [(i, " ".join(RNG.choices(["The", "cat", "sât", "mat", "日本", "Été,"], k=RNG.choice([0, 1, 4, 30])))) for i in range(25)]
    docs += [(30, None), (31, ""), (32, " \t\n\x0b "), (33, docs[3][1]), (33, docs[3][1]), (None, "a cat"), (34, "unseen\x00 words\x85here")]
    held = {d for d, _ in docs if d is not None and d % 4 == 1}
    frame = spark.createDataFrame([(d, t, 1.0) for d, t in docs], "doc_id bigint, text string, score double").repartition(3)
    for learn, depth in ((True, 4), (True, 6), (True, 1), (False, 4)):
        got = context_tree.score_texts(frame, F.col("doc_id") % 4 == 1 if learn else F.lit(True), depth=depth).collect()
        train = [t for d, t in docs if learn and d not in held]
        tree = PlainTree([_normal(t) for t in train], depth)
        counts = Counter(x for t in train for x in _normal(t).split() + [b"\n"])
        n, v = sum(counts.values()), len(counts)
        want = []
        for d, t in docs:
            tokens = _normal(t).split() + [b"\n"]
            base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens)
            want.append((d, d in held or not learn, len(tokens), sum(counts[x] > 0 for x in tokens), n, base, tree.log10(_normal(t))))
        key = lambda r: (r[0] is not None, r[0] or 0)
        assert len(got) == len(want)
        for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-7)
    assert context_tree.score_texts(frame.limit(0), F.lit(False)).count() == 0


def test_many_chunks_score_as_one(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(RNG.choices(["alpha", "beta", "gamma", "delta"], k=200))) for i in range(60)], "doc_id bigint, text string")
    held = F.col("doc_id") % 3 == 0
    whole = {r.doc_id: r.score for r in context_tree.score_texts(docs.repartition(1), held).collect()}
    apart = {r.doc_id: r.score for r in context_tree.score_texts(docs.repartition(6), held).collect()}
    assert whole == pytest.approx(apart, rel=1e-9)


def test_the_probabilities_of_all_bytes_sum_to_one(spark):
    texts = ["abra cadabra", "abacus", "cab"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    plain = PlainTree([_normal(t) for t in texts], 5)
    for context in (b"\n\n\n\n\n", b"\nabra", b" caba", b"zzzzz"):
        total = 0
        for byte in range(256):
            p = 1.0
            for j in range(8):
                one = plain.one((1 << j) | byte >> 8 - j, context)
                p *= one if byte >> 7 - j & 1 else 1 - one
            total += p
        assert total == pytest.approx(1)
    rows = context_tree.score_texts(frame, F.lit(False)).collect()
    assert all(r.score < 0 and r.base_score < 0 for r in rows)


def test_a_byte_sees_only_its_own_text():
    text = b"ab\nc\n\nxyzxyzxyz\n"
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    for depth in (1, 4, 6):
        want, start = [], 0
        for end in ends.tolist():
            padded = b"\n" * depth + text[start:end]
            want += [int.from_bytes(padded[i : i + depth + 1], "big") for i in range(end - start)]
            start = end
        assert context_tree.byte_keys(np.frombuffer(text, np.uint8), ends, depth).tolist() == want


def test_counts_of_a_chunk_do_not_depend_on_what_waits_or_is_sent_at_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i % 7} and more {i}" * 40) for i in range(60)], "doc_id bigint, text string").coalesce(1)
    chunks = context_tree.chunked(docs, F.col("doc_id") % 5 == 1)
    want = sorted(map(tuple, context_tree.key_counts(chunks, 5).collect()))
    for name, value in (("PIECE_BYTES", 2_000), ("HELD_KEYS", 300), ("SENT_KEYS", 70)):
        monkeypatch.setattr(context_tree, name, value)
    assert sorted(map(tuple, context_tree.key_counts(chunks, 5).collect())) == want
