"""Operators 2, 3, 5, 6, 7 and 9 against plain versions, edge cases of every stage, and queries against SQL."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tessera.llm import decontaminate, language, lines, packing, queries, quality, secrets, toxicity
from tessera.llm import words as w
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
RNG = random.Random(23)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SMALL).select(*sorted(want.columns))
    rows = lambda x: sorted((tuple(r) for r in x), key=str)
    assert rows(df.collect()) == rows(want.select(*(f'"{c}"' for c in sorted(want.columns))).fetchall())


def _plain_mixture(logs: np.ndarray, model: language.LanguageModel) -> np.ndarray:
    """One text's language shares, a word at a time; logs: one row per word."""
    ratios = [[max(math.exp(x - max(row)), model.floor) for x in row] for row in logs]
    n, k = len(ratios), len(model.languages)

    def em(support):
        share = [1 / len(support) if i in support else 0.0 for i in range(k)]
        for _ in range(model.rounds):
            got = np.zeros(k)
            for row in ratios:
                each = [a * b for a, b in zip(row, share)]
                got += np.array(each) / sum(each)
            share = (got / n).tolist()
        return share, sum(math.log(sum(a * b for a, b in zip(row, share))) for row in ratios)

    full, _ = em(range(k))
    order = sorted(range(k), key=lambda i: -full[i])
    singles = [sum(math.log(row[i]) for row in ratios) for i in range(k)]
    best, chosen = max(singles), np.eye(k)[int(np.argmax(singles))]
    for size in range(2, k + 1):
        share, value = em(order[:size])
        value -= model.penalty * (size - 1) * math.log(n + 1) / 2
        if value > best:
            best, chosen = value, np.array(share)
    return chosen


def test_language_mixtures_are_the_plain_ones():
    rng = np.random.default_rng(4)
    model = language.LanguageModel(["a", "b", "c"], np.log(rng.dirichlet(np.full(1 << language.BUCKET_BITS, 0.02), 3).T + 1e-7))
    known = ["".join(RNG.choices("abcdefghijkl", k=RNG.randint(2, 7))) for _ in range(60)]
    texts = [" ".join(RNG.choices(known[: RNG.choice([10, 60])], k=RNG.choice([1, 4, 30, 90]))) for _ in range(25)]
    words = w.split(pa.array(texts))
    logs, _ = model.word_logs(words.uniques)
    got = model.mixtures(words)
    for i, row in enumerate(got):
        assert np.allclose(row, _plain_mixture(logs[words.codes[words.offsets[i] : words.offsets[i + 1]]], model), atol=2e-3)
    assert (model.main(words) == [int(np.log(np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), model.floor))[words.codes[a:b]].sum(axis=0).argmax()) for a, b in zip(words.offsets, words.offsets[1:])]).all()


def _plain_diagonals(text: str, item: str) -> dict[int, tuple[int, list[bool]]]:
    """By shift, for every diagonal that a mask hits: where it begins in the item, and which words are equal."""
    norm = lambda t: [x for x in (re.sub(r"[\W_]+", "", y.lower()) for y in brute.words(t)) if x]
    a, b = norm(text), norm(item)
    masks = decontaminate.MASKS if len(b) >= min(map(len, decontaminate.MASKS)) else ("1" * len(b),)
    out = {}
    for mask in masks:
        at = defaultdict(list)
        keep = [i for i, m in enumerate(mask) if m == "1"]
        for j in range(len(b) - len(mask) + 1):
            at[tuple(b[j + i] for i in keep)].append(j)
        for i in range(len(a) - len(mask) + 1):
            for j in at[tuple(a[i + x] for x in keep)]:
                first, last = max(0, j - i), min(len(b), len(a) - i + j)
                out[i - j] = first, [a[i - j + x] == b[x] for x in range(first, last)]
    return out


def _check_overlaps(found: list, text: str, item: str, least: int, identity: float) -> int:
    """Each found one (doc_start, item_start, length, matches) is a segment that counts, those of a diagonal
    are disjoint, and no segment that counts lies apart from them; the number of diagonals with one."""
    by, whole = defaultdict(list), _plain_diagonals(text, item)
    for d, i, n, m in found:
        by[d - i].append((i, i + n, m))
    size = sum(1 for y in brute.words(item) if re.sub(r"[\W_]+", "", y))
    least, share = min(least, size), identity if size >= min(map(len, decontaminate.MASKS)) else 1
    assert set(by) <= set(whole)
    for shift, (first, same) in whole.items():
        parts = sorted((a - first, b - first, m) for a, b, m in by[shift])
        assert all(m == sum(same[a:b]) >= share * (b - a) and b - a >= least for a, b, m in parts)
        assert all(x[1] <= y[0] for x, y in zip(parts, parts[1:]))
        total = [0, *np.cumsum(same).tolist()]
        for a in range(len(same)):
            for b in range(a + least, len(same) + 1):
                if total[b] - total[a] >= share * (b - a):
                    assert any(a < y and x < b for x, y, _ in parts), (shift, a, b)
    return sum(map(bool, by.values()))


def test_overlaps_are_the_plain_ones(spark):
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(RNG.choices(vocabulary, k=n)) for n in (3, 14, 25, 40)] + ["the of " * 12, "same " * 15, "", "!!"]
    docs = [(900, "same " * 40), (901, "x " + "the of " * 30), (902, None), (903, "?"), (904, "the the of " * 9)]
    for i in range(60):
        x = RNG.choices(vocabulary, k=RNG.choice([0, 5, 40]))
        if i % 2:
            piece = RNG.choice(items[:4]).split()
            for _ in range(RNG.choice([0, 1, 3, 6])):
                piece[RNG.randrange(len(piece))] = "x" + str(RNG.randrange(99))
            x[len(x) // 2 : len(x) // 2] = piece * RNG.choice([1, 1, 2])
        docs.append((i, " ".join(x)))
    found = decontaminate.find_overlaps(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"))
    got = defaultdict(list)
    for r in found.collect():
        assert list(r.overlaps) == sorted(r.overlaps)
        for x in r.overlaps:
            got[r.doc_id, x.item_id].append(tuple(x)[1:])
    assert sum(_check_overlaps(got[d, i], t or "", item, 12, 0.75) for d, t in docs for i, item in enumerate(items)) > 60


def test_short_windows_with_substitutions_are_found():
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [RNG.choices(vocabulary, k=RNG.randint(20, 60)) for _ in range(100)]
    block = decontaminate.build_block(list(range(100)), [" ".join(x) for x in items])
    docs, want = [], []
    for _ in range(2000):
        i, n = RNG.randrange(100), RNG.randint(12, 16)
        at = RNG.randrange(len(items[i]) - n)
        window = items[i][at : at + n]
        for p in RNG.sample(range(n), RNG.choice([1, 2])):
            window[p] = "changed"
        docs.append(" ".join([*RNG.choices(vocabulary, k=30), *window, *RNG.choices(vocabulary, k=30)]))
        want.append((i, 30, 30 + n))
    found = decontaminate.overlaps_of(decontaminate.normal_words(pa.array(docs)), block, 12, 0.75)
    assert all(any(x["item_id"] == i and x["doc_start"] < b and x["doc_start"] + x["length"] > a for x in got) for (i, a, b), got in zip(want, found))


def test_repetitive_texts_cost_their_diagonals():
    block = decontaminate.build_block([1], ["the " * 300])
    (found,) = decontaminate.overlaps_of(decontaminate.normal_words(pa.array(["the " * 4000])), block, 12, 0.75)
    assert len(found) == 4000 + 300 - 1 - 2 * 11 and all(x["matches"] == x["length"] for x in found)


def test_overlaps_survive_substitutions():
    item = [f"t{i}" for i in range(40)]
    block = decontaminate.build_block([1], [" ".join(item)])
    found = {}
    for changes in (0, 2, 4, 6, 8):
        hits = 0
        for _ in range(200):
            x = list(item)
            for at in RNG.sample(range(40), changes):
                x[at] = "changed"
            words = decontaminate.normal_words(pa.array([" ".join(["a", "b", *x, "c"])]))
            hits += bool(decontaminate.overlaps_of(words, block, 12, 0.75)[0])
        found[changes] = hits / 200
    assert found[0] == found[2] == 1 and found[4] >= 0.98 and found[6] >= 0.9


def test_scores_are_the_plain_ones():
    known = language.LanguageModel([], np.zeros((1 << language.BUCKET_BITS, 0)))
    rng = np.random.default_rng(1)
    texts = [" ".join(RNG.choices(["sun", "rain", "bad", "awful", "tree", "No,"], k=RNG.choice([0, 1, 2, 9, 40]))) for _ in range(80)]
    model = toxicity.fit([t + (" awful bad" if i % 2 else "") for i, t in enumerate(texts)], np.arange(80) % 2, known, epochs=2)
    got = model.raw(pa.array(texts))
    for text, p in zip(texts, got):
        x = [re.sub(r"^\W+|\W+$", "", y.lower()) for y in text.split()]
        emb = model.embed(pa.array(x, pa.string())) if x else np.zeros((0, 16))
        top = []
        for k, f in enumerate(model.filters):
            acts = [sum(emb[s + j] @ f[j] if s + j < len(x) else 0 for j in range(len(f))) for s in range(len(x))]
            top.append(np.maximum(np.max(acts, axis=0) + model.bias[k], 0) if acts else np.zeros(f.shape[2]))
        assert p == pytest.approx(1 / (1 + math.exp(-float(np.concatenate(top) @ model.out + model.out_bias))), abs=1e-4)
    assert rng is not None


def test_labels_in_conflict_and_bounds(spark):
    known = language.LanguageModel([], np.zeros((1 << language.BUCKET_BITS, 0)))
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(i, ("vile " if i % 2 else "mild ") * 30) for i in ids] * 2, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(ids[0], 1), (ids[0], 0), (None, 1), (999, None)], "doc_id bigint, toxic int")
    model = toxicity.train_toxicity(docs, labels, known, max_bytes=9_000)
    rows = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([rows[i] == i % 2 for i in ids]) > 0.9


def test_a_long_text_of_many_assignments(spark):
    text = " ".join(f'token="abc{i:06d}"' for i in range(20_000))
    rows = secrets.find_secrets(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id bigint, text string"), secrets.train_markov([(x, 1) for x in secrets.random_strings(200)] + [("ordinary_name", 0)]))
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in rows.collect()}
    assert got == {1: (20_000, 0, 0), 2: (0, 0, 0), 3: (0, 0, 0)}
    taken = secrets.merged([(0, 0, 5, ""), (3, 1, 9, ""), (20, 0, 22, "")])
    assert taken == ([0, 20], [9, 22])
    for a in range(25):
        assert secrets.meets(taken, a, a + 2) == any(p < a + 2 and a < q for p, q in zip(*taken))


def test_gibberish_goes_and_prose_stays(spark):
    rng = random.Random(8)
    stems = ["".join(rng.choices("abcdefghilmnoprstuv", k=rng.randint(2, 8))) for _ in range(150)]
    prose = [(i, " ".join(rng.choices(stems, k=120)), "en") for i in range(400)]
    noise = [(1000 + i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(120)), "en") for i in range(20)]
    rows = {r.doc_id: r.kept for r in quality.apply_quality_rules(spark.createDataFrame(prose + noise, "doc_id bigint, text string, lang string").repartition(3)).collect()}
    assert np.mean([rows[i] for i in range(400)]) >= 0.97 and np.mean([not rows[1000 + i] for i in range(20)]) >= 0.9


def test_empty_tables_of_every_operator_and_stage(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = language.train_languages(none)
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert packing.pack_documents(none, queries.tokenizer_path()).count() == 0
    assert language.identify_languages(none, model).count() == 0
    assert secrets.find_secrets(none, secrets.train_markov(secrets.labelled_samples(none))).count() == 0
    assert decontaminate.find_overlaps(none, spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")).count() == 0
    assert toxicity.score_toxicity(none, toxicity.train_toxicity(none, labels, model)).count() == 0
    assert quality.apply_quality_rules(none).count() == 0 and lines.dedup_lines(none).count() == 0
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_documents_of_many_lines(spark):
    rows = [(i, "\n".join([f"Line {k}" for k in range(20_000)] + [f"own {i} {k % 50}" for k in range(20_000)])) for i in range(11)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in lines.dedup_lines(df, least_docs=10).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()]
    assert sorted(got) == sorted(brute.dedup_lines(rows, 10)) and got[0][2] == 20_000


def test_a_failed_run_leaves_no_tables(spark, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(lines, "drop_lines", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lines.dedup_lines(spark.createDataFrame([(1, "a\nb")], "doc_id bigint, text string"))
    assert {t.name for t in spark.catalog.listTables()} == before
