"""Operator 12: spelling variants through forward and backward minimal acyclic automata."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import words as w
from tessera.llm.lines import LOWER, UPPER
from tessera.llm.shared import discard, written

#: What lies between runs of letters.
BETWEEN = "[^A-Za-zÀ-ÿ]+"
#: Symbols of groups lie above all code points.
_GROUP = 0x110000
_SYMBOLS = 1 << 32
#: Queries whose half-finished matches are held at once.
_SLICE = 4096
_BEST = "word string, n_near bigint, form string, form_n bigint"


# ---------------------------------------------------------------- automata


@dataclass
class Automaton:
    """A minimal acyclic automaton over sorted strings of symbols.

    ``keys`` are the transitions, state * _SYMBOLS + symbol, sorted; ``targets`` where they lead and
    ``skips`` how many strings come before those that pass through, so the skips along a string add up
    to its number: its place among all strings.
    """

    root: int
    final: np.ndarray
    first: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    skips: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the transition, whether there is one) for every state and symbol."""
        wanted = states * _SYMBOLS + symbols
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        return at, self.keys[at] == wanted if len(self.keys) else np.zeros(len(wanted), bool)


def build(symbols: np.ndarray, offsets: np.ndarray) -> Automaton:
    """The automaton of different strings in order; string i is ``symbols[offsets[i]:offsets[i + 1]]``.

    A trie is laid out level by level.  From the last level up every node gets a hash of its
    right language, and nodes of one hash become one state.
    """
    lengths = np.diff(offsets)
    node = np.zeros(len(lengths), np.int64)
    levels, total = [], 1
    ends = [node[lengths == 0]]
    for depth in range(int(lengths.max(initial=0))):
        live = np.flatnonzero(lengths > depth)
        parent, symbol = node[live], symbols[offsets[live] + depth]
        new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (symbol[1:] != symbol[:-1])])
        node[live] = total - 1 + np.cumsum(new)
        levels.append((parent[new], symbol[new], total))
        total += int(new.sum())
        ends.append(node[live[lengths[live] == depth + 1]])
    final = np.zeros(total, bool)
    final[np.concatenate(ends)] = True
    language = np.where(final, np.uint64(0x5851F42D4C957F2D), np.uint64(1))
    count = final.astype(np.int64)
    for parent, symbol, base in reversed(levels):
        child = slice(base, base + len(parent))
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        language[parent[starts]] += np.add.reduceat(w.mix(w.mix(symbol.astype(np.uint64)) ^ w.mix(language[child])), starts)
        count[parent[starts]] += np.add.reduceat(count[child], starts)
    _, kept, state = np.unique(language, return_index=True, return_inverse=True)
    parent, symbol, child = (np.concatenate(x) for x in zip(*((p, s, np.arange(b, b + len(p))) for p, s, b in levels), strict=True)) if levels else (np.zeros(0, np.int64),) * 3
    own = kept[state[parent]] == parent
    keys, child = state[parent[own]] * _SYMBOLS + symbol[own], child[own]
    order = np.argsort(keys)
    keys, child = keys[order], child[order]
    first = np.searchsorted(keys, np.arange(len(kept) + 1) * _SYMBOLS)
    before = np.concatenate([[0], np.cumsum(count[child])])
    source = keys // _SYMBOLS
    skips = before[:-1] - before[first[source]] + final[kept][source]
    return Automaton(int(state[0]), final[kept], first, keys, state[child], skips)


def one_error(automaton: Automaton, symbols: np.ndarray, offsets: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, number) of every accepted string that equals the query in its first ``exact`` symbols and
    differs from the rest by one inserted, deleted or replaced symbol; each pair once."""
    n = len(offsets) - 1
    found = [np.zeros((0, 2), np.int64)]
    for start in range(0, n, _SLICE):
        q = np.arange(start, min(n, start + _SLICE))
        at, end = offsets[q], offsets[q + 1]
        state, number, stop = np.full(len(q), automaton.root), np.zeros(len(q), np.int64), offsets[q] + exact[q]
        while True:  # the half that must match
            live = np.flatnonzero(at < stop)
            if not len(live):
                break
            edge, ok = automaton.step(state[live], symbols[at[live]])
            state[live], number[live], at[live] = automaton.targets[edge], number[live] + automaton.skips[edge], at[live] + 1
            keep = np.ones(len(q), bool)
            keep[live[~ok]] = False
            q, at, end, state, number, stop = (x[keep] for x in (q, at, end, state, number, stop))
        off = [np.zeros(0, np.int64) for _ in range(5)]  # query, position, end, state, number: one error behind them
        while len(q) or len(off[0]):
            off = _advance(automaton, symbols, off, found)
            edges = automaton.first[state + 1] - automaton.first[state]
            which = np.repeat(np.arange(len(q)), edges)
            edge = np.arange(len(which)) - np.repeat(np.cumsum(edges) - edges, edges) + automaton.first[state[which]]
            inside = np.flatnonzero(at < end)
            other = np.flatnonzero(at[which] < end[which])
            other = other[automaton.keys[edge[other]] % _SYMBOLS != symbols[at[which[other]]]]
            extra = (q[which], at[which], end[which], automaton.targets[edge], number[which] + automaton.skips[edge])
            replaced = (q[which[other]], at[which[other]] + 1, end[which[other]], automaton.targets[edge[other]], number[which[other]] + automaton.skips[edge[other]])
            missing = (q[inside], at[inside] + 1, end[inside], state[inside], number[inside])
            off = [np.concatenate(x) for x in zip(off, extra, replaced, missing, strict=True)]
            edge, ok = automaton.step(state[inside], symbols[at[inside]])
            keep = inside[ok]
            q, at, end, state, number = q[keep], at[keep] + 1, end[keep], automaton.targets[edge[ok]], number[keep] + automaton.skips[edge[ok]]
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _advance(automaton: Automaton, symbols: np.ndarray, off: list[np.ndarray], found: list[np.ndarray]) -> list[np.ndarray]:
    """One exact symbol on; matches that end in a final state are found."""
    q, at, end, state, number = off
    done = (at == end) & automaton.final[state]
    found.append(np.stack([q[done], number[done]], axis=1))
    q, at, end, state, number = (x[at < end] for x in off)
    edge, ok = automaton.step(state, symbols[at])
    return [q[ok], at[ok] + 1, end[ok], automaton.targets[edge[ok]], number[ok] + automaton.skips[edge[ok]]]


def _flat(strings: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of the strings, each behind its group's symbol."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    symbols = np.frombuffer("".join(f"\0{x}" for x in strings).encode("utf-32-le"), np.uint32).astype(np.int64)
    symbols[offsets[:-1]] = _GROUP + groups
    return symbols, offsets


def nearest(rows: pa.Table) -> pa.Table:
    """What one bucket of halves tells about its queries: how many near words, and the best of them.

    ``rows`` (back, half, part, word, n, asks): the words that a half may lead to, and those that ask for it.
    """
    out = []
    for back in (False, True):
        part = rows.filter(pc.equal(rows.column("back"), back))
        half, number, word, n = (part.column(x).to_pylist() for x in ("half", "part", "word", "n"))
        place = list(zip(half, number, strict=True))
        asks = part.column("asks").to_numpy()
        if not asks.any():
            continue
        groups = {x: k for k, x in enumerate(sorted(set(place)))}
        turned = [x[::-1] for x in word] if back else word
        stored = sorted((groups[place[i]], turned[i], word[i], n[i]) for i in np.flatnonzero(~asks).tolist())
        if not stored:
            continue
        automaton = build(*_flat([x[1] for x in stored], np.array([x[0] for x in stored])))
        names, counts = [x[2] for x in stored], np.array([x[3] for x in stored])
        rank = np.zeros(len(names), np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        queries = np.flatnonzero(asks).tolist()
        symbols, offsets = _flat([turned[i] for i in queries], np.array([groups[place[i]] for i in queries]))
        exact = np.array([1 + len(half[i]) for i in queries])
        q, number = one_error(automaton, symbols, offsets, exact)
        if back:  # the forward automaton has found those that also share the first half
            fresh = np.array([not names[k].startswith(word[queries[i]][: len(word[queries[i]]) // 2]) for i, k in zip(q.tolist(), number.tolist(), strict=True)], bool)
            q, number = q[fresh], number[fresh]
        order = np.lexsort((rank[number], -counts[number], q))
        q, number = q[order], number[order]
        starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        best = number[starts]
        near = np.diff(np.concatenate([starts, [len(q)]]))
        out.append(pa.table({"word": pa.array([word[queries[i]] for i in q[starts].tolist()], pa.string()), "n_near": pa.array(near, pa.int64()), "form": pa.array([names[k] for k in best.tolist()], pa.string()), "form_n": pa.array(counts[best] if len(best) else [], pa.int64())}))
    empty = pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "form": pa.array([], pa.string()), "form_n": pa.array([], pa.int64())})
    return pa.concat_tables([empty, *out])


# ---------------------------------------------------------------- on Spark


def count_words(docs: DataFrame, *, one_in: int = 97, least_chars: int = 5, least_n: int = 3) -> DataFrame:
    """(word, n): the letter runs of whole texts, A-Z in lower case, with how often they occur.

    A run whose checksum with its doc_id is divisible by ``one_in`` loses one character, which plants
    misspellings.  Null texts have no run; a null doc_id counts as empty.
    """
    text = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), BETWEEN, -1)
    # Not explode: it filters by the array's size first and so computes it twice.
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode_outer(text).alias("run")).filter(F.char_length("run") >= least_chars)
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run")).withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    gone = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_n)


def halves(words: DataFrame, slice_words: int) -> DataFrame:
    """(back, half, part, word, n, asks): where each word is stored, and where it asks for near words.

    A word of length L asks at its first L // 2 characters and, backwards, at the others.  A near word
    has length L - 1, L or L + 1 and shares one of the two, so it is stored at the halves that words of these lengths have.  A half at which over ``slice_words`` words are stored is split in parts by the
    word's hash, and its queries go to every part.
    """
    size = F.char_length("word")
    lengths = F.array(size - 1, size, size + 1)
    front = F.array_distinct(F.transform(lengths, lambda x: F.floor(x / 2).cast("int")))
    back = F.array_distinct(F.transform(lengths, lambda x: F.ceil(x / 2).cast("int")))

    def sided(kind: bool, cut: Column) -> Column:
        text = F.expr("right(word, k)") if kind else F.expr("left(word, k)")
        return words.select("word", "n", F.explode(cut).alias("k")).filter(F.col("k") <= size).select(F.lit(kind).alias("back"), text.alias("half"), "word", "n")

    stored = sided(False, front).unionByName(sided(True, back))
    asking = sided(False, F.array(F.floor(size / 2).cast("int"))).unionByName(sided(True, F.array(F.ceil(size / 2).cast("int"))))
    large = stored.groupBy("back", "half").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > slice_words)
    large = large.select("back", "half", F.ceil(F.col("m") / slice_words).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    stored = stored.join(large, ["back", "half"], "left").withColumns({"part": F.pmod(F.xxhash64("word"), parts).cast("int"), "asks": F.lit(False)})
    asking = asking.join(large, ["back", "half"], "left").withColumns({"part": F.explode(F.sequence(F.lit(0), parts - 1)), "asks": F.lit(True)})
    columns = ["back", "half", "part", "word", "n", "asks"]
    return stored.select(*columns).unionByName(asking.select(*columns))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the end of the chain of forms.

    The reach of every pointer doubles in each round; since counts rise along a chain, none is longer
    than a few dozen words.
    """
    reached = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(reached)
        reached = now
        if reached.filter("moved").isEmpty():
            return reached.select("word", "root")


def group_spellings(words: DataFrame, *, least_ratio: int = 2, bucket_words: int = 20_000, slice_words: int = 20_000) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n.

    Words are near if they differ by exactly one inserted, deleted or replaced code point.  A word's form
    is its near word of largest n, the smaller in code-point order of equals, if that has
    ``least_ratio`` times the word's n; its root is where the forms lead.  ``n_near`` counts all near
    words.

    Either half of a word is left whole by one error.  Words meet by that half in buckets of about
    ``bucket_words``; each builds a minimal automaton of its words and one of its words reversed, whose
    perfect-hash numbers lead to the counts, matches the half exactly and completes with one error.
    Each query leaves a bucket as one row, not as pairs; those that both directions find count forwards.

    Null and empty words are left out, repeated rows of a word are one (their n added), ties as above,
    words may be of any length, an empty table gives no row, other columns are not read.
    """
    words = written(words.select(F.col("word").cast("string").alias("word"), F.col("n").cast("long").alias("n")).filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n")), "words")
    met = halves(words, slice_words)
    buckets = max(1, -(-4 * words.count() // bucket_words))
    met = met.withColumn("bucket", F.pmod(F.xxhash64("back", "half", "part"), F.lit(buckets)))
    best = met.groupBy("bucket").applyInArrow(nearest, _BEST)
    best = written(best.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("x")), "near")
    found = words.join(best, "word", "left")
    strong = -F.col("x.less") >= least_ratio * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("x.form")).alias("form"), F.when(strong, -F.col("x.less")).alias("form_n")), "forms")
    discard(words, best)
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

