"""Operator 1: packing by best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import itertools
import zlib
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tessera.llm import words as w

#: Bytes of words and their ids that a Python worker keeps cached, about.
CACHE_BYTES = 16 << 20
#: Larger chunks hold fewer distinct words in all.
CHUNK_BYTES = 4 << 20
LETTER = "[A-Za-z0-9À-ÖØ-öø-ÿ]"
_MODELS: dict[str, _Model] = {}


class BestFit:
    """Open windows by remaining capacity: a segment tree finds the tightest that fits."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.leaves = 1 << int(window).bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.open: list[deque[int]] = [deque() for _ in range(window + 1)]
        self.sequences = 0

    def _push(self, capacity: int, sequence: int) -> None:
        if not capacity:
            return
        self.open[capacity].append(sequence)
        node = self.leaves + capacity
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def _pop(self, capacity: int) -> int:
        sequence = self.open[capacity].popleft()
        node = self.leaves + capacity
        if not self.open[capacity]:
            self.filled[node] = 0
            node >>= 1
            while node and not (self.filled[2 * node] or self.filled[2 * node + 1]):
                self.filled[node] = 0
                node >>= 1
        return sequence

    def _tightest(self, length: int) -> int:
        """The least capacity of at least ``length`` with an open window, or 0."""
        node = self.leaves + length
        if self.filled[node]:
            return length
        while node > 1:
            if not node & 1 and self.filled[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return 0
        while node < self.leaves:
            node = 2 * node if self.filled[2 * node] else 2 * node + 1
        return node - self.leaves

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        capacity = self._tightest(length)
        if capacity:
            sequence = self._pop(capacity)
        else:
            capacity, sequence = self.window, self.sequences
            self.sequences += 1
        self._push(capacity - length, sequence)
        return sequence, self.window - capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of every length, and the number of sequences; ties keep their order."""
    sequence, offset, tree = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), BestFit(window)
    for i in np.argsort(-lengths, kind="stable").tolist():
        sequence[i], offset[i] = tree.place(int(lengths[i]))
    return sequence, offset, tree.sequences


@dataclass
class _Model:
    """A tokenizer and the ids of words it has met, in Arrow and numpy: a tenth of what a dict would take."""

    tokenizer: object
    words: pa.Array
    ids: np.ndarray
    starts: np.ndarray


def _model(path: str) -> _Model:
    if path not in _MODELS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _MODELS[path] = _Model(Tokenizer.from_file(path), pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(1, np.int64))
    return _MODELS[path]


def gathered(ids: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The id runs ``codes`` one after another, and their offsets."""
    lengths = np.diff(starts)[codes]
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    kind = np.int32 if max(ends[-1], len(ids)) < 1 << 31 else np.int64
    at = np.repeat((starts[codes] - ends[:-1]).astype(kind), lengths)
    at += np.arange(ends[-1], dtype=kind)
    return ids[at], ends


def piece_ids(pieces: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and offsets of distinct strings, from the worker's cache where it holds them."""
    model = _model(path)
    codes = pc.fill_null(pc.index_in(pieces, value_set=model.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    unmet = np.flatnonzero(codes < 0)
    fresh = pieces.take(pa.array(unmet))
    flat, lengths = [model.ids], [np.diff(model.starts)]
    for i in range(0, len(fresh), 4096):
        got = [e.ids for e in model.tokenizer.encode_batch_fast(fresh.slice(i, 4096).to_pylist(), add_special_tokens=False)]
        lengths.append(np.fromiter(map(len, got), np.int64, len(got)))
        flat.append(np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(lengths[-1].sum())))
    ids, starts = np.concatenate(flat), np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    codes[unmet] = len(model.words) + np.arange(len(unmet))
    out = gathered(ids, starts, codes)
    if len(unmet) and model.words.nbytes + model.ids.nbytes + model.starts.nbytes < CACHE_BYTES:
        model.words, model.ids, model.starts = pa.concat_arrays([model.words, fresh]), ids, starts
    return out


def word_ids(uniques: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and offsets of words.

    No id spans white space, the tokenizer lower-cases, and a sentence mark after a letter or digit
    starts a token of its own; so words are tokenised apart, in lower case and without such marks.
    """
    lower = pc.ascii_lower(uniques)
    stems = pc.replace_substring_regex(lower, f"({LETTER})[.,;:!?]+$", r"\1")
    marks = pc.if_else(pc.equal(lower, stems), "", pc.replace_substring_regex(lower, f"^(?s:.*{LETTER})([.,;:!?]+)$", r"\1"))
    stems, marks = stems.dictionary_encode(), marks.dictionary_encode()
    pieces = pa.concat_arrays([stems.dictionary, marks.dictionary]).dictionary_encode()
    ids, starts = piece_ids(pieces.dictionary, path)
    which = pieces.indices.to_numpy()
    codes = np.stack([which[stems.indices.to_numpy()], which[marks.indices.to_numpy() + len(stems.dictionary)]], axis=1).ravel()
    flat, ends = gathered(ids, starts, codes)
    return flat, ends[::2]


def token_stream(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by ``end_id``, and the offsets of the texts."""
    words = w.split(texts)
    ids, starts = word_ids(words.uniques, path)
    ids, starts = np.append(ids, np.uint32(end_id)), np.append(starts, len(ids) + 1)
    codes = np.insert(words.codes, words.offsets[1:], len(words.uniques))
    flat, ends = gathered(ids, starts, codes)
    return flat, ends[words.offsets + np.arange(len(words.offsets))]


def pack_documents(docs: DataFrame, tokenizer_path: str, *, window: int = 2048, end_id: int = 1, buffer_tokens: int = 1 << 24, with_ids: bool = False) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most ``window`` tokens.

    Every task reads its own rows once: it tokenises, cuts documents longer than the window into
    full windows and a rest, and packs each ``buffer_tokens`` of pieces by best-fit decreasing, so
    memory is bounded and nothing is shuffled.  A buffer holds thousands of sequences; only its
    last ones may stay partly empty.  Sequence ids join the partition and a counter, so a task that
    is run again on the same rows gives the same ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, seq_tokens
    (the sequence's tokens), padded_to (seq_tokens if a power of two, else ``window``) and, with
    ``with_ids``, the ids themselves.  Null and empty texts are one piece holding ``end_id``;
    repeated rows are packed each; an empty table gives no rows.
    """
    kinds = [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "seq_tokens", "padded_to")), *([("ids", pa.list_(pa.int32()))] if with_ids else [])]
    schema = pa.schema(kinds)

    def packed(pieces: list[tuple], base: int):
        doc, null, start, length, crc, total = (np.concatenate([x[k] for x in pieces]) for k in range(6))
        sequence, offset, n = best_fit_decreasing(length, window)
        used = np.bincount(sequence, weights=length, minlength=n).astype(np.int64)[sequence]
        padded = np.where(used & (used - 1), window, used)
        columns = [pa.array(doc, pa.int64(), mask=null), *map(pa.array, (start, length, crc, total, sequence + base, offset, used, padded))]
        if with_ids:
            flat = np.concatenate([x[6] for x in pieces]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), flat))
        return n, pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        base, held, pieces = TaskContext.get().partitionId() << 32, 0, []
        for batch in w.chunks(batches, most=CHUNK_BYTES):
            ids, offsets = token_stream(w.texts_of(batch), tokenizer_path, end_id)
            total = np.diff(offsets)
            cuts = -(-total // window)
            doc = np.repeat(np.arange(len(total)), cuts)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * window
            length = np.minimum(window, total[doc] - start)
            at, raw = offsets[doc] + start, memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = np.fromiter((zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)), np.int64, len(at))
            key = batch.column("doc_id")
            pieces.append((key.fill_null(0).to_numpy()[doc], key.is_null().to_numpy(zero_copy_only=False)[doc], start, length, crc, total[doc], *([ids] if with_ids else [])))
            held += len(ids)
            if held >= buffer_tokens:
                n, out = packed(pieces, base)
                base, held, pieces = base + n, 0, []
                yield out
        if pieces:
            yield packed(pieces, base)[1]

    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(w.releasing(run), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, seq_tokens bigint, padded_to bigint" + (", ids array<int>" if with_ids else ""))
