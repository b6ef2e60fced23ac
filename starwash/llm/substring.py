"""Repeated word sequences: fixed-block anchors, probed by every rolling window, extended to exact repeats.

Every document is cut into blocks of ``block`` words that do not overlap: the reference blocks. A sequence of
``window`` >= 2 * block - 1 words that occurs twice holds a reference block of one occurrence, so the other
is found when its rolling windows of ``block`` words are probed. Around the hits all windows are formed, their
first occurrence is found the same way, and those that are not it are merged into maximal runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starwash.llm.batches import (
    DOC_AND_CHECK, NULL_ID, Batch, as_tables, asked_and_answered, bits_of, grouped, in_smaller_document,
    later_ones, n_parts, opened, pack,
)
from starwash.llm.hashing import BYTE_VALUES, Windows, mixed

WINDOW = 20
SEGMENT = 1 << 18  # bytes that are hashed at a time

IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True

PROBE, REPEAT = 0, 1  # kinds of questions

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()),
])


class Words:
    """Words of a batch: hash, row (document's place in the batch) and place in the document."""

    def __init__(self, batch: Batch) -> None:
        data = np.frombuffer(batch.data, dtype=np.uint8)
        solid = ~IS_BLANK[data]
        border = np.zeros(len(data) + 1, dtype=bool)
        border[batch.starts] = True
        first = solid & (border[:-1] | np.concatenate([[True], ~solid[:-1]]))
        last = solid & (border[1:] | np.concatenate([~solid[1:], [True]]))
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(batch.starts, starts, "right") - 1
        self.bounds = np.searchsorted(self.row, np.arange(len(batch.ids) + 1))  # first word of each row
        self.place = np.arange(len(starts)) - self.bounds[self.row]
        self.left = self.bounds[self.row + 1] - np.arange(len(starts))  # words from here to the document's end
        self.hashes = np.empty(len(starts), dtype=np.uint64)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + SEGMENT, "right")))
            part = Windows(BYTE_VALUES[data[starts[at] : ends[to - 1]]])
            self.hashes[at:to] = part.hashes(starts[at:to] - starts[at], ends[at:to] - starts[at])
            at = to
        self.windows = Windows(self.hashes)

    def of_length(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(start word, hash) of all windows of ``n`` words inside a document."""
        h = self.windows.all(n)
        inside = np.flatnonzero(self.left[: len(h)] >= n)
        return inside, h[inside]


def _probes(words: Words, block: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Every distinct rolling window; note: bit 0 a reference block of the batch, bit 1 more than once in it."""
    at, h = words.of_length(block)
    keys, order, starts = grouped(h)
    reference = np.logical_or.reduceat(words.place[at][order] % block == 0, starts) if len(keys) else np.empty(0, bool)
    often = np.diff(np.append(starts, len(h))) > 1
    yield PROBE, keys, reference.astype(np.uint8) | often.astype(np.uint8) << 1


def _is_hit(inverse: np.ndarray, notes: np.ndarray) -> np.ndarray:
    """The words of this window are a reference block somewhere, and occur more than once."""
    n = inverse.max(initial=-1) + 1
    reference = np.bincount(inverse, weights=notes & 1, minlength=n) > 0
    often = np.bincount(inverse, weights=1 + (notes >> 1), minlength=n) > 1
    return (reference & often)[inverse]


def _candidates(words: Words, answers: list, block: int, window: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of the windows that hold a hit."""
    at, h = words.of_length(block)
    keys, order, starts = grouped(h)
    hit = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    flags = np.repeat(bits_of(answers, PROBE, keys, parts), np.diff(np.append(starts, len(h))))
    hit[at[order] + 1] = flags
    until = np.cumsum(hit)
    where, code = words.of_length(window)
    holds = until[where + window - block + 1] > until[where]
    return where[holds], code[holds]


def _removed(words: Words, batch: Batch, answers: list, block: int, window: int, parts: int) -> np.ndarray:
    """Mask of the words covered by a window that starts earlier elsewhere, too."""
    where, code = _candidates(words, answers, block, window, parts)
    keys, order, starts = grouped(code)
    later = later_ones(order, starts, words.row[where], batch.ids, bits_of(answers, REPEAT, keys, parts))
    change = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    np.add.at(change, where[later], 1)
    np.add.at(change, where[later] + window, -1)
    return np.cumsum(change)[:-1] > 0


def remove_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    A word goes when a window of ``window`` words covers it whose words also start earlier: in a smaller
    doc_id, or earlier in the same document. Null and empty texts have no words. A null doc_id comes after
    all others; rows that share an id are not earlier than each other; an empty table gives an empty result. A very
    long text is a batch of its own, read whole. Other columns, whatever their names, are left out.
    Windows are compared by 96 bits of hash.
    """
    block, batches = (window + 1) // 2, pack(docs)
    parts = n_parts(batches, 6)  # a key for every word

    def probes(batch: Batch, answers: list) -> Iterator[tuple]:
        yield from _probes(Words(batch), block)

    def repeats(batch: Batch, answers: list) -> Iterator[tuple]:
        words = Words(batch)
        where, code = _candidates(words, answers, block, window, parts)
        keys, order, starts = grouped(code)
        first = where[order[starts]]
        notes = np.empty(len(keys), dtype=DOC_AND_CHECK)
        notes["doc"] = batch.ids[words.row[first]]
        second = Windows(mixed(words.hashes, salt=window))
        notes["check"] = second.hashes(first, first + window) >> np.uint64(32)
        yield REPEAT, keys, notes

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, batch, answers in opened(tables):
                words = Words(batch)
                gone = _removed(words, batch, answers, block, window, parts)
                edges = np.concatenate([[False], gone[:-1]])
                for i, doc_id in enumerate(batch.ids.tolist()):
                    a, b = int(words.bounds[i]), int(words.bounds[i + 1])
                    own = gone[a:b]
                    text = batch.data[batch.starts[i] : batch.starts[i + 1]].split()
                    if own.any():
                        text = [text[k] for k in np.flatnonzero(~own)]
                    spans = int((own & ~edges[a:b]).sum()) + int(b > a and own[0] and edges[a])
                    digest = hashlib.sha256(b" ".join(text)).hexdigest()
                    yield None if doc_id == NULL_ID else doc_id, b - a, int(own.sum()), spans, digest

        yield from as_tables(rows(), RESULT, 4096)

    batches = asked_and_answered(batches, probes, {PROBE: (_is_hit, "u1")}, parts, "answer1")
    batches = asked_and_answered(batches, repeats, {REPEAT: (in_smaller_document, DOC_AND_CHECK)}, parts, "answer2")
    return batches.mapInArrow(cut, "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string")
