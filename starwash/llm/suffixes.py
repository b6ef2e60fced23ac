"""Repeated byte strings by bucket-pointer refinement of sampled text suffixes.

* Sampling. Of the q-grams inside a string of ``length`` bytes one is chosen by a random order on q-grams.
  Equal strings choose the same, so it is enough to sort the suffixes that some string chose, about one in 35.
* Initial buckets, depth q: suffixes are sorted by the bucket of their q-gram. One alone in its bucket is settled,
  nothing else holds such a string.
* Refinement by blocks: within a bucket suffixes are sorted by the buckets at later offsets, first those of the
  block around them, all strings that chose them. Suffixes whose block starts in a smaller place are settled: all
  their strings are repeats. So are the first of a block that is the only one of its bucket.
* Refinement by strings: what is left, the first suffix of each of several blocks in a bucket, string by string.

A bucket's identifier at depth 2d is made of the identifiers at depth d of a place and of the place d later, and
these again of those below, down to the q-gram buckets; a depth in between takes two that overlap. Identifiers are
64-bit hashes of those pairs and no ranks, so one holds in every batch and no batch has to send its ranks to others
after each doubling; suffixes of a bucket are sorted by them, which puts equal ones together and is all that finding
repeats needs. Only buckets with several members are refined. Equal identifiers are checked by a second hash of the
bytes themselves.
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

LENGTH = 100
Q_GRAM = 32
SEGMENT = 1 << 18  # strings whose suffixes are chosen at a time
POSITION_BITS = 19  # of a place in a segment and the string that starts last in it

BUCKET, BLOCK, ALONE, STRING = 0, 1, 2, 3  # kinds of questions

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()),
])


def _chosen(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest (leftmost of equals) of each ``width`` hashes in a row, one segment at most.

    Hashes are compared without their lowest bits, which hold the position: as many in every segment, so that equal
    strings choose alike wherever they lie.
    """
    low = np.uint64((1 << POSITION_BITS) - 1)
    best = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < width:
        best = np.minimum(best[: len(best) - (width - have)], best[width - have :])
    return (best & low).astype(np.int64)


class Identifiers:
    """Identifiers of the buckets of strings of any length from ``q``, refined from those of the q-grams.

    ``names`` has the q-gram bucket of every place. Deeper ones are made for the places asked for only.
    """

    def __init__(self, names: np.ndarray, q: int) -> None:
        self.names, self.q = names, q

    def at_depth(self, places: np.ndarray, doublings: int) -> np.ndarray:
        """Bucket at depth q * 2^doublings: the pair of the buckets of half that depth, here and behind it."""
        if doublings == 0:
            return self.names[places]
        later = places + (self.q << (doublings - 1))
        return self._pair(self.at_depth(places, doublings - 1), self.at_depth(later, doublings - 1))

    @staticmethod
    def _pair(here: np.ndarray, later: np.ndarray) -> np.ndarray:
        return mixed(here * np.uint64(0x9E3779B97F4A7C15) + later, salt=11)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out, lengths = np.empty(len(starts), np.uint64), ends - starts
        doublings = np.zeros(len(starts), np.int64)
        while (deeper := (self.q << (doublings + 1)) <= lengths).any():
            doublings[deeper] += 1
        for d in np.unique(doublings).tolist():
            own = doublings == d
            first, last = self.at_depth(starts[own], d), self.at_depth(ends[own] - (self.q << d), d)
            out[own] = self._pair(first, last) ^ mixed(lengths[own].astype(np.uint64), salt=5)
        return out


class Suffixes:
    """Sampled suffixes of a batch. Each stands for the strings that start at ``first`` .. ``first + count - 1``.

    ``bucket`` names its q-gram, ``block`` all its strings together, ``row`` is the document's place.
    """

    def __init__(self, batch: Batch, length: int, q: int) -> None:
        self.batch, self.length, self.q = batch, length, q
        data = np.frombuffer(batch.data, dtype=np.uint8)
        parts = []
        for a in range(0, max(0, len(data) - length + 1), SEGMENT):
            b = min(a + SEGMENT, len(data) - length + 1)  # strings start in a .. b - 1
            parts.append(self._segment(data[a : b + length - 1], a, q))
        empty = np.empty(0, np.int64)
        columns = zip(*parts) if parts else (empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty)
        self.first, self.count, self.bucket, self.block, self.row = (
            np.concatenate(c) if parts else c for c in columns
        )

    def _segment(self, data: np.ndarray, offset: int, q: int) -> tuple[np.ndarray, ...]:
        names = Windows(BYTE_VALUES[data]).all(q)
        at = _chosen(names, self.length - q + 1)
        starts = self.batch.starts
        row = np.searchsorted(starts, offset, "right") - 1
        last = np.searchsorted(starts, offset + len(at), "left")
        inner = starts[row + 1 : last] - offset  # documents that begin inside the segment
        inner = inner[(inner > 0) & (inner < len(at))]
        border = np.zeros(len(at), dtype=bool)
        border[inner] = True
        change = np.concatenate([[True], (at[1:] != at[:-1])]) | border
        first = np.flatnonzero(change)
        end = np.append(first[1:], len(at))
        row = np.searchsorted(starts, first + offset, "right") - 1
        # Strings must end inside their document.
        end = np.minimum(end, starts[row + 1] - offset - self.length + 1)
        real = end > first
        first, end, row = first[real], end[real], row[real]
        block = Identifiers(names, q).of(first, end + self.length - 1)
        # Chosen names are the smallest of many; mixed again, they spread over the key partitions.
        return first + offset, end - first, mixed(names[at[first]], salt=1), block, row

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, name, second name) of all strings of the chosen suffixes."""
        first, count = self.first[chosen], self.count[chosen]
        before = np.cumsum(count) - count
        start = np.repeat(first - before, count) + np.arange(count.sum())
        name, check = np.empty(len(start), np.uint64), np.empty(len(start), np.uint32)
        data, at = np.frombuffer(self.batch.data, dtype=np.uint8), 0
        while at < len(start):
            to = int(np.searchsorted(start, start[at] + SEGMENT))
            a, b = int(start[at]), int(start[to - 1]) + self.length
            own = start[at:to] - a
            values = BYTE_VALUES[data[a:b]]
            name[at:to] = Identifiers(Windows(values).all(self.q), self.q).of(own, own + self.length)
            check[at:to] = Windows(mixed(values, salt=9)).hashes(own, own + self.length) >> np.uint64(32)
            at = to
        return start, name, check


    def block_checks(self, chosen: np.ndarray) -> np.ndarray:
        """Second names of the blocks of the chosen suffixes, from other values of the bytes than ``block``."""
        order = np.argsort(self.first[chosen], kind="stable")
        begin = self.first[chosen][order]
        end = begin + self.count[chosen][order] + self.length - 1
        check = np.empty(len(order), np.uint32)
        data, at = np.frombuffer(self.batch.data, dtype=np.uint8), 0
        while at < len(begin):
            to = int(np.searchsorted(begin, begin[at] + SEGMENT))
            a, b = int(begin[at]), int(end[at:to].max())
            values = Windows(mixed(BYTE_VALUES[data[a:b]], salt=9))
            check[order[at:to]] = values.hashes(begin[at:to] - a, end[at:to] - a) >> np.uint64(32)
            at = to
        return check


def _often(inverse: np.ndarray, notes: np.ndarray) -> np.ndarray:
    """More than one suffix is in this bucket; the note says so of the batch."""
    return (np.bincount(inverse, weights=1 + notes) > 1)[inverse]


def _one_block(inverse: np.ndarray, notes: np.ndarray) -> np.ndarray:
    """All suffixes of this bucket have the same block; notes: a block of the batch, its check, and whether it is the only one."""
    n = inverse.max(initial=-1) + 1
    any_of = np.empty(n, dtype=np.int64)
    any_of[inverse] = np.arange(len(inverse))
    other = ~notes["only"].astype(bool)
    for name in ("block", "check"):
        other |= notes[name] != notes[name][any_of][inverse]
    alone = np.ones(n, dtype=bool)
    alone[inverse[other]] = False
    return alone[inverse]


BLOCK_AND_CHECK = [("block", "<u8"), ("check", "<u4"), ("only", "u1")]


def _shared(s: Suffixes, answers: list, parts: int) -> np.ndarray:
    """Suffixes whose bucket holds others."""
    keys, order, starts = grouped(s.bucket)
    out = np.zeros(len(order), dtype=bool)
    out[order] = np.repeat(bits_of(answers, BUCKET, keys, parts), np.diff(np.append(starts, len(order))))
    return np.flatnonzero(out)


def _full_name(s: Suffixes, shared: np.ndarray) -> np.ndarray:
    return mixed(s.bucket[shared] ^ (s.block[shared] * np.uint64(0x9E3779B97F4A7C15)), salt=3)


def _settled(s: Suffixes, answers: list, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes all of whose strings are repeats, suffixes to refine string by string)."""
    shared = _shared(s, answers, parts)
    keys, order, starts = grouped(_full_name(s, shared))
    later = later_ones(order, starts, s.row[shared], s.batch.ids, bits_of(answers, BLOCK, keys, parts))
    keys, order, starts = grouped(s.bucket[shared])
    alone = np.zeros(len(order), dtype=bool)
    alone[order] = np.repeat(bits_of(answers, ALONE, keys, parts), np.diff(np.append(starts, len(order))))
    return shared[later], shared[~later & ~alone]


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, q: int = Q_GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    A byte of the UTF-8 text goes when a string of ``length`` bytes covers it that also starts earlier: in a
    smaller doc_id, or earlier in the same document. A null text is empty. A null doc_id comes after all
    others; rows that share an id are not earlier than each other; an empty table gives an empty result. A very long
    text is a batch of its own, read whole in segments. Other columns, whatever their names, are left out.
    Strings of different batches are compared by 96 bits of hash or more, those of one batch (about 4 MB) by 64.
    """
    batches = pack(docs)
    parts = n_parts(batches, (length - q + 2) / 2)  # of that many places about one is chosen

    def buckets(batch: Batch, answers: list) -> Iterator[tuple]:
        s = Suffixes(batch, length, q)
        keys, order, starts = grouped(s.bucket)
        yield BUCKET, keys, (np.diff(np.append(starts, len(order))) > 1).astype(np.uint8)

    def blocks(batch: Batch, answers: list) -> Iterator[tuple]:
        s = Suffixes(batch, length, q)
        shared = _shared(s, answers, parts)
        check = s.block_checks(shared)
        keys, order, starts = grouped(_full_name(s, shared))
        first = order[starts]
        notes = np.empty(len(keys), dtype=DOC_AND_CHECK)
        notes["doc"] = batch.ids[s.row[shared[first]]]
        notes["check"] = check[first]
        yield BLOCK, keys, notes
        keys, order, starts = grouped(s.bucket[shared])
        notes = np.empty(len(keys), dtype=BLOCK_AND_CHECK)
        notes["only"] = 1
        for name, own in (("block", s.block[shared][order]), ("check", check[order])):
            notes[name] = own[starts]
            if len(keys):
                notes["only"] &= np.minimum.reduceat(own, starts) == np.maximum.reduceat(own, starts)
        yield ALONE, keys, notes

    def strings(batch: Batch, answers: list) -> Iterator[tuple]:
        s = Suffixes(batch, length, q)
        start, name, check = s.strings(_settled(s, answers, parts)[1])
        keys, order, starts = grouped(name)
        first = order[starts]
        notes = np.empty(len(keys), dtype=DOC_AND_CHECK)
        notes["doc"] = batch.ids[np.searchsorted(batch.starts, start[first], "right") - 1]
        notes["check"] = check[first]
        yield STRING, keys, notes

    def removed(batch: Batch, answers: list) -> np.ndarray:
        s = Suffixes(batch, length, q)
        repeated, refined = _settled(s, answers, parts)
        start, name, _ = s.strings(refined)
        keys, order, starts = grouped(name)
        row = np.searchsorted(batch.starts, start, "right") - 1
        later = start[later_ones(order, starts, row, batch.ids, bits_of(answers, STRING, keys, parts))]
        change = np.zeros(len(batch.data) + 1, dtype=np.int32)
        np.add.at(change, s.first[repeated], 1)
        np.add.at(change, s.first[repeated] + s.count[repeated] + length - 1, -1)
        np.add.at(change, later, 1)
        np.add.at(change, later + length, -1)
        return np.cumsum(change)[:-1] > 0

    def cut(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, batch, answers in opened(tables):
                gone = removed(batch, answers)
                data = np.frombuffer(batch.data, dtype=np.uint8)
                for i, doc_id in enumerate(batch.ids.tolist()):
                    a, b = int(batch.starts[i]), int(batch.starts[i + 1])
                    own = gone[a:b]
                    spans = int(np.count_nonzero(own[1:] & ~own[:-1])) + int(b > a and own[0])
                    digest = hashlib.sha256(data[a:b][~own].tobytes()).hexdigest()
                    yield None if doc_id == NULL_ID else doc_id, b - a, int(own.sum()), spans, digest

        yield from as_tables(rows(), RESULT, 4096)

    by_doc = (in_smaller_document, DOC_AND_CHECK)
    batches = asked_and_answered(batches, buckets, {BUCKET: (_often, "u1")}, parts, "answer1")
    batches = asked_and_answered(batches, blocks, {BLOCK: by_doc, ALONE: (_one_block, BLOCK_AND_CHECK)}, parts, "answer2")
    batches = asked_and_answered(batches, strings, {STRING: by_doc}, parts, "answer3")
    return batches.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
