"""Documents packed into batches, and questions about keys answered across batches.

Operators that compare every position of every text with all others hash tens of keys per line of text. One
Spark row per key would move mostly row headers. Here a batch of documents is one row; it sends its distinct
keys to key partitions as sorted arrays and gets one bit per key back, in the order in which it sent them.
A key that a third of all documents hold costs one entry per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from starwash.llm.common import text_bytes
from starwash.sources.staging import stage, staged_path

BATCH_BYTES = 1 << 22
#: Key partitions for each shuffle partition: several, so that none gets much more than its share.
PER_TASK = 4
#: At least so many key partitions that each gets about this many keys, however few shuffle partitions there are.
KEYS_PER_PART = 4_000_000

BATCH = "batch long, task long, n_bytes long, ids binary, sizes binary, texts binary"
NULL_ID = np.iinfo(np.int64).max  # a document without id comes after all others


class Batch:
    """Documents in the order of their ids: ``ids``, byte ``starts`` (one more than documents) and ``data``."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, data: bytes) -> None:
        self.ids, self.starts, self.data = ids, starts, data

    @staticmethod
    def read(ids: bytes, sizes: bytes, texts: bytes) -> Batch:
        lengths = np.frombuffer(sizes, dtype=np.int64)
        data = zstandard.ZstdDecompressor().decompress(texts, max_output_size=int(lengths.sum()) + 1)
        return Batch(np.frombuffer(ids, dtype=np.int64), np.concatenate([[0], np.cumsum(lengths)]), data)


def pack(docs: DataFrame) -> DataFrame:
    """One row per batch (BATCH) of ``docs`` (doc_id, text), as a table bucketed by the task that writes it.

    A batch holds about BATCH_BYTES of text, a longer document is a batch of its own. The table is written
    by the tasks that read the documents, without a shuffle, one file for each; because it is bucketed, later joins
    by task move the answers, never the texts. Spark keeps buckets in its catalog only, so the table is entered there
    and taken out again once it is resolved; its files lie in the shared folder and stay.
    """
    spark = docs.sparkSession

    def build(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, run, size = TaskContext.get().partitionId() << 32, [], 0

        def packed(rows: list[tuple[int, bytes]], number: int) -> pa.RecordBatch:
            rows.sort(key=lambda r: r[0])
            ids = np.array([i for i, _ in rows], dtype=np.int64)
            sizes = np.array([len(t) for _, t in rows], dtype=np.int64)
            texts = zstandard.ZstdCompressor(level=1).compress(b"".join(t for _, t in rows))
            columns = ([number], [number >> 32], [int(sizes.sum())], [ids.tobytes()], [sizes.tobytes()], [texts])
            types = (*[pa.int64()] * 3, *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["batch", "task", "n_bytes", "ids", "sizes", "texts"]
            )

        for table in tables:
            for i, text in zip(table.column(0).to_pylist(), table.column(1)):
                text = text.as_py()
                if run and size + len(text) > BATCH_BYTES:
                    yield packed(run, number)
                    number, run, size = number + 1, [], 0
                run.append((i, text))
                size += len(text)
        if run:
            yield packed(run, number)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NULL_ID))).alias("doc_id"), text_bytes().alias("text"))
    name = f"batches_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.mapInArrow(build, BATCH).write.format("parquet").bucketBy(buckets, "task")
        .option("path", staged_path(spark)).option("compression", "none").saveAsTable(name)
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def n_parts(batches: DataFrame, bytes_per_key: float) -> int:
    """Key partitions for batches that send a key for every ``bytes_per_key`` bytes of text."""
    n_bytes = batches.agg(F.sum("n_bytes")).first()[0] or 0
    by_tasks = PER_TASK * int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(by_tasks, -int(-n_bytes // (bytes_per_key * KEYS_PER_PART)))


def split(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ends of the key partitions in sorted unsigned keys: partition p holds the p-th part of the key range."""
    edges = [(p << 64) // parts for p in range(1, parts)]
    return np.concatenate([np.searchsorted(keys, np.array(edges, dtype=np.uint64)), [len(keys)]])


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, in as few bytes each as the largest needs."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps[1:].max(initial=0)).bit_length() + 7) // 8)
    narrow = steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + narrow.tobytes()


def unpacked_keys(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    width, raw = blob[0], np.frombuffer(blob, dtype=np.uint8)
    narrow = raw[9:].reshape(-1, width)
    steps = np.zeros((len(narrow) + 1, 8), dtype=np.uint8)
    steps[0], steps[1:, :width] = raw[1:9], narrow
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


QUESTION = "kind long, part long, batch long, keys binary, notes binary"
ANSWER = "kind long, part long, batch long, bits binary"
QUESTION_ARROW = pa.schema([
    ("kind", pa.int64()), ("part", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("notes", pa.binary())
])


def as_tables(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    run: list[tuple] = []
    for row in rows:
        run.append(row)
        if len(run) == size:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in run], schema)
            run = []
    if run:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in run], schema)


def opened(tables: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Batch, list]]:
    """(number, batch, answers so far) of rows of ``pack``, one at a time."""
    for table in tables:
        for i in range(table.num_rows):
            row = {name: table.column(name)[i].as_py() for name in table.schema.names}
            answers = [a for name in row if name.startswith("answer") for a in row[name] or ()]
            yield row["batch"], Batch.read(row["ids"], row["sizes"], row["texts"]), answers


def asked(batches: DataFrame, ask: Callable, parts: int) -> DataFrame:
    """Rows of QUESTION: for each batch what ``ask(batch, answers)`` yields, (kind, keys, notes), the keys
    distinct and sorted, with one note each; dealt out to the key partitions."""

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for number, batch, answers in opened(tables):
                for kind, keys, notes in ask(batch, answers):
                    begin = 0
                    for part, end in enumerate(split(keys, parts).tolist()):
                        if end > begin:
                            yield kind, part, number, packed_keys(keys[begin:end]), notes[begin:end].tobytes()
                        begin = end

        yield from as_tables(rows(), QUESTION_ARROW, 64)

    return batches.mapInArrow(run, QUESTION)


def answered(questions: DataFrame, rules: dict[int, tuple[Callable, str | list]]) -> DataFrame:
    """Rows of ANSWER: what the rule of a kind, ``rule(inverse, notes)``, says of every key, one bit per key.

    ``inverse`` numbers equal keys alike over all batches, ``notes`` are theirs, of the numpy type given
    beside the rule. A key partition is its share of all distinct keys per batch.
    """

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        rule, note = rules[int(rows["kind"].iloc[0])]
        keys = [unpacked_keys(b) for b in rows["keys"]]
        notes = np.concatenate([np.frombuffer(b, dtype=np.dtype(note)) for b in rows["notes"]])
        inverse = np.unique(np.concatenate(keys), return_inverse=True)[1]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        bits = [np.packbits(v).tobytes() for v in np.split(rule(inverse, notes), ends)]
        return rows[["kind", "part", "batch"]].assign(bits=bits)

    return questions.groupBy("kind", "part").applyInPandas(decide, ANSWER)


def asked_and_answered(batches: DataFrame, ask: Callable, rules: dict, parts: int, name: str) -> DataFrame:
    """``batches`` with the answers as column ``name``, a list of (kind, part, bits) for each batch.

    The answers are written down; only they are shuffled to join. A batch has at most one per key partition
    and kind.
    """
    answers = stage(answered(asked(batches, ask, parts), rules))
    gathered = answers.groupBy(F.col("batch").alias("_of")).agg(F.collect_list(F.struct("kind", "part", "bits")).alias(name))
    gathered = gathered.select(F.shiftright("_of", 32).alias("_task"), "_of", name)
    # The task is the only key of the join, so that the texts stay in their buckets; the batch is a condition.
    own = (F.col("task") == F.col("_task")) & (F.col("batch") - F.col("_of") == 0)
    return batches.join(gathered, own, "left").drop("_task", "_of")


def bits_of(answers: list[dict], kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """The answer for every one of the sorted ``keys`` that were asked."""
    out, begin = np.zeros(len(keys), dtype=bool), 0
    by_part = {a["part"]: a["bits"] for a in answers if a["kind"] == kind}
    for part, end in enumerate(split(keys, parts).tolist()):
        if end > begin:
            raw = np.frombuffer(by_part[part], dtype=np.uint8)
            out[begin:end] = np.unpackbits(raw, count=end - begin).astype(bool)
        begin = end
    return out


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct sorted keys, order that sorts the keys stably, start of each distinct key in that order)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(keys) else order
    return ordered[starts], order, starts


def later_ones(order: np.ndarray, starts: np.ndarray, row: np.ndarray, ids: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Which occurrences have an earlier one. Occurrences come in the order of (document id, position).

    ``row`` is the document's place in the batch and ``ids`` the document ids; ``seen`` says of each distinct
    key that another batch has it in a smaller document. Rows with the same id are not earlier than each other.
    """
    sizes = np.diff(np.append(starts, len(order)))
    own = row[order]
    lowest = np.repeat(ids[own[starts]] if len(starts) else ids[:0], sizes)
    again = np.concatenate([[False], own[1:] == own[:-1]]) if len(own) else np.zeros(0, bool)
    again[starts] = False
    out = np.zeros(len(order), dtype=bool)
    out[order] = np.repeat(seen, sizes) | (ids[own] > lowest) | again
    return out


def in_smaller_document(inverse: np.ndarray, notes: np.ndarray) -> np.ndarray:
    """Rule: the same key and check are known from a smaller document id than this one. Notes: doc, check."""
    check = notes["check"].astype(np.uint64) + (inverse.astype(np.uint64) << np.uint64(32))
    same = np.unique(check, return_inverse=True)[1]
    lowest = np.full(same.max(initial=-1) + 1, NULL_ID, dtype=np.int64)
    np.minimum.at(lowest, same, notes["doc"])
    return lowest[same] < notes["doc"]


DOC_AND_CHECK = [("doc", "<i8"), ("check", "<u4")]
