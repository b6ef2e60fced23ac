"""Token files: documents encoded by a public tokenizer, in id order, one wavelet matrix per shard."""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from starwash.llm.batches import as_tables
from starwash.llm.common import text_bytes
from starwash.llm.wavelet import WaveletMatrix, encode
from starwash.sources.staging import stage, staged_path

END = 2
SHARD_TOKENS = 1 << 20
KEPT_WORDS = 200_000  # words of which a worker remembers the ids
KEPT_PIECES = 700_000  # letters or signs of words, of which it remembers them longer
RUN_BYTES = 1 << 18  # text that is encoded at a time
RUN_WORDS = 2048  # new words that are handed to the tokenizer at a time; its answers are large objects

#: A shard: ``chunk`` and ``place`` order the shards, ``before`` ids come earlier in the chunk, ``ids`` and
#: ``sizes`` are the documents (a null id has the bit ``no_id``), ``file`` the wavelet matrix of all tokens.
SHARD = pa.schema([
    ("chunk", pa.int64()), ("place", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()),
    ("ids", pa.binary()), ("no_id", pa.binary()), ("sizes", pa.binary()), ("file", pa.binary()),
])
SHARD_DDL = "chunk long, place long, before long, n_tokens long, ids binary, no_id binary, sizes binary, file binary"


#: What the word encoder relies on; with another normaliser, pre-tokenizer or mark whole texts are encoded.
WORD_SHAPE = {
    "normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"],
    "pattern": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
    "model": {"type": "BPE", "end_of_word_suffix": "</w>", "dropout": None, "unk_token": None, "continuing_subword_prefix": None},
}
#: Letters, then signs, then the rest of a word. Letters up to U+017F stay as they are under NFC and have one lower
#: case; a word with a rest is handed to the tokenizer as it is.
LETTERS_AND_SIGNS = re.compile(r"(?:^| )([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]*)([!-/:-@\[-`{-~]*)([^ ]*)")


def is_word_shape(vocabulary: str) -> bool:
    """Whether the vocabulary file cuts a text as ``WordEncoder`` does."""
    file = json.loads(vocabulary)
    steps = {
        part: [s["type"] for s in (file.get(part) or {}).get(inner, [])]
        for part, inner in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))
    }
    if any(steps[part] != WORD_SHAPE[part] for part in steps) or file.get("post_processor") or file.get("truncation"):
        return False
    pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex")
    blanks = file["normalizer"]["normalizers"][1]
    return (
        pattern == WORD_SHAPE["pattern"] and blanks["pattern"].get("Regex") == "\\s+" and blanks["content"] == " "
        and all(file["model"].get(k) == v for k, v in WORD_SHAPE["model"].items())
    )


class _Numbered(dict):
    """Numbers keys in the order in which they are first asked for; ``new`` are those since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.new.append(key)
        return number


class _Lists:
    """Numbered lists of ids in a row, in arrays that grow by doubling."""

    def __init__(self) -> None:
        self.n = self.total = 0
        self.starts, self.sizes, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        n, total = self.n + len(sizes), self.total + len(ids)
        if n > len(self.sizes):
            self.starts, self.sizes = (np.resize(a, 2 * n) for a in (self.starts, self.sizes))
        if total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * total)
        self.sizes[self.n : n] = sizes
        self.starts[self.n : n] = self.total + np.cumsum(sizes) - sizes
        self.flat[self.total : total] = ids
        self.n, self.total = n, total

    def joined(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the lists ``at`` in a row, the size of each)."""
        sizes = self.sizes[at]
        until = np.cumsum(sizes)
        total = int(until[-1]) if len(at) else 0
        return self.flat[np.repeat(self.starts[at] - until + sizes, sizes) + np.arange(total)], sizes


class WordEncoder:
    """Ids of texts, word by word: blanks end every token, so a text's ids are its words' ids in a row.

    Words come again and again, so KEPT_WORDS words are remembered, then forgotten together. Most are letters and
    then signs, which the tokenizer never joins; such pieces in lower case are remembered longer, KEPT_PIECES of them,
    since many words share one. New pieces of letters are handed to the tokenizer many at a time as one text: each
    ends with the only token in it that the vocabulary marks as an end of word.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bits = max(END, *known.values()).bit_length()
        self.by_word = is_word_shape(vocabulary)
        self.ends = np.zeros(1 << self.bits, dtype=bool)
        self.ends[[i for token, i in known.items() if token.endswith("</w>")]] = True
        self._forget_words()
        self._forget_pieces()

    def _forget_words(self) -> None:
        self.words, self.ids_of_word = _Numbered(), _Lists()

    def _forget_pieces(self) -> None:
        self.pieces, self.ids_of_piece = _Numbered(), _Lists()
        self.pieces[""] = 0
        self.ids_of_piece.add(np.empty(0, np.uint32), np.zeros(1, np.int64))

    def _ids_of_letters(self, run: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, number of ids of each)."""
        ids = self.tokenizer.encode_batch_fast([" ".join(run)], add_special_tokens=False)[0].ids
        ids = np.array(ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) == len(run) and (not len(run) or last[-1] == len(ids) - 1):
            return ids, np.diff(last, prepend=-1)
        return self._ids_one_by_one(run)  # a letter that the tokenizer takes apart

    def _ids_one_by_one(self, run: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(run, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=sizes.sum()), sizes

    def _learn(self, words: list[bytes]) -> None:
        if len(self.pieces) > KEPT_PIECES:
            self._forget_pieces()
        text, number = b" ".join(words).decode("utf-8", "replace"), self.pieces.__getitem__
        split = LETTERS_AND_SIGNS.findall(text)
        # A piece that is letters only is numbered in lower case; one with a rest stands for the whole word.
        first = [number(letters.lower() if not rest else letters + signs + rest) for letters, signs, rest in split]
        second = [number(signs if not rest else "") for _, signs, rest in split]
        new, self.pieces.new = self.pieces.new, []
        for at in range(0, len(new), RUN_WORDS):
            run = new[at : at + RUN_WORDS]
            plain = [p for p in run if p.isalpha()]
            ids, sizes = self._ids_of_letters(plain)
            if len(plain) < len(run):
                more, counts = self._ids_one_by_one([p for p in run if not p.isalpha()])
                mixed = _Lists()
                mixed.add(np.concatenate([ids, more]), np.concatenate([sizes, counts]))
                own = np.fromiter(map(str.isalpha, run), dtype=bool, count=len(run))
                ids, sizes = mixed.joined(np.where(own, np.cumsum(own) - 1, len(plain) + np.cumsum(~own) - 1))
            self.ids_of_piece.add(ids, sizes)
        ids, sizes = self.ids_of_piece.joined(np.array([first, second], dtype=np.int64).T.ravel())
        self.ids_of_word.add(ids, sizes.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, END appended."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array([*e.ids, END], dtype=np.uint32) for e in found]
        if len(self.words) > KEPT_WORDS:
            self._forget_words()
        number, numbered = self.words.__getitem__, []
        for text in texts:
            words = text.split()
            numbered.append(np.fromiter(map(number, words), dtype=np.int64, count=len(words)))
        new, self.words.new = self.words.new, []
        if new:
            self._learn(new)
        return [np.append(self.ids_of_word.joined(at)[0], np.uint32(END)) for at in numbered]


def _encoder(vocabulary: str) -> WordEncoder:
    """One encoder per worker process and vocabulary; it outlives a task."""
    state = sys.modules.setdefault("_starwash_encoders", types.ModuleType("_starwash_encoders"))
    key = f"{len(vocabulary)}-{zlib.crc32(vocabulary.encode())}"
    if key not in vars(state):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives every task its core
        vars(state).clear()
        vars(state)[key] = WordEncoder(vocabulary)
    return vars(state)[key]


def write_tokens(docs: DataFrame, path: str, vocabulary_file: str) -> None:
    """Encode every text of ``docs`` (doc_id, text), append END, write the shards below ``path``.

    Documents are range-partitioned by doc_id (null last; rows with one id by a hash of their text), so the
    shards in their order hold all of them in order. A shard ends after SHARD_TOKENS tokens, with a document.
    Spark's writer commits the shards, each one binary value, so a lost executor leaves no half file.
    """
    with open(vocabulary_file, encoding="utf-8") as f:
        vocabulary = f.read()

    def build(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, chunk = _encoder(vocabulary), TaskContext.get().partitionId()

        def encoded() -> Iterator[tuple[int | None, np.ndarray]]:
            run, size = [], 0
            for table in tables:
                for doc_id, text in zip(table.column(0).to_pylist(), table.column(1)):
                    run.append((doc_id, text.as_py()))
                    size += len(run[-1][1])
                    if size >= RUN_BYTES:
                        yield from zip([i for i, _ in run], encoder.encode([t for _, t in run]))
                        run, size = [], 0
            yield from zip([i for i, _ in run], encoder.encode([t for _, t in run]))

        def shards() -> Iterator[tuple]:
            ids, sizes, pieces, place, before, total = [], [], [], 0, 0, 0

            def shard() -> tuple:
                file = encode(np.concatenate(pieces), encoder.bits)
                known = np.array([0 if i is None else i for i in ids], dtype=np.int64).tobytes()
                missing = np.packbits([i is None for i in ids]).tobytes()
                return chunk, place, before, total, known, missing, np.array(sizes, dtype=np.int64).tobytes(), file

            for doc_id, tokens in encoded():
                pieces.append(tokens)
                ids.append(doc_id)
                sizes.append(len(tokens))
                total += len(tokens)
                if total >= SHARD_TOKENS:
                    yield shard()
                    ids, sizes, pieces, place, before, total = [], [], [], place + 1, before + total, 0
            if ids:
                yield shard()

        yield from as_tables(shards(), SHARD, 1)

    order = [F.col("doc_id").asc_nulls_last(), F.col("spread")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), F.xxhash64("text").alias("spread")
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(build, SHARD_DDL).write.option("compression", "none").parquet(path)


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards with ``start``, the ids of all documents before; sums over one row per chunk."""
    shards = spark.read.parquet(path)
    sizes = shards.groupBy("chunk").agg(F.sum("n_tokens").alias("n"))
    earlier = W.orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = stage(sizes.select("chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("at")))
    return shards.join(starts, "chunk").withColumn("start", F.col("at") + F.col("before"))


TOKENS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""

    def read(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for table in tables:
                for i in range(table.num_rows):
                    start, ids, no_id, sizes, file = (table.column(c)[i].as_py() for c in range(5))
                    sizes = np.frombuffer(sizes, dtype=np.int64)
                    missing = np.unpackbits(np.frombuffer(no_id, np.uint8), count=len(sizes))
                    tokens = WaveletMatrix(file).decode().astype("<u4")
                    at = 0
                    for doc_id, none, n in zip(np.frombuffer(ids, dtype=np.int64).tolist(), missing, sizes.tolist()):
                        yield None if none else doc_id, start + at, n, zlib.crc32(tokens[at : at + n].tobytes())
                        at += n

        yield from as_tables(rows(), TOKENS, 4096)

    shards = _shards(spark, path).select("start", "ids", "no_id", "sizes", "file")
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def find_tokens(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """(token, position): every occurrence, by rank and select in each shard; positions over all documents."""

    def find(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for table in tables:
                for i in range(table.num_rows):
                    matrix, start = WaveletMatrix(table.column(1)[i].as_py()), table.column(0)[i].as_py()
                    for token in tokens:
                        for k in range(matrix.count(token)):
                            yield token, start + matrix.select(token, k)

        yield from as_tables(rows(), pa.schema([("token", pa.int64()), ("position", pa.int64())]), 4096)

    return _shards(spark, path).select("start", "file").mapInArrow(find, "token long, position long")


def tokens_at(spark: SparkSession, path: str, positions: Sequence[int]) -> DataFrame:
    """(position, token) of the given positions over all documents."""

    def access(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for table in tables:
                for i in range(table.num_rows):
                    start, n, file = (table.column(c)[i].as_py() for c in range(3))
                    own = [p for p in positions if start <= p < start + n]
                    matrix = WaveletMatrix(file) if own else None
                    for p in own:
                        yield p, matrix.access(p - start)

        yield from as_tables(rows(), pa.schema([("position", pa.int64()), ("token", pa.int64())]), 4096)

    inside = F.lit(False)
    for p in positions:
        inside = inside | ((F.col("start") <= p) & (F.col("start") + F.col("n_tokens") > p))
    shards = _shards(spark, path).filter(inside).select("start", "n_tokens", "file")
    return shards.mapInArrow(access, "position long, token long")


def encode_and_read(docs: DataFrame, vocabulary_file: str) -> DataFrame:
    """Write the token files into the shared folder and read them back: one row per row of ``docs``.

    A null or empty text is the end id alone; a very long one is encoded whole, in one shard. Rows repeated or with
    one id each have their place, in the order of a hash of their text; a null doc_id comes last. An empty table
    gives no shard and no row. Other columns, whatever their names, are left out.
    """
    path = staged_path(docs.sparkSession)
    write_tokens(docs, path, vocabulary_file)
    return read_digests(docs.sparkSession, path)
